"""Intersection and difference of tables as multisets: repeated rows count, nulls are equal to nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of a row that are made at once.
COPIES = 10_000


def copies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every different row of either table with ``n_left`` and ``n_right``, how often each has it.

    Columns are matched by name, and have to be the same. Rows are counted where they lie before they move, so one
    that makes up much of a table is a single row of each task.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {sorted(left.columns)}, {sorted(right.columns)}")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = left.select("*", one.alias("n_left"), none.alias("n_right")).unionByName(right.select("*", none.alias("n_left"), one.alias("n_right")))
    return both.groupBy(*[f"`{c}`" for c in left.columns]).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


def repeated(rows: DataFrame, n: str) -> DataFrame:
    """Every row as often as ``n`` says, without that column; no array has more than COPIES elements, or as many parts."""
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / COPIES)))
    parts = rows.where(F.col(n) > 0).withColumn("_block", blocks)
    here = F.least(F.lit(COPIES), F.col(n) - F.col("_block") * COPIES)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), here))).drop(n, "_block", "_copy")


def multiset_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables, each as often as in the table that has it less often."""
    met = copies(left, right).withColumn("n_left", F.least("n_left", "n_right")).drop("n_right")
    return repeated(met, "n_left").select(*left.columns)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` as often as it has them more often than ``right``."""
    more = copies(left, right).withColumn("n_left", F.col("n_left") - F.col("n_right")).drop("n_right")
    return repeated(more, "n_left").select(*left.columns)


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows that the tables do not have equally often, with both numbers."""
    return copies(left, right).where("n_left <> n_right")
