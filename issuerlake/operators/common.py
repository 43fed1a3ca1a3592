"""Building blocks shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group with their rank.

    ``row_number() <= k`` lets Spark put a group limit before the shuffle, so every task sends at
    most k rows per group and a group holding most of the table does not end up in one task.
    ``order`` has to be total.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1, "_rank").drop("_rank")


def unnest(df: DataFrame, keep: list[str], items: Column, value: str, position: str = "_pos") -> DataFrame:
    """``keep`` plus one row per array element, with its position from 0.

    Below a plain explode the optimizer puts a filter for empty arrays, which evaluates ``items`` a
    second time; for a regular expression over a whole text that doubles the work. The outer form
    with the filter above evaluates it once.
    """
    return df.select(*keep, F.posexplode_outer(items).alias(position, value)).filter(F.col(position).isNotNull())


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """The join condition that the keys of the two aliases are equal, where two nulls are."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in keys])


def spread_nulls(key: Column, row_id: Column) -> Column:
    """A join key whose nulls are replaced by values unique to the row.

    They match nothing, and unlike nulls they do not all hash to the same partition.
    """
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), row_id.cast("string")))
