"""Delimited files: strict CSV scans, statement-file tagging, and TSV replies with a preamble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.clean import map_labels
from issuerlake.operators.common import unnest
from issuerlake.schemas import AGGREGATIONS, STATEMENT_CODES
from issuerlake.sources.parsers import quoted_records

# Texts the sources' usual reader takes for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = ";", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """One typed scan over all files below ``path``. A header whose names or order differ fails the job."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def with_path(df: DataFrame, col: str = "source_path") -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(col))


def tag_files(df: DataFrame, path_col: str = "source_path") -> DataFrame:
    """Statement code, aggregation and year from the file path; other files are dropped.

    Direct-method cash flow, equity changes, comprehensive income and value added have no code in
    the list, so their rows go as well.
    """
    pattern = rf"_({'|'.join(STATEMENT_CODES)})_({'|'.join(AGGREGATIONS)})_(\d{{4}})"
    p = F.col(path_col)
    code, agg = F.regexp_extract(p, pattern, 1), F.regexp_extract(p, pattern, 2)
    return (
        df.filter(p.rlike(pattern))
        .withColumns(
            {
                "statement_code": code,
                "enr_origin_document_type": map_labels(code, STATEMENT_CODES),
                "enr_aggregation_type": map_labels(agg, AGGREGATIONS),
                "file_year": F.regexp_extract(p, pattern, 3).cast("int"),
            }
        )
    )


def tag_origin_file(df: DataFrame, path_col: str = "source_path") -> DataFrame:
    """DFP for annual files, ITR for quarterly ones."""
    return df.withColumn("ORIGIN_FILE", F.when(F.contains(path_col, F.lit("dfp_")), "DFP").otherwise("ITR"))


def read_preamble_tsv(
    spark: SparkSession,
    path: str,
    skip: int,
    columns: list[str],
    sep: str = "\t",
    encoding: str = "ISO-8859-1",
    names: list[str] | None = None,
) -> DataFrame:
    """Tab-separated replies with ``skip`` lines before the header, one reply per file, all columns text.

    Work is parallel over files; a reply is what one request returned, so each fits a task. Cells may be
    quoted, with quotes doubled and line breaks inside; ``line_no`` counts records. Only replies with a quote behind
    the header go through Python, which cuts them. A header other than ``columns`` fails the job, and so does a
    row with more cells than the header or a quote that is not closed; missing cells are null. ``names`` renames the
    columns in the same order.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.col("path").alias("source_path"), F.decode("content", encoding).alias("body"))
    )
    lines = files.select("source_path", F.split("body", r"\r?\n").alias("lines"))
    header = F.get("lines", F.lit(skip))
    checked = F.when(header == F.lit(sep.join(columns)), F.slice("lines", skip + 2, F.greatest(F.size("lines"), F.lit(1)))).otherwise(
        F.raise_error(F.concat(F.lit("unexpected header in "), F.col("source_path"))).cast("array<string>")
    )
    content = lines.select("source_path", checked.alias("lines"))
    quoted = F.when(F.exists("lines", lambda x: F.contains(x, F.lit('"'))), F.array_join("lines", "\n"))
    cut = F.pandas_udf(quoted_records(sep), "array<string>")
    content = content.select("source_path", F.coalesce(cut(quoted), F.col("lines")).alias("lines"))
    rows = unnest(content, ["source_path"], F.col("lines"), "line", "line_no").filter(F.col("line") != "")
    # One field more than the header has takes what is too much.
    fields = ", ".join(f"_{i} string" for i in range(len(columns) + 1))
    cells = F.from_csv("line", F.lit(fields), {"sep": sep, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    parsed = rows.select("source_path", "line_no", cells.alias("_c"))

    def field(i: int) -> Column:
        v = F.col(f"_c._{i}")
        return F.when(~v.isin(MISSING), v)

    too_many = F.raise_error(F.concat(F.lit("more cells than columns in "), F.col("source_path"), F.lit(", row "), F.col("line_no").cast("string")))
    fits = F.when(F.col(f"_c._{len(columns)}").isNull(), True).otherwise(too_many.cast("boolean"))
    return parsed.filter(fits).select("source_path", "line_no", *[field(i).alias(n) for i, n in enumerate(names or columns)])


def select_ragged(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` by name; those a source layout lacks become null text."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])

