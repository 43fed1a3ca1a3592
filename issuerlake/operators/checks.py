"""Filters, quality checks and schema conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.clean import map_labels
from issuerlake.schemas import LAST_EXERCISE


def filter_issuer(df: DataFrame, issuers: DataFrame, col: str = "CNPJ_CIA", key: str = "issuer_cnpj") -> DataFrame:
    """Rows of the given issuers. The set may have any size: Spark broadcasts it only below its limit."""
    return df.join(issuers.select(F.col(key).alias(col)), col, "left_semi")


def filter_last_exercise(df: DataFrame, col: str = "ORDEM_EXERC") -> DataFrame:
    return df.filter(F.col(col) == LAST_EXERCISE)


def filter_categories(df: DataFrame, mapping: dict[str, str], col: str = "category") -> DataFrame:
    """Rows whose category is in the mapping, with the document type it stands for."""
    return df.filter(F.col(col).isin(list(mapping))).withColumn("document_type", map_labels(F.col(col), mapping))


def filter_years(
    df: DataFrame, as_of: int, back: int = 2, skip_current_for: str | None = "DFP",
    year: str = "file_year", form: str = "form",
) -> DataFrame:
    """The year ``as_of`` and ``back`` years before; one form is not out yet for the current year."""
    keep = F.col(year).between(as_of - back, as_of)
    if skip_current_for is not None:
        keep = keep & ~((F.col(year) == as_of) & (F.col(form) == skip_current_for))
    return df.filter(keep)


def quality_report(df: DataFrame, rules: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Violations per rule, in one aggregation: (check_name, n_rows, n_violations).

    A rule is a boolean column that is true on a bad row. ``keys`` gives one report per group.
    """
    keys = keys or []
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(f"_r{i}") for i, c in enumerate(rules.values())]
    )
    named = ", ".join(f"'{n}', _r{i}" for i, n in enumerate(rules))
    return counts.select(*keys, "n_rows", F.expr(f"stack({len(rules)}, {named}) AS (check_name, n_violations)"))


def reply_not_found(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Replies without a row that has all required cells: (key, n_rows).

    The source answers with one row of remarks where it does not know the issuer; a single event is told
    from that by its content.
    """
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(filled).alias("_n"))
    return counted.filter(F.col("_n") == 0).select(key, "n_rows")


def reply_checks(replies: DataFrame, columns: list[str], skip: int, required: list[int], body: str = "body", sep: str = "\t") -> DataFrame:
    """Per reply: whether its header differs from ``columns``, its rows, and whether none has the required cells filled.

    Cells are named by place, and only looked at as far as that: no row leaves the reply.
    """
    keep = [c for c in replies.columns if c != body]
    lines = replies.select(*keep, F.split(F.coalesce(body, F.lit("")), r"\r?\n").alias("_l"))
    rows = F.filter(F.slice("_l", skip + 2, F.greatest(F.size("_l"), F.lit(1))), lambda x: x != "")

    def filled(row: Column) -> Column:
        cells = F.split(row, sep)
        return reduce(lambda a, b: a & b, [F.coalesce(F.get(cells, F.lit(i)), F.lit("")) != "" for i in required])

    header = F.coalesce(F.get("_l", F.lit(skip)), F.lit(""))
    return lines.select(*keep, (header != sep.join(columns)).alias("header_differs"), rows.alias("_r")).select(
        *keep, "header_differs", F.size("_r").alias("n_rows"), (~F.exists("_r", filled)).alias("not_found")
    )


def header_report(
    files: DataFrame, expected: dict[str, list[str]], loose: set[str] = frozenset(), source: str = "source", header: str = "header",
    sep: str = ";",
) -> DataFrame:
    """Per file: the expected columns of its source that its header lacks, those it has besides, and whether only their order differs.

    Names may be quoted. For the sources in ``loose`` further columns and their order do not matter. A source that nothing is
    expected of has nulls; so has ``order_differs`` where columns are missing or unexpected. The first line of a file is all it takes.
    """
    mark = "\\" + sep
    names = F.transform(F.split(F.coalesce(header, F.lit("")), mark), lambda x: F.regexp_replace(F.trim(x), '^"(.*)"$', "$1"))
    got = F.when(F.coalesce(F.col(header), F.lit("")) == "", F.array().cast("array<string>")).otherwise(names)
    wanted = F.create_map(*[c for k, v in expected.items() for c in (F.lit(k), F.array(*[F.lit(x) for x in v]))])
    rows = files.withColumns({"_got": got, "_want": F.try_element_at(wanted, F.col(source))})
    strict = ~F.col(source).isin(list(loose)) if loose else F.lit(True)
    missing = F.array_except("_want", "_got")
    unexpected = F.when(strict, F.array_except("_got", "_want")).otherwise(F.when(F.col("_want").isNotNull(), F.array().cast("array<string>")))
    rows = rows.withColumns({"missing": missing, "unexpected": unexpected})
    same = (F.size("missing") == 0) & (F.size("unexpected") == 0)
    differs = F.when(F.col("_want").isNotNull() & same, strict & (F.col("_got") != F.col("_want")))
    return rows.withColumn("order_differs", differs).drop("_got", "_want")


def schema_differences(actual: T.StructType, expected: list[str]) -> list[str]:
    """Readable differences between a header and the expected ordered column list."""
    got = actual.fieldNames()
    out = [f"missing: {c}" for c in expected if c not in got] + [f"unexpected: {c}" for c in got if c not in expected]
    return out or ([] if got == expected else ["order differs"])


def missing_categories(df: DataFrame, expected: list[str], issuer: str = "issuer_cnpj", col: str = "category") -> DataFrame:
    """Expected categories an issuer has no row for; severity is error where all are missing.

    One aggregation: the labels seen fit a set no larger than ``expected``.
    """
    wanted = F.array(*[F.lit(c) for c in expected])
    seen = F.collect_set(F.when(F.col(col).isin(expected), F.col(col)))
    return (
        df.groupBy(issuer)
        .agg(F.array_except(wanted, seen).alias("_missing"))
        .select(
            issuer,
            F.when(F.size("_missing") == len(expected), "error").otherwise("warning").alias("severity"),
            F.explode("_missing").alias("category"),
        )
    )


def uncovered_assets(listing: DataFrame, prices: DataFrame, code: str = "asset_code") -> DataFrame:
    """Listed assets nobody quoted a price for."""
    return listing.join(prices.select(code).distinct(), code, "left_anti")


def conform_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Cast to the target schema in its column order; a missing column fails at once."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields]).to(target)
