"""Debenture terms, event schedule, traded prices and their coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.clean import (
    br_number, br_number_for, date_lenient, feed_number, halve_doubled, null_token, null_tokens, snake_name,
)
from issuerlake.operators.checks import conform_schema
from issuerlake.operators.common import top_per_group
from issuerlake.schemas import COVENANT_COLUMNS, EVENTS_SCHEDULE_GOLD, TERMS_COLUMNS, TRADED_PRICES_GOLD


def covenants(columns: list[str], names: list[str] = COVENANT_COLUMNS) -> Column:
    """'column: value' of the filled covenant columns, joined by '; '; '' where there is none."""
    parts = [
        F.when(F.col(f"`{c}`") != "", F.concat(F.lit(f"{c}: "), F.col(f"`{c}`"))) for c in names if c in columns
    ]
    return F.concat_ws("; ", *parts) if parts else F.lit("")


def conform(
    df: DataFrame, mapping: dict[str, str] = TERMS_COLUMNS, consumed: list[str] = COVENANT_COLUMNS,
    keys: tuple[str, ...] = ("asset_code",),
) -> DataFrame:
    """Known columns renamed, covenants combined, every other source column kept as enr_<snake_case>.

    Two headers that fold to the same name are an error, named here rather than where the column is used.
    """
    renamed = [F.col(f"`{src}`").alias(dst) for src, dst in mapping.items() if src in df.columns]
    rest = [
        F.col(f"`{c}`").alias(f"enr_{snake_name(c)}")
        for c in df.columns
        if c not in mapping and c not in consumed and c not in keys
    ]
    folded: dict[str, str] = {}
    for c in df.columns:
        if c not in mapping and c not in consumed and c not in keys:
            if (name := snake_name(c)) in folded:
                raise ValueError(f"columns {folded[name]!r} and {c!r} both become enr_{name}")
            folded[name] = c
    return df.select(*keys, *renamed, covenants(df.columns, consumed).alias("covenants"), *rest)


def fallback_by_group(df: DataFrame, key: str = "asset_code", col: str = "coupon", alt: str = "coupon_alt") -> DataFrame:
    """Where ``col`` is null on all rows of a group, ``alt`` takes its place on all of them; ``alt`` goes.

    Groups to fall back on come from a pre-aggregated pass and are joined back, so no group has to
    fit a window partition. A null group key counts as one group.
    """
    if alt not in df.columns:
        return df
    if col not in df.columns:
        return df.withColumnRenamed(alt, col)
    filled = df.groupBy(F.col(key).alias("_k")).agg(F.count(col).alias("_filled"))
    empty = filled.filter(F.col("_filled") == 0).select("_k", F.lit(True).alias("_empty"))
    joined = df.join(empty, df[key].eqNullSafe(empty["_k"]), "left")
    value = F.when(F.col("_empty"), F.col(alt).cast(df.schema[col].dataType)).otherwise(F.col(col))
    return joined.withColumn(col, value).drop("_k", "_empty", alt)


def terms_gold(raw: DataFrame, key: str = "asset_code") -> DataFrame:
    """Terms of all assets of one source layout: renamed, coupon resolved, dates and numbers read, tokens nulled."""
    df = null_tokens(fallback_by_group(conform(raw, keys=(key,)), key))
    typed = {c: date_lenient(F.col(c)) for c in ("issue_date", "maturity") if c in df.columns}
    if "coupon" in df.columns:
        typed["coupon"] = feed_number(F.col("coupon"))
    return df.withColumns(typed)


def clean_events(raw: DataFrame) -> DataFrame:
    """Event rows with the doubled type halved, missing-value tokens nulled, dates and rates read."""
    dates = {c: date_lenient(null_token(F.col(c))) for c in ("event_date", "payment_date", "settlement_date")}
    return conform_schema(
        raw.withColumns(
            {
                **dates,
                "yield_type": null_token(halve_doubled(F.col("yield_type"))),
                "rate_or_percent": br_number(F.col("rate_or_percent")),
                **{c: null_token(F.col(c)) for c in ("issuer", "asset_code", "event")},
            }
        ),
        EVENTS_SCHEDULE_GOLD,
    )


# Payment order, made total by the other columns.
SCHEDULE_ORDER = ["payment_date", "asset_code", "event", "event_date", "issuer", "yield_type", "rate_or_percent", "settlement_date"]


def events_schedule(raw: DataFrame) -> DataFrame:
    """The cleaned schedule in payment order, missing values last, by a range-partitioned sort."""
    return clean_events(raw).orderBy(*[F.asc_nulls_last(c) for c in SCHEDULE_ORDER])


def traded_prices(raw: DataFrame) -> DataFrame:
    """Traded prices with Brazilian numbers and dates read; numeric input passes through."""
    fields = {f.name: f for f in raw.schema.fields}
    out = raw.withColumns(
        {
            **{c: br_number_for(fields[c]) for c in ("min_unit_price", "avg_unit_price", "max_unit_price", "curve_price_percent")},
            **{c: br_number_for(fields[c]).cast("bigint") for c in ("qty", "amt_of_trades")},
        }
    )
    if isinstance(fields["ref_date"].dataType, T.StringType):
        out = out.withColumn("ref_date", date_lenient(F.col("ref_date")))
    if "ISIN" not in fields:
        out = out.withColumn("ISIN", F.lit(None).cast("string"))
    return conform_schema(out, TRADED_PRICES_GOLD)


def upcoming_payments(events: DataFrame, from_date: str, k: int = 10) -> DataFrame:
    """Next ``k`` payments per issuer on or after ``from_date``."""
    due = events.filter(F.col("payment_date") >= F.lit(from_date).cast("date"))
    order = [
        F.asc("payment_date"), F.asc("asset_code"), F.asc("event"), F.asc("event_date"), F.asc("yield_type"),
        F.asc_nulls_last("rate_or_percent"), F.asc("settlement_date"),
    ]
    return top_per_group(due, ["issuer"], order, k)


def asset_price_coverage(listing: DataFrame, prices: DataFrame) -> DataFrame:
    """Per issuer, how many listed assets there are and how many distinct codes have prices.

    Codes are made distinct first, so the counts run over pre-aggregated rows.
    """
    listed = listing.select("issuer", "asset_code").distinct().groupBy("issuer").agg(F.count(F.lit(1)).alias("n_listed"))
    priced = prices.select("issuer", "asset_code").distinct().groupBy("issuer").agg(F.count(F.lit(1)).alias("n_priced"))
    n_listed, n_priced = (F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("n_listed", "n_priced"))
    return listed.join(priced, "issuer", "full_outer").select(
        "issuer",
        n_listed.alias("n_listed"),
        n_priced.alias("n_priced"),
        (n_listed != n_priced).alias("count_differs"),
    )
