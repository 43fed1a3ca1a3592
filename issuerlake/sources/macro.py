"""Macro quote feed: JSON arrays, one body per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.clean import date_strict, feed_number, map_labels, pick_filled
from issuerlake.operators.common import unnest
from issuerlake.schemas import MACRO_GOLD, MACRO_ITEM, MACRO_TYPES


def parse_macro(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per quote. An empty array gives no rows; malformed JSON fails the job."""
    return unnest(df, [], F.from_json(body, MACRO_ITEM, {"mode": "FAILFAST"}), "_q").select(
        F.col("_q.securityIdentificationCode").alias("security_id"),
        "_q.description",
        F.col("_q.groupDescription").alias("group_label"),
        "_q.value",
        "_q.rate",
        F.col("_q.lastUpdate").alias("last_update"),
    )


def macro_gold(items: DataFrame, strict: bool = True) -> DataFrame:
    """Gold quotes: mapped type, the larger of value and rate compared as numbers, ISO date."""
    from issuerlake.operators.checks import conform_schema

    return conform_schema(
        items.select(
            "security_id",
            "description",
            map_labels(F.col("group_label"), MACRO_TYPES, strict).alias("data_type"),
            pick_filled(feed_number(F.col("value")), feed_number(F.col("rate"))).alias("value"),
            date_strict(F.col("last_update")).alias("ref_date"),
        ),
        MACRO_GOLD,
    )
