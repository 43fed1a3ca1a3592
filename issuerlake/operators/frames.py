"""Single quarters and trailing sums from statements that count from the start of the year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["enr_aggregation_type", "issuer_cnpj"]
EXACT = "decimal(38,6)"


def quarterly_flows(
    financials: DataFrame, flows: list[str], series: list[str] = SERIES, date: str = "date", year_to_date: bool = True
) -> DataFrame:
    """Per series and quarter and for every flow: ``_quarter``, ``_ttm`` and ``_yoy``.

    ``_quarter`` is the flow of the quarter alone: what the year to date has grown by since the quarter before. ``_ttm``
    adds four quarters, ``_yoy`` is the growth over the same quarter of the year before (null where that was zero).
    Frames are ranges over quarter numbers: where a quarter is missing the result is null, and never that of a
    neighbour. Of several dates in a quarter the last counts. A null flow is a missing quarter of that flow.

    A series has as many rows as quarters. Amounts are exact decimals until the end.
    """
    number = F.year(date) * 4 + F.quarter(date)
    last = F.max(F.struct(F.col(date).alias("date"), *[F.col(f).cast(EXACT).alias(f) for f in flows])).alias("_l")
    rows = financials.where(F.col(date).isNotNull()).groupBy(*series, number.alias("_q")).agg(last).select(*series, "_q", "_l.*")
    order = Window.partitionBy(*series).orderBy("_q")

    def single(f: str):
        before = F.max(f).over(order.rangeBetween(-1, -1))
        return F.when(F.quarter("date") == 1, F.col(f)).otherwise(F.col(f) - before) if year_to_date else F.col(f)

    quarters = rows.select(*series, "_q", "date", *[single(f).cast(EXACT).alias(f) for f in flows])
    year, earlier = order.rangeBetween(-3, 0), order.rangeBetween(-4, -4)
    made = []
    for f in flows:
        whole = F.count(f).over(year) == 4
        base = F.max(f).over(earlier).cast("double")
        made += [
            F.col(f).cast("double").alias(f"{f}_quarter"), F.when(whole, F.sum(f).over(year)).cast("double").alias(f"{f}_ttm"),
            F.when(base != 0, (F.col(f).cast("double") - base) / F.abs(base)).alias(f"{f}_yoy"),
        ]
    return quarters.select(*series, "date", *made)
