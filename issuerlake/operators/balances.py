"""Outstanding balances over ordered events, and the cash flow table of a debenture."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.operators.temporal import DAY, MICROS, moment

cloudpickle.register_pickle_by_value(sys.modules[__name__])

AMOUNT = "decimal(38,2)"
CASH_FLOW = "period date, opening decimal(38,2), paid_in decimal(38,2), interest decimal(38,2), amortized decimal(38,2), closing decimal(38,2)"


def running_balance(
    events: DataFrame, keys: list[str], at: str, order: list[str], change: Column, start: Column | None = None,
    bucket_seconds: int = 30 * DAY,
) -> DataFrame:
    """``events`` with ``balance``, what is outstanding after each: the sum of all changes, but never below zero.

    Events of a key are taken by ``at``, then ``order`` (together total). A change that would lead below zero leads to
    zero, so the order matters, and yet runs can be merged: with s the sum of changes up to an event and low the least
    such sum so far, the balance is s + max(start, -low). A run of events is told by its sum and its least sum. They are
    taken inside buckets of time, then over a key's buckets, one row each; a key that holds much of the
    table is spread over its buckets. Events with a null key, time or change are left out.
    """
    rows = events.withColumns({"_c": change.cast(AMOUNT), "_t": moment(at), "_start": (F.lit(0) if start is None else start).cast(AMOUNT)})
    rows = rows.dropna(subset=[*keys, "_t", "_c"]).withColumn("_b", F.floor(F.col("_t") / (bucket_seconds * MICROS)))
    run = Window.partitionBy(*keys, "_b").orderBy("_t", *order).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_s", F.sum("_c").over(run).cast(AMOUNT))
    inside = inside.withColumn("_low", F.min("_s").over(run))
    runs = inside.groupBy(*keys, "_b").agg(F.sum("_c").cast(AMOUNT).alias("_sum"), F.min("_s").alias("_least"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(AMOUNT)
    upto = runs.withColumn("_before", F.coalesce(F.sum("_sum").over(before), zero).cast(AMOUNT))
    upto = upto.withColumn("_lowest", F.min(F.col("_before") + F.col("_least")).over(before))
    met = inside.join(upto.select(*keys, "_b", "_before", "_lowest"), [*keys, "_b"])
    low = F.least(F.col("_lowest"), F.col("_before") + F.col("_low"))
    balance = F.col("_before") + F.col("_s") + F.greatest(F.col("_start"), -low)
    return met.select(*[F.col(c) for c in events.columns], balance.cast(AMOUNT).alias("balance"))


class CashFlow:
    """Table function over the periods of one asset, in order: what it opens with, what is paid, and what it closes with."""

    def __init__(self):
        self.balance = None

    def eval(self, row) -> Iterator[tuple]:
        opening = self.balance if self.balance is not None else row["paid_in"] * 0
        owed = opening + row["paid_in"]
        amortized = min(row["amortized"], owed)
        self.balance = owed - amortized
        yield row["asset_code"], row["period"], opening, row["paid_in"], row["interest"], amortized, self.balance


def cash_flow_table(events: DataFrame, period: str = "month") -> DataFrame:
    """Per asset and period: opening balance, amounts paid in, interest, amortization (as far as something is owed) and closing balance.

    ``events`` is (asset_code, event_date, kind, amount) with the kinds paid_in, interest and amortized. Amounts are added per
    period first, so the table function, which needs an asset's rows in order, gets one row a period however many events there are.
    """
    amount = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("amount").cast(AMOUNT))), F.lit(0)).cast(AMOUNT).alias(kind)
    known = events.dropna(subset=["asset_code", "event_date", "amount"])
    periods = known.groupBy("asset_code", F.trunc("event_date", period).alias("period")).agg(*[amount(k) for k in ("paid_in", "interest", "amortized")])
    table = F.udtf(CashFlow, returnType=f"asset_code string, {CASH_FLOW}")
    return table(periods.asTable().partitionBy("asset_code").orderBy("period"))
