"""Joins along time: the row in force at a moment, and intervals that hold a moment or overlap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY = 86_400
# Widths of interval bins are powers of 2 ** LEVEL_STEP microseconds; open ends reach to this moment.
LEVEL_STEP = 2
FOREVER = (1 << 62) - 1


def moment(c: str) -> Column:
    """Microseconds since 1970 of a date or timestamp."""
    return F.unix_micros(F.col(c).cast("timestamp"))


def _known(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, values: list[str], ties: list[str] | None = None,
    bucket_seconds: int = 30 * DAY, tolerance_seconds: int | None = None,
) -> DataFrame:
    """``left`` with the ``values`` of the last ``right`` row of the same keys whose ``since`` is not after ``at``.

    Of rows of one moment the one with the greatest ``ties``, then the greatest values, counts. Rows of ``left`` with
    a null key or moment, or without such a row within the tolerance, get nulls; repeated rows stay.

    Both sides shrink to one row per key and moment before they move. These are merged in order of time inside
    buckets of time, and a bucket without an earlier row of its own takes what the last bucket before it
    ended with. So a key that holds much of the table is spread over its buckets, and a task sorts one
    bucket's moments at a time; choose ``bucket_seconds`` so that these fit.
    """
    entry = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(ties or [])], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    offers = right.where(_known(*keys, since)).select(*keys, moment(since).alias("_t"), entry.alias("_r"), F.lit(False).alias("_asked"))
    nothing = F.lit(None).cast(offers.schema["_r"].dataType)
    asked = left.where(_known(*keys, at)).select(*keys, moment(at).alias("_t"), nothing.alias("_r"), F.lit(True).alias("_asked"))
    steps = offers.unionByName(asked).groupBy(*keys, "_t").agg(F.max("_r").alias("_r"), F.max("_asked").alias("_asked"))
    steps = steps.select(
        *keys, "_t", "_asked", F.floor(F.col("_t") / (bucket_seconds * MICROS)).alias("_b"),
        F.when(F.col("_r").isNotNull(), F.struct("_t", "_r")).alias("_e"),
    )
    inside = steps.withColumn("_e", F.last("_e", ignorenulls=True).over(Window.partitionBy(*keys, "_b").orderBy("_t")))
    # One row per key and bucket: as many for a key as its time has buckets.
    ends = steps.groupBy(*keys, "_b").agg(F.max("_e").alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_b", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    found = inside.where("_asked").join(carried, [*keys, "_b"]).select(*keys, "_t", F.coalesce("_e", "_carried").alias("_e"))
    if tolerance_seconds is not None:
        found = found.where(F.col("_t") - F.col("_e._t") <= tolerance_seconds * MICROS)
    joined = left.withColumn("_t", moment(at)).join(found, [*keys, "_t"], "left")
    return joined.select(*[F.col(c) for c in left.columns], *[F.col(f"_e._r.v{i}").alias(c) for i, c in enumerate(values)])


def _levels(length: Column) -> Column:
    """The least multiple of LEVEL_STEP for which 2 ** it is not below the length."""
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    return (F.ceil(bits / LEVEL_STEP) * LEVEL_STEP).cast("int")


def _binned(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """The intervals that are not empty with ``_s``, ``_e``, their level and one row per bin of it, two at most."""
    made = intervals.withColumns({"_s": moment(start), "_e": F.coalesce(moment(end), F.lit(FOREVER))}).where("_s < _e")
    made = made.withColumn("_level", _levels(F.col("_e") - F.col("_s")))
    return made.withColumn("_bin", F.explode(F.sequence(F.expr("shiftright(_s, _level)"), F.expr("shiftright(_e - 1, _level)"))))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """Every pair of a point and an interval of the same keys with ``start <= at < end``, once.

    The columns of ``points``, then the others of ``intervals``. A null end is open; intervals without a start
    or that end where they begin hold nothing, and null keys match nothing.

    An interval goes to the bins of the level that has about its length, so it lies in two bins at most
    however long it is, and long ones do not meet the points bin by bin. A point looks into one bin of
    every level that occurs. The join is on keys, level and bin: a hot key is spread over its bins.
    """
    binned = _binned(intervals.where(_known(*keys, start)), start, end)
    # 31 levels at most.
    levels = sorted(r[0] for r in binned.select("_level").distinct().collect()) or [0]
    known = points.where(_known(*keys, at)).withColumn("_at", moment(at))
    probes = known.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]))).withColumn("_bin", F.expr("shiftright(_at, _level)"))
    met = probes.join(binned, [*keys, "_level", "_bin"]).where("_s <= _at AND _at < _e")
    return met.select(*points.columns, *[c for c in intervals.columns if c not in points.columns])


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str]) -> DataFrame:
    """Every pair of intervals of the same keys that share a moment, once; columns as in ``interval_join``.

    Two intervals overlap where one begins inside the other: the right one inside the left one, or the left one
    inside the right one and later. Column names of the bounds have to differ between the sides.
    """
    (ls, le), (rs, re) = left_bounds, right_bounds
    columns = [*left.columns, *[c for c in right.columns if c not in left.columns]]

    def proper(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.where(F.col(e).isNull() | (moment(s) < moment(e)))

    first = interval_join(proper(right, rs, re), left, keys, rs, ls, le).select(*columns)
    second = interval_join(proper(left, ls, le), right, keys, ls, rs, re).select(*columns)
    return first.unionByName(second.where(moment(ls) > moment(rs)))


def validity(versions: DataFrame, keys: list[str], since: str, order: list[Column], until: str = "valid_until") -> DataFrame:
    """Versions with the moment at which the next one of the same keys replaces them, null for the last.

    Of versions of one moment the last in ``order`` is valid, the others never.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(since), *order)
    return versions.where(F.col(since).isNotNull()).withColumn(until, F.lead(since).over(w))
