"""Summaries that can be merged: distinct counts, percentiles, and digests on several levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuerlake.operators.sinks import table_or_empty, write_gold
from issuerlake.session import shared_dir

# 2 ** 12 registers: a standard error of about 1.6 %.
HLL_BITS = 12
KLL_K = 400
# Cuts of a pass of the exact selection, and values of a group at which it sorts what is left.
CUTS, SORTED = 256, 10_000


# --- distinct counts -----------------------------------------------------------------------------


def distinct_sketches(rows: DataFrame, by: list[str], value: str, bits: int = HLL_BITS) -> DataFrame:
    """``by``, n_rows and a sketch of the distinct values; nulls are no value. Sketches are made where the rows lie."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.col(value).cast("string"), bits).alias("sketch"))


def add_sketches(spark: SparkSession, path: str, sketches: DataFrame, partition: str) -> None:
    """Merge a batch's sketches into the table at ``path``; only the partitions of the batch are rewritten.

    Rows that are added a second time do not count as distinct again, but as rows: add a batch once.
    """
    stored = table_or_empty(spark, path, sketches.schema, own=True)
    touched = stored.join(sketches.select(partition).distinct(), partition, "left_semi")
    by = [c for c in sketches.columns if c not in ("n_rows", "sketch")]
    merged = touched.unionByName(sketches).groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))
    write_gold(merged.select(*sketches.columns), path, [partition])


def distinct_estimates(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """Rows and estimated distinct values per ``by``, from the sketches of any parts of it."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"), F.count(F.lit(1)).alias("n_sketches")
    )


# --- percentiles ---------------------------------------------------------------------------------


def _same(a: str, b: str, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns], F.lit(True))


def _below(bounds: str, value: str, at_most: int) -> Column:
    """How many of the ascending ``bounds``, ``at_most`` of them, are below the value: a search by halves."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, at_most.bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(bounds, n + s - 1) < F.col(value), n + s).otherwise(n))


def exact_percentiles(
    rows: DataFrame, group: list[str], value: str, percents: list[int], cuts: int = CUTS, sorted_rows: int = SORTED
) -> DataFrame:
    """``group``, percent, n and the exact ``value`` of rank ceil(percent * n / 100), the first for 0. Nulls and NaN do not count.

    A group of any size is never sorted in one place. Every pass cuts the range in which a wanted rank lies at
    approximate percentiles, counts the rows between the cuts exactly, and goes on with the part that holds the rank: about
    1 / ``cuts`` of the rows. When the part is one value, or has at most ``sorted_rows`` rows, its distinct
    values are added up in order. The rows are computed once and their groups and values written, which every pass reads;
    what passes between two passes has a row per group and percent, and is written too.
    """
    spark, v = rows.sparkSession, F.col(value)
    root, step = shared_dir(spark, "percentiles"), 0
    rows.where(v.isNotNull() & ~F.isnan(v.cast("double"))).select(*group, v.alias("_v")).write.parquet(f"{root}/values")
    known = spark.read.parquet(f"{root}/values")
    kind = known.schema["_v"].dataType
    sizes = known.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    rank = F.greatest(F.lit(1), F.ceil(F.col("percent") * F.col("n") / 100)).cast("bigint")
    # ``_low`` lies below the part and ``_high`` is its greatest value; ``_rank`` counts inside it.
    state = sizes.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents]))).select(
        *group, "percent", "n", rank.alias("_rank"), F.lit(None).cast(kind).alias("_low"), F.col("_max").alias("_high"),
        F.col("n").alias("_left"), (F.col("_min") == F.col("_max")).alias("_done"),
    )
    part_of = [*group, "_low"]
    while True:
        path = f"{root}/{step}"
        state.write.parquet(path)
        state = spark.read.parquet(path)
        open_parts = state.where(~F.col("_done")).select(*part_of, "_high", "_left").distinct()
        large = open_parts.where(F.col("_left") > sorted_rows)
        done = large.isEmpty()
        ranges = (open_parts if done else large).alias("p")
        inside = (F.col("p._low").isNull() | (F.col("r._v") > F.col("p._low"))) & (F.col("r._v") <= F.col("p._high"))
        rows_in = known.alias("r").join(ranges, _same("r", "p", group) & inside).select("p.*", "r._v")
        if done:
            counted = rows_in.groupBy(*part_of, F.col("_v").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
            counted = counted.withColumns({"_top": F.col("_k"), "_next": F.col("_k")})
        else:
            share = [i / cuts for i in range(1, cuts)]
            bounds = rows_in.groupBy(*part_of).agg(F.array_distinct(F.percentile_approx("_v", share, 10 * cuts)).alias("_bounds"))
            # A row per part: once written, its size is known, and the rows do not move to meet it.
            bounds.write.parquet(f"{path}-cuts")
            bounds = spark.read.parquet(f"{path}-cuts")
            cut = rows_in.alias("r").join(bounds.alias("b"), _same("r", "b", part_of)).select("r.*", "b._bounds")
            # A cut is a part of its own, so that a value that most rows have leaves few between the cuts.
            cut = cut.withColumn("_place", _below("_bounds", "_v", cuts - 1))
            place = F.col("_place")
            exact = F.coalesce(F.get("_bounds", place) == F.col("_v"), F.lit(False)).cast("int")
            below = F.when(place > 0, F.element_at("_bounds", place)).otherwise(F.col("_low"))
            placed = cut.select(*part_of, "_v", (2 * place + exact).alias("_k"), below.alias("_next"))
            counted = placed.groupBy(*part_of, "_k", "_next").agg(
                F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_top"), (F.min("_v") == F.max("_v")).alias("_one")
            )
        # At most ``cuts`` rows of a part, or its ``sorted_rows`` values.
        running = counted.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*part_of).orderBy("_k"))).alias("c")
        chosen = F.col("c._upto").isNotNull() & (F.col("c._upto") >= F.col("s._rank")) & (F.col("c._upto") - F.col("c._n") < F.col("s._rank"))
        met = state.alias("s").join(running, _same("s", "c", part_of) & ~F.col("s._done") & chosen, "left")
        hit = F.col("c._n").isNotNull()
        state = met.select(
            *[F.col(f"s.{c}") for c in (*group, "percent", "n")],
            F.when(hit, F.col("s._rank") - (F.col("c._upto") - F.col("c._n"))).otherwise(F.col("s._rank")).alias("_rank"),
            F.when(hit, F.col("c._next")).otherwise(F.col("s._low")).alias("_low"),
            F.when(hit, F.col("c._top")).otherwise(F.col("s._high")).alias("_high"),
            F.when(hit, F.col("c._n")).otherwise(F.col("s._left")).alias("_left"),
            (F.col("s._done") | (hit & (F.lit(True) if done else F.col("c._one")))).alias("_done"),
        )
        if done:
            return state.select(*group, "percent", "n", F.col("_high").alias(value))
        step += 1


def percentile_sketches(rows: DataFrame, group: list[str], value: str, k: int = KLL_K) -> DataFrame:
    """``group`` and a sketch of the values, to be stored and merged with others of the group."""
    v = F.col(value).cast("double")
    return rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*group).agg(F.kll_sketch_agg_double(v, k).alias("sketch"))


def approximate_percentiles(sketches: DataFrame, group: list[str], percents: list[int], value: str = "value") -> DataFrame:
    """``group``, percent, n and the approximate value, from any number of sketches of a group.

    Its rank is off by under 1 % of n with k = 400, most of the time; ``exact_percentiles`` is the exact form.
    """
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    found = F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(p / 100) for p in percents])).alias("_v")
    each = F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in percents]).alias("percent"), "_v")).alias("_e")
    rows = merged.select(*group, F.kll_sketch_get_n_double("_s").alias("n"), found).select(*group, "n", each)
    return rows.select(*group, "_e.percent", "n", F.col("_e._v").alias(value))


# --- levels --------------------------------------------------------------------------------------


def digest_levels(catalog: DataFrame, keys: list[str], levels: list[list[str]] | None = None, title: str = "title") -> DataFrame:
    """Documents and distinct titles on several levels of the keys at once, all of them unless ``levels`` names some.

    ``level`` has a bit for every key that the row adds up over, the first key's the highest; it tells such a
    total from a key that is null. Rows are combined per keys and title first, and what is left is expanded.
    """
    per_title = catalog.groupBy(*keys, title).agg(F.count(F.lit(1)).alias("_n"))
    grouped = per_title.cube(*keys) if levels is None else per_title.groupingSets([[F.col(c) for c in x] for x in levels], *keys)
    return grouped.agg(
        F.grouping_id(*keys).cast("int").alias("level"), F.sum("_n").alias("n_documents"), F.count_distinct(title).alias("n_titles")
    )
