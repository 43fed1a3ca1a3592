"""Joins along time, frames and summaries against brute force, with gaps, ties, nulls and hot keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from issuerlake import operators as op

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


# --- as-of join --------------------------------------------------------------------------------


def asof_rows(n, seed):
    rng = random.Random(seed)
    keys = ["hot", "hot", "b", "c", None]
    left = [(i, rng.choice(keys), at(rng.choice([None, *range(-50, 3000, 7)]))) for i in range(n)]
    right = [(rng.choice(keys[:3] + [None]), at(rng.choice([None, *range(0, 2500, 3)])), rng.choice([None, 1, 2, 3]), rng.random()) for _ in range(n)]
    return left, right


@pytest.mark.parametrize("bucket,tolerance", [(60, None), (86_400 * 365, None), (600, 3600)])
def test_asof_join_equals_brute_force(spark, bucket, tolerance):
    left, right = asof_rows(400, 3)
    left += left[:5]
    a = spark.createDataFrame(left, "id int, k string, at timestamp").repartition(5)
    b = spark.createDataFrame(right, "k string, since timestamp, tie int, price double").repartition(4)
    got = op.asof_join(a, b, ["k"], "at", "since", ["since", "price"], ties=["tie"], bucket_seconds=bucket, tolerance_seconds=tolerance)
    want = []
    for i, k, t in left:
        fits = [(s, -1 if tie is None else tie, p) for key, s, tie, p in right if k is not None and key == k and t is not None and s is not None and s <= t]
        best = max(fits, default=None)
        if best and tolerance is not None and (t - best[0]).total_seconds() > tolerance:
            best = None
        want.append((i, k, t, best[0] if best else None, best[2] if best else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_asof_join_of_a_hot_key(spark):
    """One key with most rows, at few moments of few days: what moves is one row per moment, and a bucket's rows meet in a task."""
    n = 200_000
    left = spark.range(0, n, 1, 8).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                          F.expr("timestamp_micros((id % 500) * 600000000)").alias("at"))
    right = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                           F.expr("timestamp_micros((id % 250) * 1200000000)").alias("since"), F.col("id").alias("v"))
    got = op.asof_join(left, right, ["k"], "at", "since", ["v"], bucket_seconds=86_400)
    assert got.count() == n and got.filter("k = 'hot' AND v IS NULL").count() == 0
    top = {(r["k"], r["m"]): r["v"] for r in right.groupBy("k", (F.unix_micros("since") / 600000000).cast("int").alias("m")).agg(F.max("v").alias("v")).collect()}
    for r in got.filter("k = 'hot' AND id < 3000").select("id", "v").collect():
        assert r["v"] == top["hot", r["id"] % 500 // 2 * 2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(_r" in plan and "hashpartitioning(k#" in plan and "_b#" in plan


def test_asof_join_of_empty_tables(spark):
    a = spark.createDataFrame([(1, "x", at(1))], "id int, k string, at timestamp")
    b = spark.createDataFrame([], "k string, since timestamp, price double")
    assert [tuple(r) for r in op.asof_join(a, b, ["k"], "at", "since", ["price"]).collect()] == [(1, "x", at(1), None)]
    assert op.asof_join(a.limit(0), b, ["k"], "at", "since", ["price"]).count() == 0


# --- interval joins ----------------------------------------------------------------------------


def interval_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.choice([None, *range(-500, 2500)]) if i % 20 else None
        length = rng.choice([0, 1, 2, 3, 60, 300, 5000, -4])
        out.append((i, rng.choice(["hot", "hot", "b", None]), at(s), None if i % 9 == 0 else at(None if s is None else s + length)))
    return out


def test_interval_join_equals_brute_force(spark):
    intervals = interval_rows(150, 5)
    rng = random.Random(6)
    points = [(i, rng.choice(["hot", "hot", "b", None]), at(rng.choice([None, *range(-600, 6000, 11)]))) for i in range(300)]
    p = spark.createDataFrame(points + points[:3], "pid int, k string, t timestamp").repartition(4)
    q = spark.createDataFrame(intervals, "iid int, k string, s timestamp, e timestamp").repartition(3)
    got = op.interval_join(p, q, ["k"], "t", "s", "e")
    want = [(i, k, t, j, s, e) for i, k, t in points + points[:3] for j, l, s, e in intervals
            if k is not None and k == l and t is not None and s is not None and s <= t and (e is None or t < e)]
    assert got.columns == ["pid", "k", "t", "iid", "s", "e"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 300
    assert op.interval_join(p, q.limit(0), ["k"], "t", "s", "e").count() == op.interval_join(p.limit(0), q, ["k"], "t", "s", "e").count() == 0


def test_overlap_join_equals_brute_force(spark):
    a, b = interval_rows(120, 7), interval_rows(110, 8)
    p = spark.createDataFrame(a, "aid int, k string, s1 timestamp, e1 timestamp").repartition(4)
    q = spark.createDataFrame(b, "bid int, k string, s2 timestamp, e2 timestamp").repartition(3)
    got = op.overlap_join(p, q, ["k"], ("s1", "e1"), ("s2", "e2")).select("aid", "bid")
    far = dt.datetime(9999, 1, 1)
    want = [(i, j) for i, k, s, e in a for j, m, t, f in b if k is not None and k == m and s is not None and t is not None
            and s < (e or far) and t < (f or far) and s < (f or far) and t < (e or far)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 200


def test_long_intervals_lie_in_few_bins(spark):
    """Intervals of a second and of a century: two bins each, whatever their length; a hot key is spread over the bins."""
    q = spark.range(2000).selectExpr("'hot' AS k", "id AS iid", "timestamp_seconds(id * 100) AS s",
                                     "timestamp_seconds(id * 100 + CASE WHEN id % 100 = 0 THEN 3000000000 ELSE 1 END) AS e")
    from issuerlake.operators import temporal

    binned = temporal._binned(q, "s", "e")
    assert binned.groupBy("iid").count().agg(F.max("count")).first()[0] <= 2
    assert binned.filter("iid % 100 > 0").groupBy("_level", "_bin").count().agg(F.max("count")).first()[0] <= 2
    points = spark.range(20_000).selectExpr("'hot' AS k", "id", "timestamp_seconds(id * 10) AS t")
    found = op.interval_join(points, q, ["k"], "t", "s", "e")
    want = sum(i // 1000 + 1 for i in range(20_000)) + sum(1 for i in range(20_000) if i % 10 == 0 and i // 10 % 100 > 0)
    assert found.count() == want


def test_validity_of_versions(spark):
    rows = spark.createDataFrame([("a", 1, at(0)), ("a", 2, at(5)), ("a", 3, at(5)), ("b", 4, None), ("b", 5, at(9))], "k string, v int, s timestamp")
    got = sorted(map(tuple, op.validity(rows, ["k"], "s", [F.asc("v")], "e").select("v", "e").collect()))
    assert got == [(1, at(5)), (2, at(5)), (3, None), (5, None)]


# --- frames ------------------------------------------------------------------------------------


def test_quarters_and_trailing_years(spark):
    d = lambda y, q, day=28: dt.date(y, 3 * q, day)
    ytd = {(2023, 1): 10, (2023, 2): 30, (2023, 3): 60, (2023, 4): 100, (2024, 1): 12, (2024, 3): 70, (2024, 4): 115, (2025, 1): 0}
    rows = [("Consolidado", "x", d(*k), float(v), None if k == (2023, 2) else 1.0) for k, v in ytd.items()]
    rows += [("Consolidado", "x", d(2023, 4, 5), 1e9, 1.0), ("Consolidado", "x", None, 5.0, 1.0), ("Individual", "x", d(2023, 2), 7.0, 7.0)]
    df = spark.createDataFrame(rows, "enr_aggregation_type string, issuer_cnpj string, date date, revenue double, ebit double")
    got = {(r["enr_aggregation_type"][0], r["date"].year, r["date"].month // 3): r for r in op.quarterly_flows(df, ["revenue", "ebit"]).collect()}
    assert len(got) == 9
    flows = {k[1:]: (r["revenue_quarter"], r["revenue_ttm"]) for k, r in got.items() if k[0] == "C"}
    assert flows == {(2023, 1): (10, None), (2023, 2): (20, None), (2023, 3): (30, None), (2023, 4): (40, 100), (2024, 1): (12, 102),
                     (2024, 3): (None, None), (2024, 4): (45, None), (2025, 1): (0, None)}
    assert got["C", 2024, 1]["revenue_yoy"] == pytest.approx(0.2) and got["C", 2024, 4]["revenue_yoy"] == pytest.approx(0.125)
    assert got["C", 2025, 1]["revenue_yoy"] == -1.0 and got["I", 2023, 2]["revenue_quarter"] is None
    assert got["C", 2023, 3]["ebit_quarter"] is None and got["C", 2023, 4]["ebit_ttm"] is None
    single = {r["date"].month // 3: r["revenue_ttm"] for r in op.quarterly_flows(df.filter("year(date) = 2023"), ["revenue"], year_to_date=False).collect() if r["enr_aggregation_type"] == "Consolidado"}
    assert single[4] == 200.0


# --- summaries ---------------------------------------------------------------------------------


def test_sketches_merge_and_measure_their_error(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('s', id % 7) END AS source", "date_add(date'2024-01-01', cast(id % 40 as int)) AS day",
        "CASE WHEN id % 11 > 0 THEN id * 7919 % 20011 END AS value",
    )
    path = str(tmp_path / "sketches")
    for b in range(4):
        part = rows.filter(F.pmod(F.xxhash64("value", "day"), F.lit(4)) == b)
        op.add_sketches(spark, path, op.distinct_sketches(part, ["day", "source"], "value"), "day")
    got = {r["source"]: r for r in op.distinct_estimates(spark.read.parquet(path), ["source"]).collect()}
    exact = {r["source"]: (r["n"], r["d"]) for r in rows.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("value").alias("d")).collect()}
    assert {k: r["n_rows"] for k, r in got.items()} == {k: n for k, (n, _) in exact.items()}
    errors = [abs(got[k]["n_distinct"] - d) / d for k, (_, d) in exact.items()]
    assert max(errors) < 0.05 and sum(errors) / len(errors) < 0.025
    whole = op.distinct_estimates(spark.read.parquet(path).filter("day < '2024-01-11'"), []).first()
    span = rows.filter("day < '2024-01-11'").agg(F.count_distinct("value")).first()[0]
    assert abs(whole["n_distinct"] - span) <= 0.05 * span
    again = op.distinct_sketches(rows, ["day", "source"], "value").drop("n_rows").withColumn("n_rows", F.lit(0).cast("bigint"))
    op.add_sketches(spark, path, again.select("day", "source", "n_rows", "sketch"), "day")
    # Sketches of the same rows once more: estimates stay within their error.
    for r in op.distinct_estimates(spark.read.parquet(path), ["source"]).collect():
        n, d = exact[r["source"]]
        assert r["n_rows"] == n and abs(r["n_distinct"] - d) < 0.05 * d


@pytest.mark.parametrize("cuts,few", [(256, 10_000), (4, 5), (16, 50)])
def test_exact_percentiles_equal_brute_force(spark, cuts, few):
    rng = random.Random(2)
    groups = {
        "hot": [rng.choice([5.0, 5.0, 5.0, rng.gauss(0, 1), 1e300, -1e-300]) for _ in range(3000)], "one": [3.5], "same": [7.0] * 500, None: [float(i * i) for i in range(900)],
        "few": [1.0] + [2.0] * 800 + [3.0, 4.0], "low": [0.0] * 3 + [float(-(2**i)) for i in range(200)] + [9.0] * 700,
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    percents = [0, 1, 50, 90, 100]
    got = {(r["g"], r["percent"]): (r["n"], r["v"]) for r in op.exact_percentiles(df, ["g"], "v", percents, cuts, few).collect()}
    assert got == {(g, p): (len(vs), sorted(vs)[max(1, -(-p * len(vs) // 100)) - 1]) for g, vs in groups.items() for p in percents}


def test_exact_percentiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert op.exact_percentiles(df, ["g"], "v", [50]).count() == 0


def test_sketched_percentiles_have_a_small_rank_error(spark):
    rows = spark.range(0, 90_000, 1, 8).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('g', id % 5) END AS g", "id % 16 AS part", "cast(id * 7919 % 90001 as double) AS v")
    sketches = op.percentile_sketches(rows, ["g", "part"], "v")
    assert sketches.count() > 16
    for r in op.approximate_percentiles(sketches, ["g"], [1, 50, 99], "v").collect():
        values = rows.filter(F.col("g") == r["g"])
        below, n = values.filter(F.col("v") <= r["v"]).count(), values.count()
        assert r["n"] == n and abs(below - r["percent"] * n / 100) <= 0.01 * n + 1


def test_levels_tell_totals_from_nulls(spark):
    rows = spark.createDataFrame([("d1", "a", "t1"), ("d1", None, "t1"), ("d1", "a", "t2"), ("d2", None, None)], "day string, source string, title string")
    got = {(r["day"], r["source"], r["level"]): (r["n_documents"], r["n_titles"]) for r in op.digest_levels(rows, ["day", "source"]).collect()}
    assert got == {
        ("d1", "a", 0): (2, 2), ("d1", None, 0): (1, 1), ("d2", None, 0): (1, 0), ("d1", None, 1): (3, 2), ("d2", None, 1): (1, 0),
        (None, "a", 2): (2, 2), (None, None, 2): (2, 1), (None, None, 3): (4, 2),
    }
    some = op.digest_levels(rows, ["day", "source"], [["day", "source"], []])
    assert {r["level"] for r in some.collect()} == {0, 3}
    hot = spark.range(0, 50_000, 1, 8).selectExpr("'d' AS day", "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('s', id % 9) END AS source", "concat('t', id % 1000) AS title")
    assert {(r["n_documents"], r["n_titles"]) for r in op.digest_levels(hot, ["day", "source"]).filter("level = 3").collect()} == {(50_000, 1000)}


# --- multisets ---------------------------------------------------------------------------------


def test_multisets_equal_counters(spark, monkeypatch):
    from collections import Counter

    from issuerlake.operators import multisets

    monkeypatch.setattr(multisets, "COPIES", 7)
    rng = random.Random(4)
    rows = lambda n: [(rng.choice(["a", "b", None]), rng.choice([1.0, float("nan"), None]), rng.choice([dt.date(2024, 1, 1), None])) for _ in range(n)]
    key = lambda r: tuple("nan" if x != x else x for x in r)
    left, right = rows(120) + [("hot", 1.0, None)] * 500, rows(90) + [("hot", 1.0, None)] * 333
    schema = "k string, v double, d date"
    a, b = spark.createDataFrame(left, schema).repartition(4), spark.createDataFrame(right, schema).select("d", "k", "v").repartition(3)
    x, y = Counter(map(key, left)), Counter(map(key, right))
    both, more = op.multiset_intersect(a, b), op.multiset_difference(a, b)
    assert both.columns == more.columns == ["k", "v", "d"]
    assert Counter(key(r) for r in both.collect()) == x & y and (x & y)["hot", 1.0, None] == 333
    assert Counter(key(r) for r in more.collect()) == x - y
    found = {key(r[:3]): tuple(r[3:]) for r in op.reconcile(a, b).collect()}
    assert found == {k: (x[k], y[k]) for k in x | y if x[k] != y[k]}
    assert op.reconcile(a, a).count() == 0 and op.multiset_intersect(a, b.limit(0)).count() == 0
    assert Counter(key(r) for r in op.multiset_difference(a, b.limit(0)).collect()) == x
    with pytest.raises(ValueError, match="different columns"):
        op.copies(a, b.drop("v"))


# --- balances ----------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket,start", [(60, 0), (3600, 500), (86_400 * 365, 20)])
def test_running_balance_equals_a_loop(spark, bucket, start):
    from decimal import Decimal

    rng = random.Random(5)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), at(rng.choice([None, *range(-200, 3000)])), rng.choice([None, *range(-40, 36)])) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, c int").repartition(5)
    got = op.running_balance(df, ["k"], "t", ["id"], F.col("c") / 100, F.lit(start) / 100, bucket)
    assert got.columns == ["id", "k", "t", "c", "balance"]
    want, now = {}, {}
    for i, k, t, c in sorted((r for r in rows if None not in r), key=lambda r: (r[2], r[0])):
        now[k] = max(0, now.get(k, start) + c)
        want[i] = Decimal(now[k]) / 100
    assert {r["id"]: r["balance"] for r in got.collect()} == want and 0 in want.values()


def test_cash_flows_of_a_hot_asset(spark):
    from decimal import Decimal

    d = lambda m, day=3: dt.date(2024, m, day)
    rows = [("a", d(1), "paid_in", 100), ("a", d(1, 9), "interest", 2), ("a", d(2), "amortized", 30), ("a", d(4), "amortized", 90), ("a", d(5), "paid_in", 5),
            ("b", d(2), "amortized", 7), (None, d(2), "paid_in", 7), ("b", None, "paid_in", 7), ("b", d(2), "interest", None)]
    rows += [("hot", d(1 + i % 12), "paid_in", 1) for i in range(3000)]
    got = op.cash_flow_table(spark.createDataFrame(rows, "asset_code string, event_date date, kind string, amount int").repartition(4)).collect()
    table = {(r["asset_code"], r["period"].month): tuple(r)[2:] for r in got}
    assert table["a", 1] == (0, 100, 2, 0, 100) and table["a", 2] == (100, 0, 0, 30, 70) and table["a", 4] == (70, 0, 0, 70, 0)
    assert table["a", 5] == (0, 5, 0, 0, 5) and table["b", 2] == (0, 0, 0, 0, 0) and len(table) == 17
    assert table["hot", 12] == (Decimal(2750), 250, 0, 0, 3000)
    assert op.cash_flow_table(spark.createDataFrame([], "asset_code string, event_date date, kind string, amount int")).count() == 0


def test_exact_percentiles_compute_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    rows = spark.range(0, 3000, 1, 4).select(F.lit("g").alias("g"), F.udf(count, "bigint").asNondeterministic()("id").alias("v"))
    got = {r["percent"]: r["v"] for r in op.exact_percentiles(rows, ["g"], "v", [1, 50, 100], 16, 20).collect()}
    assert got == {1: 29, 50: 1499, 100: 2999} and seen.value == 3000
