"""One key holds most of the rows: results stay whole and no group is cut short."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake import operators as op

N = 60_000


def skewed(spark):
    """Two thirds of the rows belong to key 'hot', the others to 500 keys."""
    key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(0, N, 1, 16).withColumn("key", key)


def test_fallback_on_a_hot_asset(spark):
    df = skewed(spark).select(
        F.col("key").alias("asset_code"), F.lit(None).cast("string").alias("coupon"), F.col("id").cast("string").alias("coupon_alt")
    )
    one = df.withColumn("coupon", F.when((F.col("asset_code") == "hot") & (F.col("coupon_alt") == "1"), "9"))
    got = op.fallback_by_group(one).groupBy((F.col("asset_code") == "hot").alias("hot")).agg(F.count("coupon").alias("n")).collect()
    assert {r["hot"]: r["n"] for r in got} == {True: 1, False: N // 3}
    assert op.fallback_by_group(df).filter("coupon IS NULL").count() == 0


def test_dedup_with_a_hot_content(spark):
    df = skewed(spark).select("id", F.lit("f").alias("folder"), F.col("key").alias("file_hash"))
    catalog = df.filter("file_hash = 'k3'").select("folder", "file_hash")
    kept = op.dedup_content(df, catalog, [F.asc("id")])
    n_keys = df.select("file_hash").distinct().count()
    assert kept.count() == n_keys - 1
    assert kept.filter("file_hash = 'hot'").first()["id"] == 1


def test_top_rows_of_a_hot_issuer(spark):
    df = skewed(spark).select(F.col("id").alias("doc_id"), F.col("key").alias("issuer_cnpj"), F.lit("2024-01-01").alias("ref_date"))
    top = op.latest_documents(df, k=5)
    assert [r["doc_id"] for r in top.filter("issuer_cnpj = 'hot'").orderBy("rank").collect()] == [1, 2, 4, 5, 7]
    assert top.count() == 5 * df.select("issuer_cnpj").distinct().count()


def test_requests_for_one_ticker_and_without_keys(spark):
    asked = skewed(spark).select(
        F.col("id").alias("request_id"), F.when(F.col("key") == "hot", "T1").alias("ticker"),
        F.lit(None).cast("string").alias("issuer_cnpj"), F.lit(None).cast("string").alias("issuer_name"),
    )
    issuers = spark.createDataFrame([("1", "ACME", "X")], "issuer_cnpj string, issuer_name string, industry string")
    listing = spark.createDataFrame([("T1", "1")] * 1000, "asset_code string, issuer string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = op.resolve_issuer(asked, issuers, listing).groupBy("status").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["status"]: r["count"] for r in got} == {"OK": 2 * N // 3, "INVALID_INPUT": N // 3}


def test_sums_of_a_hot_group(spark):
    rows = skewed(spark).select(
        F.lit("Consolidado").alias("enr_aggregation_type"), F.col("key").alias("CNPJ_CIA"), F.lit("2024-03-31").cast("date").alias("DT_REFER"),
        F.lit("3.01").alias("CD_CONTA"), F.lit(0.1).alias("VL_CONTA"), F.lit("UNIDADE").alias("ESCALA_MOEDA"),
    )
    got = op.financials_quarterly(op.scale_amounts(rows)).filter("issuer_cnpj = 'hot'").first()
    assert got["revenue"] == 4000.0
