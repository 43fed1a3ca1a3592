"""Incremental jobs. Each takes a streaming DataFrame and returns the started query.

Batches are written under their batch id, so a batch that is run again after a failure replaces its own
output instead of adding to it. Partitions are replaced without a moment in which a stop loses them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from issuerlake.operators.catalog import dedup_content
from issuerlake.operators.checks import filter_last_exercise
from issuerlake.operators.common import same_keys
from issuerlake.operators.sinks import table_or_empty, write_gold
from issuerlake.operators.statements import GROUP_KEYS, account_sums, financials_of_sums, scale_amounts

STREAM_ID, BATCH_ID = "stream_id", "batch_id"
# The number of compacted rows, which no batch has.
COMPACTED = -1
SUM = "decimal(38,6)"
# Default number of issuer buckets; it has to stay the same for a table.
ISSUER_BUCKETS = 64


def stream_ingest(objects: DataFrame, catalog_path: str, checkpoint: str, order: list[Column]) -> StreamingQuery:
    """New objects only: content already in its folder is skipped, within the batch and against the catalog.

    The catalog table is the memory of what has landed, so no stream state grows with it. It is cut to the
    folders and hashes of the batch where it is scanned; only what the batch could repeat moves. Every batch
    adds a partition, named by stream and batch, as another stream on the same catalog counts its batches from 0
    as well. ``compact_catalog`` makes them one.
    """
    keys = ["folder", "file_hash"]
    schema = T.StructType([*objects.schema.fields, T.StructField(STREAM_ID, T.StringType()), T.StructField(BATCH_ID, T.LongType())])

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        stored = table_or_empty(session, catalog_path, schema, own=True)
        others = stored.filter(~(F.col(STREAM_ID).eqNullSafe(stream) & (F.col(BATCH_ID) == batch_id)))
        offered = batch.select(*keys).distinct()
        known = others.select(*keys).alias("o").join(offered.alias("b"), same_keys("o", "b", keys), "left_semi")
        new = dedup_content(batch, known, order).withColumns({STREAM_ID: F.lit(stream), BATCH_ID: F.lit(batch_id).cast("bigint")})
        write_gold(new, catalog_path, [STREAM_ID, BATCH_ID])

    return (
        objects.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def compact_catalog(spark: SparkSession, catalog_path: str, target: str) -> None:
    """The catalog with all its batches in one partition, written to ``target``, while no stream writes to it.

    The partition has the name of no batch, so a stream can go on with either table, and a batch that
    it runs again finds its objects in the catalog.
    """
    rows = spark.read.parquet(catalog_path)
    compacted = {STREAM_ID: F.lit("compacted"), BATCH_ID: F.lit(COMPACTED).cast("bigint")}
    write_gold(rows.withColumns(compacted), target, [STREAM_ID, BATCH_ID])


def _append(rows: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("append").format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_request_log(
    log: DataFrame, sink: str, checkpoint: str, ts: str = "ts", endpoint: str = "endpoint",
    size: str = "1 hour", delay: str = "10 minutes", slide: str | None = None,
) -> StreamingQuery:
    """Requests per endpoint and window; a window is written once the watermark has passed it.

    Windows follow each other, or with ``slide`` begin that far apart and overlap.
    """
    counts = (
        log.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide).alias("w"), endpoint)
        .agg(F.count(F.lit(1)).alias("n_requests"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), endpoint, "n_requests")
    )
    return _append(counts, sink, checkpoint)


def stream_request_sessions(
    log: DataFrame, sink: str, checkpoint: str, ts: str = "ts", endpoint: str = "endpoint",
    gap: str = "30 minutes", delay: str = "10 minutes",
) -> StreamingQuery:
    """Sessions per endpoint: requests that follow each other within ``gap``, with start, end (last request and gap) and number.

    A session that is open when a batch ends is state, one row each; a late request extends or joins sessions until the
    watermark has passed their end, then they are written. Each task merges its requests to sessions before they
    move, so an endpoint with most requests sends few rows.
    """
    log.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    sessions = (
        log.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap).alias("w"), endpoint)
        .agg(F.count(F.lit(1)).alias("n_requests"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), endpoint, "n_requests")
    )
    return _append(sessions, sink, checkpoint)


def stream_matched_requests(
    landed: DataFrame, requests: DataFrame, sink: str, checkpoint: str, key: str = "object_id", landed_at: str = "landed_at",
    asked_at: str = "asked_at", within: str = "1 day", delay: str = "10 minutes",
) -> StreamingQuery:
    """Landed objects with the requests for them ``within`` that time; an object without any is written once, with nulls.

    Both sides are state only as long as the other can still match: watermarks on both times and the time range
    bound it. Unmatched objects are written when the watermark has passed their last moment. The columns
    of the sides, but for the key, need different names.
    """
    asked = requests.withColumnRenamed(key, "_asked_key").withWatermark(asked_at, delay)
    near = F.expr(f"{key} = _asked_key AND {asked_at} >= {landed_at} AND {asked_at} < {landed_at} + INTERVAL {within}")
    return _append(landed.withWatermark(landed_at, delay).join(asked, near, "leftOuter").drop("_asked_key"), sink, checkpoint)


def add_up(sums: DataFrame, names: list[str]) -> DataFrame:
    """One row per group of the sums that batches have added."""
    return sums.groupBy(*GROUP_KEYS).agg(*[F.sum(c).cast(SUM).alias(c) for c in names])


def compact_sums(spark: SparkSession, sums: str, target: str) -> None:
    """The sums added up in one partition of ``target``, but for those of the last batch, while no stream writes to them.

    The last batch alone may run again; its partition stays, so that it can be replaced.
    """
    rows = spark.read.parquet(sums).withColumn(BATCH_ID, F.col(BATCH_ID).cast("bigint"))
    names = [c for c in rows.columns if c not in (*GROUP_KEYS, BATCH_ID)]
    last = rows.agg(F.max(BATCH_ID)).first()[0]
    older = add_up(rows.filter(F.col(BATCH_ID) < last), names).withColumn(BATCH_ID, F.lit(COMPACTED).cast("bigint"))
    write_gold(older.unionByName(rows.filter(F.col(BATCH_ID) == last)), target, [BATCH_ID])


def stream_gold_refresh(
    statements: DataFrame, sums: str, gold: str, checkpoint: str, issuer_buckets: int = ISSUER_BUCKETS
) -> StreamingQuery:
    """Gold metrics kept current: account sums are additive, so each batch's sums are added to the stored ones.

    ``sums`` belongs to one stream and holds one row per aggregation type, issuer, date and batch, whatever the number of statements behind
    it: a batch adds a partition and rewrites none, and one that is run again after a failure replaces its own.
    ``compact_sums`` adds up what has gathered. Of gold a batch rewrites the buckets of the issuers it has rows of.
    """

    def bucket(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(issuer_buckets)).cast("int")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        added = account_sums(filter_last_exercise(scale_amounts(batch)))
        names = [c for c in added.columns if c not in GROUP_KEYS]
        added = added.select(*GROUP_KEYS, *[F.col(c).cast(SUM).alias(c) for c in names]).withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
        write_gold(added, sums, [BATCH_ID])
        stored = table_or_empty(session, sums, added.schema, own=True).withColumn("issuer_bucket", bucket("CNPJ_CIA"))
        # As many rows as there are buckets at most.
        touched = stored.filter(F.col(BATCH_ID) == batch_id).select("issuer_bucket").distinct()
        total = add_up(stored.join(F.broadcast(touched), "issuer_bucket", "left_semi"), names)
        write_gold(financials_of_sums(total).withColumn("issuer_bucket", bucket("issuer_cnpj")), gold, ["issuer_bucket"])

    return (
        statements.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
