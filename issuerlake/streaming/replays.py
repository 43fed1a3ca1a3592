"""The provided tables run through the incremental jobs until all their files are consumed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from issuerlake.plans import fixtures as fx
from issuerlake.schemas import FINANCIALS_COLUMNS
from issuerlake.session import shared_dir
from issuerlake.streaming import jobs


def file_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The files of a table, which is one file or a folder of them: a pattern may name either, a plain path of a stream only a folder."""
    schema = fx.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def replay(spark: SparkSession, rows: DataFrame, key: str, start: Callable[[DataFrame], StreamingQuery], parts: int = 3) -> None:
    """The rows arrive in key order, in ``parts`` of as wide a range of keys; the job runs after each of them.

    A run takes all files that have landed as one batch, so neither the number of files nor the order in which the
    tasks of a part finish matters.
    """
    path = shared_dir(spark, "arriving")
    at = F.expr(key).cast("double")
    low, high = (x or 0 for x in rows.agg(F.min(at), F.max(at)).first())
    part = F.least(F.floor((at - low) * parts / (high - low + 1)), F.lit(parts - 1))
    for i in range(parts):
        rows.filter(F.coalesce(part, F.lit(0)) == i).write.mode("append").parquet(path)
        start(spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


def stream_ingest_documents(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "ingest")
    listed = fx.filings(spark, sf).select("doc_id", "folder", "file_hash", "object_path")
    replay(spark, listed, "doc_id", lambda objects: jobs.stream_ingest(objects, f"{root}/catalog", f"{root}/progress", [F.asc("doc_id")]))
    return spark.read.parquet(f"{root}/catalog").drop(jobs.STREAM_ID, jobs.BATCH_ID)


def stream_request_windows(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "requests")
    log = file_stream(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"))
    jobs.stream_request_log(log, f"{root}/windows", f"{root}/progress").awaitTermination()
    return spark.read.parquet(f"{root}/windows").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "endpoint", "n_requests"
    )


def replay_requests(spark: SparkSession, sf: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    def log(events: DataFrame) -> DataFrame:
        return events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"), "event_id")

    replay(spark, fx.table(spark, sf, "events"), "unix_micros(cast(ts AS timestamp))", lambda events: start(log(events)))


def shown(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def stream_sliding_requests(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "sliding")
    replay_requests(
        spark, sf, lambda log: jobs.stream_request_log(log, f"{root}/windows", f"{root}/progress", size="2 hours", slide="30 minutes")
    )
    return spark.read.parquet(f"{root}/windows").select(shown("window_start"), "endpoint", "n_requests")


def stream_sessions_of_requests(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "sessions")
    replay_requests(spark, sf, lambda log: jobs.stream_request_sessions(log, f"{root}/sessions", f"{root}/progress"))
    return spark.read.parquet(f"{root}/sessions").select(shown("session_start"), shown("session_end"), "endpoint", "n_requests")


def stream_documents_requested(spark: SparkSession, sf: str) -> DataFrame:
    """Documents land over a month, 2,591 seconds apart in order of their id; an event asks for one of the first two hundred."""
    root = shared_dir(spark, "matched")
    landed = file_stream(spark, sf, "documents").selectExpr("doc_id AS object_id", "timestamp_seconds(1704067200 + doc_id * 2591 % 2592000) AS landed_at")
    requests = file_stream(spark, sf, "events").selectExpr("event_id % 200 AS object_id", "event_id", "cast(ts AS timestamp) AS asked_at")
    jobs.stream_matched_requests(landed, requests, f"{root}/matched", f"{root}/progress").awaitTermination()
    return spark.read.parquet(f"{root}/matched").select("object_id", shown("landed_at"), "event_id", shown("asked_at"))


def stream_gold_from_statements(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "refresh")

    def refresh(lineitem: DataFrame) -> StreamingQuery:
        rows = fx.tagged_statements(spark, sf, lineitem)
        # Fifty issuers need few buckets.
        return jobs.stream_gold_refresh(rows, f"{root}/sums", f"{root}/gold", f"{root}/progress", issuer_buckets=8)

    replay(spark, fx.table(spark, sf, "lineitem"), "l_orderkey", refresh)
    return spark.read.parquet(f"{root}/gold").select("enr_aggregation_type", *FINANCIALS_COLUMNS)
