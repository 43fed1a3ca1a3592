from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from issuerlake import operators as op
from issuerlake import streaming as st
from issuerlake.streaming import replays

OBJECT = "doc_id bigint, folder string, file_hash string"


def land(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def read(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def test_ingest_over_several_batches_and_runs(spark, tmp_path):
    landing, catalog, progress = (str(tmp_path / n) for n in ("in", "catalog", "progress"))

    def run():
        st.stream_ingest(read(spark, landing, OBJECT), catalog, progress, [F.asc("doc_id")]).awaitTermination()
        return sorted(r["doc_id"] for r in spark.read.parquet(catalog).collect())

    land(spark, landing, [(2, "f", "h"), (1, "f", "h"), (3, "g", "h")], OBJECT)
    assert run() == [1, 3]
    land(spark, landing, [(4, "f", "h"), (5, "f", "k")], OBJECT)
    land(spark, landing, [(6, "f", "k")] * 50 + [(7, "g", "k")], OBJECT)
    got = run()
    assert len(got) == 4 and got[:2] == [1, 3] and got[-1] == 7 and got[2] in (5, 6)
    assert run() == got
    st.stream_ingest(read(spark, landing, OBJECT), catalog, str(tmp_path / "fresh"), [F.asc("doc_id")]).awaitTermination()
    hashes = [(r["folder"], r["file_hash"]) for r in spark.read.parquet(catalog).collect()]
    assert len(hashes) == len(set(hashes))


def test_request_windows_close_behind_the_watermark(spark, tmp_path):
    schema = "ts timestamp, endpoint string"
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    land(spark, landing, [(t(9, 5), "a"), (t(9, 59), "a"), (t(9, 7), "b"), (t(10, 30), "a")], schema)
    st.stream_request_log(read(spark, landing, schema), sink, progress).awaitTermination()
    got = sorted((r["endpoint"], r["window_start"].hour, r["n_requests"]) for r in spark.read.parquet(sink).collect())
    assert got == [("a", 9, 2), ("b", 9, 1)]
    land(spark, landing, [(t(9, 10), "a"), (t(12, 0), "a")], schema)  # the first is too late
    st.stream_request_log(read(spark, landing, schema), sink, progress).awaitTermination()
    got = sorted((r["endpoint"], r["window_start"].hour, r["n_requests"]) for r in spark.read.parquet(sink).collect())
    assert got == [("a", 9, 2), ("a", 10, 1), ("b", 9, 1)]


STATEMENT = "enr_aggregation_type string, CNPJ_CIA string, DT_REFER date, ORDEM_EXERC string, CD_CONTA string, VL_CONTA double, ESCALA_MOEDA string"


def test_gold_refresh_equals_one_pass(spark, tmp_path):
    landing, history, gold, progress = (str(tmp_path / n) for n in ("in", "history", "gold", "progress"))
    d = dt.date(2024, 3, 31)
    batches = [
        [("Consolidado", f"c{i}", d, "ÚLTIMO", "3.01", float(i), "MIL") for i in range(20)],
        [("Consolidado", "c3", d, "ÚLTIMO", "3.01", 100.0, "UNIDADE"), ("Consolidado", "c3", d, "PENÚLTIMO", "3.01", 7.0, "MIL")],
        [("Individual", "c4", dt.date(2024, 6, 30), "ÚLTIMO", "1.01.01", 5.0, "MIL")],
    ]
    for batch in batches:
        land(spark, landing, batch, STATEMENT)
        st.stream_gold_refresh(read(spark, landing, STATEMENT), history, gold, progress, issuer_buckets=8).awaitTermination()
    everything = spark.createDataFrame([r for b in batches for r in b], STATEMENT)
    want = op.financials_quarterly(op.filter_last_exercise(op.scale_amounts(everything)))
    got = spark.read.parquet(gold).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_gold_refresh_adds_a_batch_once(spark, tmp_path):
    landing, sums, gold = (str(tmp_path / n) for n in ("in", "sums", "gold"))
    land(spark, landing, [("Consolidado", f"c{i}", dt.date(2024, 3, 31), "ÚLTIMO", "3.01", 1.0, "MIL") for i in range(5)], STATEMENT)
    # The same batch under the same number again, as after a failure that lost the progress of the stream.
    for progress in ("one", "two"):
        st.stream_gold_refresh(read(spark, landing, STATEMENT), sums, gold, str(tmp_path / progress)).awaitTermination()
    assert {r["revenue"] for r in spark.read.parquet(gold).collect()} == {1000.0}
    stored = spark.read.parquet(sums)
    assert stored.count() == 5


def test_compacted_catalog_serves_the_stream(spark, tmp_path):
    landing, catalog, compact, progress = (str(tmp_path / n) for n in ("in", "catalog", "compact", "progress"))
    for i in range(3):
        land(spark, landing, [(i, "f", f"h{i}"), (10 + i, "f", "h0")], OBJECT)
        st.stream_ingest(read(spark, landing, OBJECT), catalog, progress, [F.asc("doc_id")]).awaitTermination()
    st.compact_catalog(spark, catalog, compact)
    assert spark.read.parquet(compact).select("batch_id").distinct().count() == 1
    land(spark, landing, [(20, "f", "h1"), (21, "f", "h9")], OBJECT)
    st.stream_ingest(read(spark, landing, OBJECT), compact, progress, [F.asc("doc_id")]).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(compact).collect()) == [0, 1, 2, 21]



def test_last_batch_may_run_again_after_compaction(spark, tmp_path):
    """The commit of the last batch was not written: the stream runs it again on the compacted catalog."""
    landing, catalog, compact, progress = (str(tmp_path / n) for n in ("in", "catalog", "compact", "progress"))
    for i in range(2):
        land(spark, landing, [(10 * i + n, "f", f"h{i}{n}") for n in range(10)], OBJECT)
        st.stream_ingest(read(spark, landing, OBJECT), catalog, progress, [F.asc("doc_id")]).awaitTermination()
    st.compact_catalog(spark, catalog, compact)
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).rename(tmp_path / f"gone{name}")
    st.stream_ingest(read(spark, landing, OBJECT), compact, progress, [F.asc("doc_id")]).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(compact).collect()) == list(range(20))


def test_streams_share_a_catalog(spark, tmp_path):
    """Batches of two streams have the same numbers, and do not replace each other."""
    catalog = str(tmp_path / "catalog")
    for n, name in enumerate(("a", "b")):
        land(spark, str(tmp_path / name), [(n, "f", f"h{n}"), (5 + n, "f", "h9")], OBJECT)
        st.stream_ingest(read(spark, str(tmp_path / name), OBJECT), catalog, str(tmp_path / f"p{n}"), [F.asc("doc_id")]).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(catalog).collect()) == [0, 1, 5]


def test_compacted_sums_serve_the_stream(spark, tmp_path):
    landing, sums, compact, gold, progress = (str(tmp_path / n) for n in ("in", "sums", "compact", "gold", "progress"))
    for v in (1.0, 2.0, 4.0):
        land(spark, landing, [("Consolidado", "c", dt.date(2024, 3, 31), "ÚLTIMO", "3.01", v, "UNIDADE")], STATEMENT)
        st.stream_gold_refresh(read(spark, landing, STATEMENT), sums, gold, progress).awaitTermination()
    st.compact_sums(spark, sums, compact)
    assert spark.read.parquet(compact).count() == 2
    for name in ("2", ".2.crc"):
        (tmp_path / "progress" / "commits" / name).rename(tmp_path / f"gone{name}")
    land(spark, landing, [("Consolidado", "c", dt.date(2024, 3, 31), "ÚLTIMO", "3.01", 8.0, "UNIDADE")], STATEMENT)
    st.stream_gold_refresh(read(spark, landing, STATEMENT), compact, gold, progress).awaitTermination()
    assert [r["revenue"] for r in spark.read.parquet(gold).collect()] == [15.0]


REQUEST = "ts timestamp, endpoint string"


def minute(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


def test_late_requests_join_sessions_until_the_watermark(spark, tmp_path):
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run(*rows):
        land(spark, landing, [(minute(m), e) for m, e in rows], REQUEST)
        st.stream_request_sessions(read(spark, landing, REQUEST), sink, progress, gap="10 minutes", delay="30 minutes").awaitTermination()
        out = spark.read.parquet(sink).collect()
        return sorted((r["endpoint"], (r["session_start"] - minute(0)).seconds // 60, (r["session_end"] - minute(0)).seconds // 60, r["n_requests"]) for r in out)

    assert run((0, "a"), (5, "a"), (20, "a"), (2, "b")) == []
    # A late request bridges two open sessions of an endpoint, and one endpoint's time moves the watermark of all.
    assert run((13, "a"), (14, "a"), (55, "c")) == [("b", 2, 12, 1)]
    assert run((3, "a"), (70, "c")) == [("a", 0, 30, 5), ("b", 2, 12, 1)]  # 3 is too late
    assert run((200, "c")) == [("a", 0, 30, 5), ("b", 2, 12, 1), ("c", 55, 65, 1), ("c", 70, 80, 1)]


def test_sliding_windows_overlap(spark, tmp_path):
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    land(spark, landing, [(minute(70), "a"), (minute(95), "a"), (minute(400), "b")], REQUEST)
    st.stream_request_log(read(spark, landing, REQUEST), sink, progress, size="1 hour", slide="20 minutes").awaitTermination()
    got = sorted(((r["window_start"] - minute(0)).seconds // 60, r["n_requests"]) for r in spark.read.parquet(sink).filter("endpoint = 'a'").collect())
    assert got == [(20, 1), (40, 2), (60, 2), (80, 1)]


def test_unmatched_objects_are_written_once(spark, tmp_path):
    a, b, sink, progress = (str(tmp_path / n) for n in ("a", "b", "out", "progress"))
    landed, asked = "object_id int, landed_at timestamp", "object_id int, request int, asked_at timestamp"

    def run(objects, requests):
        land(spark, a, [(i, minute(m)) for i, m in objects], landed)
        land(spark, b, [(i, r, minute(m)) for i, r, m in requests], asked)
        st.stream_matched_requests(read(spark, a, landed), read(spark, b, asked), sink, progress, within="60 minutes", delay="10 minutes").awaitTermination()
        return sorted((r["object_id"], r["request"] or 0) for r in spark.read.parquet(sink).collect())

    assert run([(1, 0), (2, 5), (3, 10)], [(1, 11, 30), (1, 12, 59), (1, 13, 60), (2, 21, 4), (9, 91, 20)]) == [(1, 11), (1, 12)]
    # A request of a later batch meets an object of an earlier one; nothing is unmatched before its time is over.
    assert run([(4, 40)], [(2, 22, 64), (3, 31, 70), (4, 41, 41)]) == [(1, 11), (1, 12), (2, 22), (4, 41)]
    assert run([(5, 200)], [(5, 51, 210)]) == [(1, 11), (1, 12), (2, 22), (3, 0), (4, 41), (5, 51)]
    assert run([(6, 400)], [(7, 71, 500)]) == [(1, 11), (1, 12), (2, 22), (3, 0), (4, 41), (5, 51)]


def test_tables_that_are_folders_are_streamed(spark, tmp_path):
    spark.range(0, 300, 1, 4).selectExpr("id AS doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    at = "cast(timestamp_seconds(1704067200 + id * 60) AS timestamp_ntz) AS ts"
    spark.range(0, 4000, 1, 4).selectExpr("id AS event_id", at, "'e' AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    asked = {(e % 200, e) for e in range(4000) if 0 <= e * 60 - e % 200 * 2591 < 86_400}
    got = [(r["object_id"], r["event_id"]) for r in st.stream_documents_requested(spark, str(tmp_path)).collect()]
    assert {x for x in got if x[1] is not None} == asked and len(got) == len(set(got))


def test_replayed_documents_of_a_folder_keep_their_first_ids(spark, tmp_path):
    texts = "CASE WHEN id % 25 > 0 THEN concat('t', id % 25) END AS text"
    docs = spark.range(0, 600, 1, 8).selectExpr("599 - id AS id").selectExpr("id AS doc_id", texts, "concat('s', id % 2) AS source")
    docs.repartition(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(r["doc_id"] for r in st.stream_ingest_documents(spark, str(tmp_path)).collect())
    assert got == list(range(50))


def test_a_replayed_part_is_one_batch_whatever_its_files(spark, tmp_path):
    spark.range(0, 90, 1, 6).selectExpr("id * 37 % 90 AS k").write.parquet(str(tmp_path / "rows"))
    sizes = []

    def start(rows):
        def count(batch, _):
            sizes.append(batch.count())

        return rows.writeStream.foreachBatch(count).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()

    replays.replay(spark, spark.read.parquet(str(tmp_path / "rows")), "k", start)
    assert sizes == [30, 30, 30]
