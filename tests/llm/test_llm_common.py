"""Shared helpers: bounded samples, slices of batches, the worker's cache."""

from __future__ import annotations

import pyarrow as pa

from issuerlake.llm import common


def test_label_samples_are_bounded_and_repeatable(spark):
    rows = [(i, i % 2) for i in range(4000)] + [(5, 1)] * 3000 + [(None, 1), (7, None), (8, 9)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
    some = sorted(tuple(r) for r in common.sample_labels(labels.repartition(3), "doc_id", "quality", 500).collect())
    assert 300 < len(some) < 800 and len(set(some)) == len(some)
    assert some == sorted(tuple(r) for r in common.sample_labels(labels, "doc_id", "quality", 500).collect())
    everything = common.sample_labels(labels, "doc_id", "quality", 5000)
    assert everything.count() == 4000
    assert common.sample_labels(labels.limit(0), "doc_id", "quality", 5).count() == 0


def test_pieces_keep_rows_in_order(monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 100)
    texts = ["x" * (i * 7 % 90) for i in range(50)] + [None, "y" * 5000, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = [p.column(0).to_pylist() for p in common.pieces(batch)]
    assert len(parts) > 10 and [t for p in parts for t in p] == texts
    assert list(common.pieces(batch.slice(0, 0))) == []


def test_a_worker_holds_one_object():
    made = []
    make = lambda n: lambda: made.append(n) or [n]
    first = common.worker_cache("test-a", make("a"))
    assert common.worker_cache("test-a", make("a")) is first
    common.worker_cache("test-b", make("b"))
    assert common.worker_cache("test-a", make("a")) is not first and made == ["a", "b", "a"]


def test_words():
    assert common.white_words("A B c\x0bÉ\x1cd") == ["a b".encode(), b"c", "É\x1cd".encode()]
    assert common.plain_words("It's ÉTÉ-2, ſ_x") == [b"it", b"s", "ÉtÉ".encode(), b"2", "ſ".encode(), b"x"]
    assert common.white_words(None) == common.plain_words(None) == []
