"""Search operators against brute force, with query blocks of any size."""

from __future__ import annotations

import math
import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from issuerlake import operators as op
from issuerlake.operators import blocks


def hits(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in df.collect())


def brute_knn(queries, docs, k):
    out = []
    for q, v in queries:
        scored = []
        for d, w in docs:
            norms = (np.linalg.norm(v) or 1.0) * (np.linalg.norm(w) or 1.0)
            scored.append((-(round(float(np.dot(v, w)) / norms, 6) + 0.0), d))
        out += [(q, i + 1, d, -s + 0.0) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    docs = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # a third of the corpus are copies
    docs.append((2000, [0.0] * 6))
    docs += [(7, docs[9][1]), (7, docs[5][1])]  # an id that repeats
    queries = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(17)] + [(99, docs[5][1])]
    return queries, docs


def bad_vectors(n):
    return [(3000, [float("nan")] * n), (3001, [1.0] * (n - 1) + [None]), (3002, [float("inf")] * n), (3003, None)]


@pytest.mark.parametrize("block_queries", [1, 5, 4096])
def test_knn_is_exact(spark, vectors, block_queries):
    queries, docs = vectors
    q = spark.createDataFrame(queries + bad_vectors(6), "query_id bigint, vector array<double>")
    d = spark.createDataFrame(docs + bad_vectors(6), "doc_id bigint, vector array<double>").repartition(5)
    got = op.knn_cosine(q, d, k=7, block_queries=block_queries)
    assert hits(got) == brute_knn(queries, docs, 7)


def test_knn_beside_nan_in_one_batch(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<double>")
    d = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)] + bad_vectors(2), "doc_id bigint, vector array<double>").coalesce(1)
    assert [h[2] for h in hits(op.knn_cosine(q, d, 3))] == [0, 1, 2]


@pytest.mark.parametrize("block_queries", [1, 4096])
def test_knn_filter_k_beyond_corpus_and_empty_sides(spark, block_queries):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<double>")
    d = spark.createDataFrame([(1, [1.0, 1.0], "a"), (2, [0.0, 1.0], "b"), (3, None, "a")], "doc_id bigint, vector array<double>, source string")
    assert hits(op.knn_cosine(q, d, 5, {"source": "a"}, block_queries)) == [(1, 1, 1, 0.707107)]
    assert hits(op.knn_cosine(q, d, 5, {"source": "z"}, block_queries)) == []
    assert hits(op.knn_cosine(q.limit(0), d, 5, None, block_queries)) == []


def test_knn_rejects_mixed_dimensions(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<double>")
    d = spark.createDataFrame([(1, [1.0, 1.0]), (2, [1.0])], "doc_id bigint, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="different dimensions"):
        op.knn_cosine(q, d, 5).collect()


def test_running_best_over_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_VALUES", 3)
    rng = np.random.default_rng(1)
    w, docs = rng.integers(-2, 3, (5, 3)).astype(float), rng.integers(-2, 3, (40, 3)).astype(float)
    ids = rng.permutation(40)
    best = blocks.Best(np.arange(5) * 10, 3)
    for i in range(0, 40, 7):
        best.update(w @ docs[i : i + 7].T, ids[i : i + 7])
    want = [(q * 10, d, s) for q in range(5) for s, d in sorted((-(w[q] @ docs[j]), ids[j]) for j in range(40))[:3]]
    assert [tuple(r) for r in best.frame().itertuples(index=False)] == [(q, d, -s + 0.0) for q, d, s in want]


def words(t):
    return re.findall(r"[^\W_]+", t.lower())


def brute_bm25(queries, docs, k):
    texts = [(d, words(t or "")) for d, t in docs]
    n, mean = len(texts), sum(len(t) for _, t in texts) / len(texts)
    df = Counter(w for _, t in texts for w in set(t))
    out = []
    for q, text in queries:
        scored = []
        for d, t in texts:
            tf = Counter(t)
            common = sorted(w for w in set(words(text)) if w in tf)
            if common:
                s = sum(
                    math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean))
                    for w in common
                )
                scored.append((-round(s, 6), d))
        out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(200)]
    docs += [(500 + i, "Hot, hot w1 PHRASE here") for i in range(100)] + [(900, None), (901, "..."), (3, "w1 w2 w3"), (3, "w5 phrase")]
    queries = [(1, "w1 w2 w3"), (2, "hot phrase"), (3, "unknown words only"), (4, "w5 w5 W6"), (5, "")]
    return queries, docs


@pytest.mark.parametrize("block_queries,block_terms,values", [(1, 5_000, 7), (4096, 1, 4_000_000), (4096, 5_000, 4_000_000)])
def test_bm25_is_exact(spark, corpus, monkeypatch, block_queries, block_terms, values):
    monkeypatch.setattr(blocks, "BLOCK_VALUES", values)
    queries, docs = corpus
    q = op.query_terms(spark.createDataFrame(queries, "query_id bigint, q string"))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = op.bm25_topk(q, d, 6, block_queries=block_queries, block_terms=block_terms)
    assert hits(got) == brute_bm25(queries, docs, 6)


def test_bm25_of_empty_sides(spark, corpus):
    d = spark.createDataFrame(corpus[1], "doc_id bigint, text string")
    q = op.query_terms(spark.createDataFrame(corpus[0], "query_id bigint, q string"))
    assert hits(op.bm25_topk(q.limit(0), d, 3)) == [] and hits(op.bm25_topk(q, d.limit(0), 3)) == []


def test_term_entries(corpus):
    _, docs = corpus
    lists, vocabulary = pa.array([words(t or "") for _, t in docs]), pa.array(["hot", "w1", "w7"])
    got = list(zip(*(x.tolist() for x in blocks.term_entries(lists, vocabulary))))
    counts = [(i, j, words(t or "").count(w)) for i, (_, t) in enumerate(docs) for j, w in enumerate(("hot", "w1", "w7"))]
    assert got == [c for c in counts if c[2]]
    assert list(blocks.row_blocks(np.array([1, 1, 9, 1, 2, 2]), 3)) == [(0, 2), (2, 3), (3, 5), (5, 6)]


def test_tasks_do_not_need_the_package():
    """Functions sent to tasks carry their helpers with them."""
    payload = cloudpickle.dumps([blocks.vector_scorer(None, 3), blocks.keyword_scorer(None, 3, 1.2, 0.75, 1.0), blocks.term_counter(None)])
    code = "import sys, pickle; pickle.loads(sys.stdin.buffer.read()); assert not any(m.startswith('issuerlake') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], input=payload, check=True, cwd="/")


def test_hybrid_boost_threshold_and_missing_sides(spark):
    q = spark.createDataFrame([(1, "exact phrase", [1.0, 0.0])], "query_id bigint, q string, vector array<double>")
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])], "doc_id bigint, vector array<double>")
    t = spark.createDataFrame([(2, "an Exact\n phrase"), (4, "phrase exact it is"), (3, "zzz")], "doc_id bigint, text string")
    keyword = {r["doc_id"]: r["score"] for r in op.bm25_topk(op.query_terms(q), t).collect()}
    got = {r["doc_id"]: r["score"] for r in op.hybrid_search(q, v, t, threshold=0.0).collect()}
    best = max(keyword.values())
    want = {1: 0.7, 2: 0.7 * 0.6 + 0.3 * keyword[2] / best * 1.5, 3: 0.0, 4: 0.3 * keyword[4] / best}
    assert got == {d: pytest.approx(s, abs=2e-6) for d, s in want.items()}
    assert {r["doc_id"] for r in op.hybrid_search(q, v, t, threshold=0.65).collect()} == {d for d, s in want.items() if s >= 0.65}


def test_hybrid_of_repeated_ids(spark):
    q = spark.createDataFrame([(1, "exact phrase", [1.0, 0.0])], "query_id bigint, q string, vector array<double>")
    v = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.6, 0.8]), (2, [0.0, 1.0])], "doc_id bigint, vector array<double>")
    t = spark.createDataFrame([(1, "exact phrase"), (1, "phrase"), (1, "the exact phrase")], "doc_id bigint, text string")
    assert [(r["doc_id"], r["score"]) for r in op.hybrid_search(q, v, t, threshold=0.1).collect()] == [(1, pytest.approx(0.7 + 0.3 * 1.5))]


def test_expand_query(spark, rows):
    q = spark.createDataFrame([(1, "Lucro da receita"), (2, "resultado lucro")], "query_id bigint, q string")
    got = rows(op.expand_query(q, op.synonym_table(spark)).filter("query_id = 2"))
    assert sorted(got) == sorted([(2, "resultado", True), (2, "lucro", True), (2, "ganho", False), (2, "líquido", False)])
    assert op.expand_query(q, op.synonym_table(spark)).filter("query_id = 1 AND term = 'revenue'").count() == 1


def test_doc_metadata(spark):
    df = spark.createDataFrame([(1, "Em 01/02/2024 e 2024-03-04: R$ 1.234,56 ou USD 7 no Q3 2024, FY2023")], "doc_id int, text string")
    r = op.extract_doc_metadata(df).first()
    assert r["dates"] == ["01/02/2024", "2024-03-04"] and r["currencies"] == ["R$", "USD"]
    assert r["fiscal_periods"] == ["Q3 2024", "FY2023"] and "1.234,56" in r["numbers"]


def test_scoring_long_texts_takes_bounded_memory():
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from issuerlake.operators import blocks

    words, n, length = pa.array([f"w{i:03d}" for i in range(200)]), 2_000, 3_000
    picked = pa.array(np.random.default_rng(1).integers(0, 200, n * length).astype(np.int32))
    terms = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length), words.take(picked))
    columns = [pa.array(np.arange(n)), pa.array(np.full(n, length, dtype=np.int32)), terms]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "len", "terms"])
    shared = SimpleNamespace(value=(np.arange(3), words, np.arange(201), np.arange(200) % 3, np.ones(200)))

    def run(batches):
        tracemalloc.start()
        found = next(blocks.keyword_scorer(shared, 5, 1.2, 0.75, 3000.0)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found, peak

    one_by_one, _ = run([batch.slice(i, 100) for i in range(0, n, 100)])
    whole, peak = run([batch])
    assert whole.equals(one_by_one) and peak < 96 << 20
    counter = blocks.term_counter(SimpleNamespace(value=words))
    holding = np.unique(np.repeat(np.arange(n), length) * 200 + picked.to_numpy()) % 200
    assert next(counter(iter([batch]))).column("n").to_pylist() == np.bincount(holding, minlength=200).tolist()
