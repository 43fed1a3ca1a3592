"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from issuerlake.llm import quality
from issuerlake.llm.oracles import ORACLES
from issuerlake.llm.queries import REGISTRY

from test_llm_exact import HEX, base_spans, brute_components, contaminated

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    cur = duck.execute(ORACLES[name])
    header = [d[0] for d in cur.description]
    assert sorted(header) == cols
    assert got == sorted(tuple(r[header.index(c)] for c in cols) for r in cur.fetchall())


def test_queries_are_registered_over_whole_tables(spark):
    assert set(REGISTRY) | {"pipeline"} <= set(entry.queries())
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY)
    assert numbers == list(range(1, 14))
    source = {"op1": "pages", "op8": "embeddings"}
    for name, f in REGISTRY.items():
        if name.startswith(("op8", "op13")):
            continue
        rows = spark.read.parquet(f"{SF}/{source.get(name.split('_')[0], 'documents')}.parquet").count()
        assert f(spark, SF).count() == rows, name


def awkward(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "kept")
    more = [(900_000, None, "en", "s", 0), (900_001, "", "en", "s", 0), (None, "Words without a key, repeated. " * 9, None, None, None),
            (900_002, f"A line with password=hunter2hunter2 and {HEX} in it, and some more plain words to read.", "en", "s", 1)]
    return docs.union(spark.createDataFrame(more, docs.schema)).repartition(4)


def test_stages_equal_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicate removal", "benchmark decontamination", "secret scans", "BPE encoding and decoding"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = awkward(spark, SF)
    rows = {(r["doc_id"], r["text"]): r for r in docs.collect()}

    labels = spark.read.parquet(f"{SF}/labels.parquet").where("crc32(cast(doc_id as string)) % 5 <> 0")
    scores = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels))
    good = sorted((r["doc_id"] for r in scores.where(f"score >= {quality.THRESHOLD}").collect()), key=str)
    kept = stages[0](spark, docs, SF)
    assert kept.columns == docs.columns
    first = sorted(kept.collect(), key=str)
    assert sorted((r["doc_id"] for r in first), key=str) == good
    assert all(rows[(r["doc_id"], r["text"])] == r for r in first)

    single = stages[1](spark, kept, SF)
    want = brute_components([(r["doc_id"], r["text"]) for r in first], 5)
    second = sorted(single.collect(), key=str)
    assert sorted((r["doc_id"] for r in second), key=str) == sorted((i for i, *_, k in want if k), key=str)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    third = sorted(stages[2](spark, single, SF).collect(), key=str)
    assert third == [r for r in second if not contaminated(r["text"], items)[4]]

    clean = sorted(stages[3](spark, stages[2](spark, single, SF), SF).collect(), key=lambda r: str(r["doc_id"]))
    before = sorted(third, key=lambda r: str(r["doc_id"]))
    assert len(clean) == len(before)
    for a, b in zip(before, clean):
        assert (a["doc_id"], a["lang"], a["kept"]) == (b["doc_id"], b["lang"], b["kept"])
        assert (a == b) or (base_spans(a["text"]) and not base_spans(b["text"]))


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * n < got.count() < n
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
