"""Shape of the physical plans: what they scan, how often they shuffle, what they must not contain."""

from __future__ import annotations

import os
import re

import pytest

from issuerlake.plans.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(spark, name):
    df = REGISTRY[name](spark, SF)
    return df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def shuffles(text):
    return len(re.findall(r"Exchange (hash|range|rebalance|Single|round)", text))


# Queries that write and read files on the way, or run a table function over a row a period.
OTHER = ("scan_statements", "scan_preamble_tsv", "scan_quoted_tsv", "cash_flow_table", "write_gold", "export_sheets", "incremental_financials")
LAZY = sorted(n for n in REGISTRY if not n.startswith("stream_") and n not in OTHER)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_single_task_no_row_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "CollectLimit"):
        assert bad not in text, f"{name}: {bad}"
    # Unpartitioned windows sort a whole table in one task.
    assert not re.search(r"Window \[.*\], \[\], ", text)


@pytest.mark.parametrize("name", [
    "financials_quarterly", "account_sums", "split_by_aggregation", "dataset_ref_date", "filter_last_exercise", "risk_exposure",
    "missing_categories", "latest_documents", "latest_filing", "key_legal_risks", "upcoming_payments",
])
def test_one_shuffle(spark, name):
    assert shuffles(plan(spark, name)) == 1


def test_schedule_order_takes_one_shuffle(spark):
    from issuerlake import operators as op
    from issuerlake.plans import fixtures as fx

    df = op.events_schedule(fx.raw_events(spark, SF))
    assert shuffles(df._jdf.queryExecution().executedPlan().toString()) == 1


@pytest.mark.parametrize("name", [
    "chunk_naive", "chunk_sentences", "chunk_overlap", "chunk_rows", "catalog_rows", "collapse_ws", "extract_doc_metadata", "null_tokens",
    "traded_prices", "conform_terms", "extract_page_links", "extract_update_stamp", "l2_normalize", "download_manifest",
])
def test_no_shuffle(spark, name):
    assert shuffles(plan(spark, name)) == 0


@pytest.mark.parametrize("name", ["latest_documents", "latest_filing", "key_legal_risks", "upcoming_payments", "dedup_content", "knn_cosine", "bm25_topk"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from issuerlake import operators as op
    from issuerlake.plans import fixtures as fx

    stored = str(tmp_path / "statements")
    op.write_gold(fx.tagged_statements(spark, SF), stored, ["enr_aggregation_type", "file_year"])
    rows = spark.read.parquet(stored).filter("file_year = 2000")
    df = op.financials_quarterly(op.filter_last_exercise(op.scale_amounts(rows)))
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(ORDEM_EXERC,ÚLTIMO)" in re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "file_year" in re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "DS_CONTA" not in schema and "VERSAO" not in schema and "CD_CONTA" in schema
    assert "text" not in re.search(r"ReadSchema: struct<([^>]*)", plan(spark, "latest_documents")).group(1)


def test_search_moves_hits_only(spark):
    for name in ("knn_cosine", "bm25_topk"):
        text = plan(spark, name)
        assert shuffles(text) == 1 and "MapInArrow" in text.split("Exchange")[-1]


def test_chunks_carry_nothing_of_the_document(spark):
    for name in ("chunk_naive", "chunk_sentences"):
        above = plan(spark, name).split("Generate")[0]
        assert "_p#" not in above and "_n#" not in above and "_starts#" not in above


def test_leaf_sums_meet_parents_after_summing(spark):
    text = plan(spark, "account_sums_leaf_only")
    assert "HashAggregate" in text.split("LeftOuter", 1)[1].split("Scan parquet")[0]


def test_requests_take_part_in_three_joins(spark):
    text = plan(spark, "resolve_issuer")
    assert len(re.findall(r"Join \[_k#", text)) == 3


def test_sketched_percentiles_read_the_prices_once(spark):
    result = REGISTRY["spread_percentiles_sketched"](spark, SF)
    assert not [f for f in result.inputFiles() if "lineitem" in f] and result.filter("within_bound").count() == result.count() > 0
