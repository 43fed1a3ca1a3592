from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from issuerlake import operators as op
from issuerlake import schemas as sc

D = dt.date(2024, 3, 31)


def statements(spark, data):
    cols = "enr_aggregation_type string, CNPJ_CIA string, DT_REFER date, CD_CONTA string, VL_CONTA double, ESCALA_MOEDA string"
    return op.scale_amounts(spark.createDataFrame(data, cols))


def one(spark, accounts, **kw):
    return op.financials_quarterly(statements(spark, [("Consolidado", "c", D, a, float(v), "MIL") for a, v in accounts])).first()


def test_financials(spark):
    r = one(spark, [("3.01", 10), ("3.05", 4), ("3.04.04", -1), ("2.01.04", 3), ("2.01.04.01", 2), ("2.02.01", 1), ("1.01.01", 2),
                    ("6.02.01", -7), ("6.01.02", 1), ("6.01.02.02", -2), ("3.06.02", 9), ("3.01.01", 99)])
    assert r.asDict() == dict(
        enr_aggregation_type="Consolidado", issuer_cnpj="c", date=D, quarter="Q1", year=2024, revenue=10e3, ebitda=3e3, ebit=4e3,
        depreciation=-1e3, net_debt=4e3, total_debt=6e3, debt_short_term=5e3, debt_long_term=1e3, cash=2e3, interest_paid=2e3,
        capex=7e3, wc_change=-1e3,
    )


def test_interest_falls_back_to_income_statement(spark):
    assert one(spark, [("6.01.02.02", 2), ("6.01.02.02", -2), ("3.06.02", -9)])["interest_paid"] == 9e3


def test_groups_without_matching_account_stay(spark):
    r = one(spark, [("9.99", 5)])
    assert (r["revenue"], r["net_debt"], r["interest_paid"]) == (0.0, 0.0, 0.0)


def test_null_keys_and_unknown_scales(spark):
    df = statements(spark, [("Consolidado", None, D, "3.01", 1.0, "MIL"), ("Consolidado", "c", D, "3.01", 1.0, "???"),
                            ("Consolidado", "c", D, "3.01", 2.0, "MILHÕES"), ("Consolidado", "c", D, "3.01", None, "MIL")])
    got = op.financials_quarterly(df).collect()
    assert [(r["issuer_cnpj"], r["revenue"]) for r in got] == [("c", 2e6)]


def test_leaf_only_drops_parents_of_the_same_group(spark):
    data = [("Consolidado", "c", D, "2.01.04", 3.0, "UNIDADE"), ("Consolidado", "c", D, "2.01.04.01", 3.0, "UNIDADE"),
            ("Consolidado", "d", D, "2.01.04", 5.0, "UNIDADE")]
    got = {r["CNPJ_CIA"]: float(r["debt_short_term"]) for r in op.account_sums(statements(spark, data), leaf_only=True).collect()}
    assert got == {"c": 3.0, "d": 5.0}


def test_empty_statements(spark):
    df = op.financials_quarterly(statements(spark, []))
    assert df.count() == 0 and df.columns == ["enr_aggregation_type", *sc.FINANCIALS_COLUMNS]


def test_union_ragged_and_split(spark, rows):
    a = spark.createDataFrame([("Consolidado", "ATIVO")], "enr_aggregation_type string, t string")
    b = spark.createDataFrame([("Individual",), ("Outro",)], "enr_aggregation_type string")
    assert rows(op.split_by_aggregation(op.union_ragged(a, b))) == [("Consolidado", "ATIVO"), ("Individual", None)]
    with pytest.raises(Exception):
        op.union_itr_dfp(a, b)


def test_filter_years(spark, rows):
    df = spark.createDataFrame([(y, f) for y in (2022, 2023, 2024, 2025, 2026) for f in ("ITR", "DFP")], "file_year int, form string")
    assert rows(op.filter_years(df, 2025)) == [(2023, "DFP"), (2023, "ITR"), (2024, "DFP"), (2024, "ITR"), (2025, "ITR")]


def test_quality_report_per_group_and_not_found(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "x")], "k string, v string")
    report = op.quality_report(df, {"missing": F.col("v").isNull(), "all": F.lit(True)}, ["k"])
    assert rows(report) == [("a", 2, "all", 2), ("a", 2, "missing", 1), ("b", 1, "all", 1), ("b", 1, "missing", 0)]
    assert rows(op.reply_not_found(df.withColumn("w", F.when(F.col("k") == "a", 1)), "k", ["k", "w"])) == [("b", 1)]
    assert op.schema_differences(df.schema, ["v", "k"]) == ["order differs"]
    assert op.schema_differences(df.schema, ["k", "w"]) == ["missing: w", "unexpected: v"]


def test_missing_categories(spark, rows):
    df = spark.createDataFrame([("i", "A"), ("i", "Z"), ("j", "Z"), ("k", "A"), ("k", "B")], "issuer_cnpj string, category string")
    assert rows(op.missing_categories(df, ["A", "B"])) == [("i", "warning", "B"), ("j", "error", "A"), ("j", "error", "B")]


def test_conform_schema(spark):
    df = spark.createDataFrame([("1", "x")], "b string, a string")
    assert op.conform_schema(df, "a string, b int").first() == ("x", 1)
    with pytest.raises(ValueError, match="missing columns"):
        op.conform_schema(df, "c string")


def terms(spark, data):
    cols = "asset_code string, `Juros Criterio Novo - Taxa` string, `Percentual Multiplicador/Rentabilidade` string, Classe string, `Ipo (x)` string"
    return spark.createDataFrame(data, cols)


def test_terms(spark, rows):
    raw = terms(spark, [("A", None, "101", "S", "-"), ("A", None, "102", "", " p "), ("B", None, "103", None, "q"), ("B", "2,45", "104", "N", None)])
    assert rows(op.terms_gold(raw), "asset_code", "coupon", "covenants", "enr_ipo_x") == [
        ("A", 101.0, "Classe: S", None), ("A", 102.0, None, "p"), ("B", 2.45, "Classe: N", None), ("B", None, None, "q"),
    ]


def test_coupon_formats_and_clashing_headers(spark, rows):
    raw = terms(spark, [("A", "2.45", "1", "S", "-"), ("B", "1.002,45", "1", "S", "-"), ("C", "7", "1", "S", "-"), ("D", "x", "1", "S", "-")])
    assert rows(op.terms_gold(raw), "asset_code", "coupon") == [("A", 2.45), ("B", 1002.45), ("C", 7.0), ("D", None)]
    with pytest.raises(ValueError, match="Ipo .x.* and .*ipo x"):
        op.conform(raw.withColumn("ipo x", F.lit("")))


def test_schedule_puts_missing_dates_last(spark):
    cols = "event_date string, payment_date string, issuer string, asset_code string, event string, yield_type string, rate_or_percent string, settlement_date string"
    raw = spark.createDataFrame([("01/01/2024", d, "i", "a", "e", "xx", "1", None) for d in ("-", "05/01/2024", "02/01/2024")], cols)
    assert [str(r["payment_date"]) for r in op.events_schedule(raw).collect()] == ["2024-01-02", "2024-01-05", "None"]


def test_coupon_column_absent(spark, rows):
    raw = terms(spark, [("A", None, "101", "S", "-")]).drop("Juros Criterio Novo - Taxa")
    assert rows(op.terms_gold(raw), "asset_code", "coupon") == [("A", 101.0)]
    assert op.covenants(["x"]) is not None
    assert spark.range(1).select(op.covenants(["x"]).alias("c")).first()["c"] == ""


def test_fallback_group_with_null_key(spark, rows):
    df = spark.createDataFrame([(None, None, "1"), ("k", "5", "2")], "asset_code string, coupon string, coupon_alt string")
    assert rows(op.fallback_by_group(df)) == [("k", "5"), (None, "1")]


def test_traded_prices_pass_numbers_through(spark):
    cols = "ref_date date, issuer string, asset_code string, qty int, amt_of_trades int, min_unit_price double, avg_unit_price string, max_unit_price string, curve_price_percent string"
    r = op.traded_prices(spark.createDataFrame([(D, "i", "a", 5, 2, 1.5, "1.000,25", "-", None)], cols)).first()
    assert (r["ISIN"], r["qty"], r["min_unit_price"], r["avg_unit_price"], r["max_unit_price"]) == (None, 5, 1.5, 1000.25, None)


def test_dedup_content(spark, rows):
    incoming = spark.createDataFrame(
        [(1, "f", "h1"), (2, "f", "h1"), (3, "g", "h1"), (4, "f", "h2"), (5, "f", "h3")], "id int, folder string, file_hash string"
    )
    catalog = spark.createDataFrame([("f", "h2"), ("f", "h2"), ("g", "h3")], "folder string, file_hash string")
    assert sorted(r["id"] for r in op.dedup_content(incoming, catalog, [F.asc("id")]).collect()) == [1, 3, 5]


def test_freshness_and_find(spark, rows):
    keys = "document_type string, file_year int, last_update string"
    offered = spark.createDataFrame([("ITR", 2024, "a"), ("ITR", 2025, "b")], keys)
    assert rows(op.freshness_gate(offered, spark.createDataFrame([("ITR", 2024, "a")], keys))) == [("ITR", 2025, "b")]
    docs = spark.createDataFrame([("x/File1.pdf",), ("x/file2.pdf",), ("x/other.pdf",)], "object_path string")
    known = spark.createDataFrame([("x/File1.pdf", "hash123")], "object_path string, file_hash string")
    assert rows(op.find_documents(docs, known, "FILE")) == [("x/File1.pdf", "hash123"), ("x/file2.pdf", None)]


def test_latest_filing_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "i", "2024-01-02"), (2, "i", "2024-01-02"), (3, "i", None), (4, "j", None)], "doc_id int, issuer_cnpj string, receipt_date string"
    )
    assert [r["doc_id"] for r in op.latest_filing(df).collect()] == [1]


def test_legal_risks(spark):
    cols = "issuer_cnpj string, case_id string, risk string, claimed_value string"
    cases = spark.createDataFrame(
        [("i", "c1", "Possível", "900"), ("i", "c2", "high", "n/d"), ("i", "c3", "Provável", "10.5 BRL"), ("i", "c4", "Remoto", "1")], cols
    )
    assert [r["case_id"] for r in op.key_legal_risks(cases).orderBy("rank").collect()] == ["c3", "c2", "c1"]
    assert op.risk_exposure(cases).first() == ("i", 3, 910.5)


def test_resolve_issuer_precedence(spark, rows):
    # Tax id 1 repeats; its first name counts and no request is multiplied.
    issuers = spark.createDataFrame([("1", "ACME", "X"), ("1", "ACME NEW", "X"), ("2", "BETA", "Y"), (None, "NOBODY", "Z")], "issuer_cnpj string, issuer_name string, industry string")
    listing = spark.createDataFrame([("T1", "1"), ("T1", "1")], "asset_code string, issuer string")
    asked = spark.createDataFrame(
        [(1, "T1", "2", None), (2, "T9", "2", "ACME"), (3, None, None, "ACME"), (4, None, None, None), (5, "T9", None, None)],
        "request_id int, ticker string, issuer_cnpj string, issuer_name string",
    )
    got = rows(op.resolve_issuer(asked, issuers, listing), "request_id", "status", "resolved_cnpj", "resolved_ticker")
    assert got == [(1, "OK", "1", "T1"), (2, "OK", "2", "N/A"), (3, "OK", "1", "N/A"), (4, "INVALID_INPUT", "N/A", "N/A"), (5, "NOT_FOUND", "N/A", "N/A")]


def test_chunks(spark, rows):
    docs = spark.createDataFrame([(1, "a b\nc\n\nd e f g h\ni"), (2, "  \n "), (3, None), (4, "\nx")], "doc_id int, text string")
    assert rows(op.chunk_naive(docs, limit=3)) == [(1, 0, "a b\nc\n", 3), (1, 1, "d e f g h", 5), (1, 2, "i", 1), (4, 0, "x", 1)]
    one_doc = spark.createDataFrame([(1, "One two. Three! Four five six? Seven")], "doc_id int, text string")
    assert [r["text"] for r in op.chunk_naive(one_doc, limit=3, unit="sentence").orderBy("chunk_no").collect()] == ["One two. Three!", "Four five six?", "Seven"]


def test_paragraph_chunks(spark):
    one_doc = spark.createDataFrame([(1, "a b\nc\n\nd e\n \n\nf g h i\n\nj")], "doc_id int, text string")
    assert [r["text"] for r in op.chunk_naive(one_doc, limit=5, unit="paragraph").orderBy("chunk_no").collect()] == ["a b\nc\n\nd e", "f g h i\n\nj"]


def test_a_long_document_is_chunked(spark):
    line = "word " * 300 + "end"
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr(f"array_join(array_repeat('{line}', 13000), '\\n')").alias("text"))
    for f in (lambda d: op.chunk_naive(d), lambda d: op.chunk_overlap(d)):
        r = f(docs).agg(F.count("*"), F.sum("tokens"), F.max(F.length("text"))).first()
        assert r[0] > 7_000 and r[1] >= 13_000 * 301 and r[2] < 4_000


@pytest.mark.parametrize("n", [1, 4, 5, 7, 8, 10, 11])
def test_overlap_windows_cover_everything(spark, n):
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    got = [r["text"].split() for r in op.chunk_overlap(docs, size=4, overlap=1).orderBy("chunk_no").collect()]
    starts = [i for i in range(0, n, 3) if i == 0 or i + 1 < n]
    assert got == [words[i : i + 4] for i in starts]


def test_chunk_rows_with_and_without_join(spark, rows):
    lineage = "object_path string, ingest_ts string, source string, file_hash string, trace_id string, document_type string, ref_date string, aggregation_type string"
    meta = spark.createDataFrame([("p/x.pdf", "t", "CVM", "h", "r", "ITR", "2024-01-01", None)], lineage)
    docs = meta.withColumn("text", F.lit("é" * 600))
    inline = op.chunk_rows(op.chunk_naive(docs))
    joined = op.chunk_rows(op.chunk_naive(docs.select("object_path", "text")), meta)
    assert rows(inline) == rows(joined)
    r = inline.first()
    assert (r["chunk_id"], len(r["text_raw"]), r["aggregation_type"]) == ("p/x.pdf#chunk_0", 512, "")
    assert len(inline.columns) == 17 and r["page_start"] is None
    read = op.chunk_naive(docs).withColumns({"page_start": F.lit(3), "embedding": F.array(F.lit(0.5))})
    for made in (op.chunk_rows(read), op.chunk_rows(read, meta)):
        assert (made.first()["page_start"], made.first()["embedding"]) == (3, [0.5])


def test_index_completeness_and_upsert(spark, rows):
    chunks = spark.createDataFrame([(1,), (1,), (2,)], "doc_id int")
    stored = spark.createDataFrame([(1,), (1,)], "doc_id int")
    assert rows(op.index_completeness(chunks, stored)) == [(1, 2, 2, True), (2, 1, 0, False)]
    assert {r["skip"] for r in op.index_completeness(chunks, stored, force=True).collect()} == {False}
    cols = "chunk_id string, text string, version int"
    old = spark.createDataFrame([("a", "old", 1), ("b", "old", 3), ("c", "old", 1)], cols)
    new = spark.createDataFrame([("a", "new", 1), ("b", "new", 2), ("d", "new", 1), ("d", "newer", 2)], cols)
    assert rows(op.upsert_chunks(old, new)) == [("a", "new", 1), ("b", "old", 3), ("c", "old", 1), ("d", "newer", 2)]


def test_check_dimension(spark, rows):
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "vec_id int, embedding array<double>")
    assert rows(op.check_dimension(v, 2)) == [(2, 1), (3, 0)]


def test_gold_overwrites_only_touched_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "gold")
    op.write_gold(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    op.write_gold(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [(1, "a"), (3, "b")]


def test_serving_keys_keep_aggregations_apart(spark):
    df = spark.createDataFrame([("Consolidado", "i", D, 1.0), ("Individual", "i", D, 2.0)], "agg string, issuer string, date date, v double")
    got = {r["cache_key"]: r["payload"] for r in op.serving_json(df, "t", {"ref_date": "x", "trace_id": "y"}, ["issuer"], "agg").collect()}
    assert set(got) == {"t:Consolidado:i", "t:Individual:i"}
    assert '"date":"2024-03-31"' in got["t:Individual:i"] and "gold/serving/t_Individual_.parquet" in got["t:Individual:i"]


def test_digest(spark, rows):
    df = spark.createDataFrame(
        [("d", "T", "s2", "x", "p1"), ("d", "T", "s2", "x", "p2"), ("d", "U", "s1", "y", "p3")],
        "ref_date string, document_type string, source string, title string, object_path string",
    )
    assert rows(op.ingest_digest(df)) == [("d", "T", "s2", 2, 1, 3, "s1, s2"), ("d", "U", "s1", 1, 1, 3, "s1, s2")]
    assert [r["object_path"] for r in op.digest_listing(df).collect()] == ["p1", "p2", "p3"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop", ["create", "rename", "delete", "mkdirs"])
@pytest.mark.parametrize("calls", range(5))
def test_replacement_survives_a_stop_at_any_step(spark, tmp_path, rows, monkeypatch, stop, calls):
    """Whatever call to the file system is the last one, the table ends with all old rows or all new ones."""
    from issuerlake.operators import sinks

    path, schema = str(tmp_path / "t"), "v int, p string, q int"
    old, new = [(1, "a b", 1), (2, "b/c", 1), (3, None, 2)], [(4, "b/c", 1), (5, "ü", 1), (6, None, 3)]
    op.write_gold(spark.createDataFrame(old, schema), path, ["p", "q"])
    real, left = sinks._files, [calls]

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*a):
                if name == stop:
                    left[0] -= 1
                    if left[0] < 0:
                        raise Stopped(name)
                return getattr(self.fs, name)(*a)

            return call

    monkeypatch.setattr(sinks, "_files", lambda *a: (real(*a)[0], Files(real(*a)[1])))
    clear = spark.createDataFrame([("a b", 1), (None, 2), ("b/c", 1), ("none such", 9)], "p string, q int")
    done = True
    try:
        op.write_gold(spark.createDataFrame(new, schema), path, ["p", "q"], clear=clear)
    except Stopped:
        done = False
    monkeypatch.setattr(sinks, "_files", real)
    got = rows(op.table_or_empty(spark, path, spark.createDataFrame([], schema).schema, own=True), "v", "p", "q")
    assert got == sorted(new, key=str) or not done and got == sorted(old, key=str)
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_replace")]
    assert rows(spark.read.schema(schema).parquet(path), "v", "p", "q") == got


def test_header_report_tells_names_from_order(spark):
    rows = [("a", "x;y;z"), ("a", "z;y;x"), ("a", 'x;"y"; z '), ("a", "x;y"), ("a", "x;y;z;w"), ("a", ""), ("a", None), ("b", "z;x;q"), ("b", "q"), ("c", "x")]
    files = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, source string, header string")
    got = {r["id"]: (r["missing"], r["unexpected"], r["order_differs"]) for r in op.header_report(files, {"a": ["x", "y", "z"], "b": ["x", "z"]}, {"b"}).collect()}
    assert got[0] == got[2] == ([], [], False) and got[1] == ([], [], True) and got[3] == (["z"], [], None) and got[4] == ([], ["w"], None)
    assert got[5] == got[6] == (["x", "y", "z"], [], None) and got[7] == ([], [], False) and got[8] == (["x", "z"], [], None) and got[9] == (None, None, None)


def test_metadata_as_a_map_of_strings(spark):
    df = spark.createDataFrame([(1, "a", 5, None), (2, "", None, 1.5)], "id int, s string, n int, x double")
    packed = op.metadata_map(df, ["s", "n", "x"])
    assert {r["id"]: r["metadata"] for r in packed.collect()} == {1: {"s": "a", "n": "5"}, 2: {"x": "1.5"}}
    back = op.metadata_columns(packed, {"n": "int", "x": "double", "other": "date"})
    assert sorted(map(tuple, back.collect())) == [(1, 5, None, None, {"s": "a"}), (2, None, 1.5, None, {})]


def test_readers_leave_what_a_writer_has_staged(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "v int, p string"
    op.write_gold(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["p"])
    staged = op.stage_gold(spark.createDataFrame([(3, "b")], schema), path, ["p"])
    kind = spark.createDataFrame([], schema).schema
    assert rows(op.table_or_empty(spark, path, kind)) == rows(spark.read.schema(schema).parquet(path)) == [(1, "a"), (2, "b")]
    op.switch_gold(spark, path, staged)
    assert rows(op.table_or_empty(spark, path, kind)) == [(1, "a"), (3, "b")]
    # The writer's next look at the table clears away what was never decided.
    op.stage_gold(spark.createDataFrame([(4, "b")], schema), path, ["p"])
    assert rows(op.table_or_empty(spark, path, kind, own=True)) == [(1, "a"), (3, "b")]
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_replace")]
