"""Landed files to gold tables, end to end on small files."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from issuerlake import operators as op
from issuerlake import schemas as sc
from issuerlake.plans import etl

RUN = {"trace_id": "t1", "source": "CVM", "last_update": "2025-10-06T08:01:00", "ref_date": "2025-10-19", "ingest_ts": "2025-10-19T12:00:00"}


def write(folder, name, text, encoding="ISO-8859-1"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder)


HEADER = "CNPJ_CIA;DT_REFER;VERSAO;DT_FIM_EXERC;ORDEM_EXERC;ESCALA_MOEDA;CD_CONTA;DS_CONTA;VL_CONTA\n"


def line(cnpj, date, order, scale, code, value):
    return f"{cnpj};{date};1;{date};{order};{scale};{code};x;{value}\n"


def test_financial_statements(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    write(raw, "itr_cia_aberta_DRE_con_2024.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "3.01", 10) + line("A", "2024-03-31", "PENÚLTIMO", "MIL", "3.01", 99)
          + line("B", "2024-03-31", "ÚLTIMO", "UNIDADE", "3.05", 7))
    write(raw, "itr_cia_aberta_BPP_con_2024.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "2.01.04", 4))
    write(raw, "dfp_cia_aberta_DRE_ind_2023.csv", HEADER + line("A", "2023-12-31", "ÚLTIMO", "MILHÕES", "3.01", 1))
    write(raw, "dfp_cia_aberta_DRE_ind_2024.csv", HEADER + line("A", "2024-12-31", "ÚLTIMO", "MIL", "3.01", 1))
    write(raw, "itr_cia_aberta_DVA_con_2024.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "3.01", 5))
    out = str(tmp_path / "lake")
    gold = etl.financial_statements(spark, str(raw), out, RUN, as_of=2024)
    want = [("Consolidado", "A", 10e3, 4e3), ("Consolidado", "B", 0.0, 0.0), ("Individual", "A", 1e6, 0.0)]
    cols = ("enr_aggregation_type", "issuer_cnpj", "revenue", "total_debt")
    assert rows(gold, *cols) == want
    # A second run over the same files replaces the partitions instead of adding to them.
    only_a = spark.createDataFrame([("A",), ("Z",)], "issuer_cnpj string")
    assert rows(etl.financial_statements(spark, str(raw), out, RUN, as_of=2024), *cols) == want
    assert [r[1] for r in rows(etl.financial_statements(spark, str(raw), str(tmp_path / "a"), RUN, issuers=only_a), *cols)] == ["A", "A", "A"]
    # On one lake, another subset adds to the first, and a later file to both.
    lake = str(tmp_path / "b")
    for name in ("A", "B"):
        part = etl.financial_statements(spark, str(raw), lake, RUN, issuers=spark.createDataFrame([(name,)], "issuer_cnpj string"), as_of=2024)
    assert rows(part, *cols) == want
    write(tmp_path / "later", "itr_cia_aberta_BPA_con_2024.csv", HEADER + line("B", "2024-03-31", "ÚLTIMO", "MIL", "1.01.01", 3))
    later = etl.financial_statements(spark, str(tmp_path / "later"), lake, RUN)
    assert rows(later, *cols) == want and rows(later.filter("issuer_cnpj = 'B'"), "cash") == [(3e3,)]
    # A file that lands again replaces its own rows.
    write(tmp_path / "again", "itr_cia_aberta_BPA_con_2024.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "1.01.01", 8))
    again = etl.financial_statements(spark, str(tmp_path / "again"), lake, RUN)
    assert rows(again.filter("enr_aggregation_type = 'Consolidado'"), "issuer_cnpj", "cash") == [("A", 8e3), ("B", 0.0)]
    silver = spark.read.parquet(f"{out}/silver/enriched/statements")
    assert rows(silver.select("enr_account_type", "enr_quarter").distinct()) == [("PASSIVO", "Q1"), (None, "Q1"), (None, "Q4")]
    payload = json.loads(spark.read.parquet(f"{out}/gold/cache/financials_quarterly").filter("cache_key LIKE '%Individual%'").first()["payload"])
    assert payload["data"]["date"] == "2023-12-31" and payload["trace_id"] == "t1"
    exported = spark.read.option("header", True).csv(f"{out}/gold/export/financials_quarterly")
    assert exported.count() == 3


def test_financial_statements_fail_without_rows(spark, tmp_path):
    raw = write(tmp_path / "raw", "itr_cia_aberta_DRE_con_2024.csv", HEADER)
    with pytest.raises(ValueError, match="issuer_missing"):
        etl.financial_statements(spark, raw, str(tmp_path / "lake"), RUN)


def test_events_schedule(spark, tmp_path, rows):
    head = "SND\n\n" + "\t".join(sc.EVENTS_SCHEDULE_SOURCE) + "\n"
    body = "15/01/2024\t16/01/2024\t1\tAB11\t Juros \tDIDI\t1.002,45\t16/01/2024\n10/01/2024\t-\t1\tAB11\tnan\tDIDI\t-\t-\n"
    folder = write(tmp_path / "replies", "a.tsv", head + body)
    write(tmp_path / "replies", "b.tsv", head + "Nenhum\t\t\t\t\t\t\t\n")
    write(tmp_path / "replies", "c.tsv", head)
    write(tmp_path / "replies", "d.tsv", head + '12/01/2024\t-\t"1 ""um"""\tAB12\tJuros\tDIDI\t-\t-\n')
    gold, dropped = etl.events_schedule(spark, folder, 2, str(tmp_path / "lake"), RUN)
    assert sorted((r["source_path"][-5:], r["n_rows"]) for r in dropped.collect()) == [("b.tsv", 1), ("c.tsv", 0)]
    assert rows(gold.filter("asset_code = 'AB12'"), "issuer") == [('1 "um"',)]
    gold = gold.filter("asset_code = 'AB11'")
    assert rows(gold, "event_date", "payment_date", "event", "yield_type", "rate_or_percent") == [
        (dt.date(2024, 1, 10), None, None, "DI", None),
        (dt.date(2024, 1, 15), dt.date(2024, 1, 16), "Juros", "DI", 1002.45),
    ]


def test_terms_of_two_layouts(spark, tmp_path, rows):
    one = ["Codigo do Ativo", "Serie Emissao", "Juros Criterio Novo - Taxa", "Percentual Multiplicador/Rentabilidade", "Classe"]
    two = ["Codigo do Ativo", "Data de Vencimento", "Percentual Multiplicador/Rentabilidade", "Registro CVM da Emissão"]
    a = write(tmp_path / "one", "a.tsv", "x\n" + "\t".join(one) + "\nAB11\tUNI 5\t\t104,5\tS\n")
    write(tmp_path / "one", "b.tsv", "x\n" + "\t".join(one) + "\nAB12\tUNI 6\t2,45\t100\t\n")
    b = write(tmp_path / "two", "c.tsv", "x\n" + "\t".join(two) + "\nAB13\t17/04/2029\t99\tSRE1\n")
    gold = etl.debenture_terms(spark, [(a, one), (b, two)], 1, str(tmp_path / "lake"), RUN)
    assert rows(gold, "enr_codigo_do_ativo", "series", "maturity", "coupon", "covenants", "enr_registro_cvm_da_emissao") == [
        ("AB11", "UNI 5", None, 104.5, "Classe: S", None),
        ("AB12", "UNI 6", None, 2.45, None, None),
        ("AB13", None, dt.date(2029, 4, 17), 99.0, None, "SRE1"),
    ]


def test_traded_prices(spark, tmp_path, rows):
    body = "\t".join(sc.TRADED_PRICES_SOURCE) + "\n" + "".join(
        f"0{d}/01/2024\t1\tAB11\tBR1\t10\t2\t99,1\t1.000,25\t1.001,00\t50,82\n" for d in (2, 3)
    )
    folder = write(tmp_path / "replies", "a.tsv", "x\n" + body)
    listing = spark.createDataFrame([("AB11", "1"), ("AB12", "1")], "asset_code string, issuer string")
    gold, uncovered, dropped = etl.traded_prices(spark, folder, 1, listing, str(tmp_path / "lake"), RUN)
    assert rows(gold, "ref_date", "qty", "avg_unit_price") == [(dt.date(2024, 1, 2), 10, 1000.25), (dt.date(2024, 1, 3), 10, 1000.25)]
    assert rows(uncovered, "asset_code") == [("AB12",)] and dropped.count() == 0


def test_macro_data(spark, tmp_path, rows):
    items = [dict(securityIdentificationCode="USD", description="d", groupDescription="TAXAS DE CÂMBIO", value=5.25, rate=0, lastUpdate="2025-10-19")]
    folder = write(tmp_path / "bodies", "a.json", json.dumps(items, ensure_ascii=False), "UTF-8")
    write(tmp_path / "bodies", "b.json", "[]")
    assert rows(etl.macro_data(spark, folder, str(tmp_path / "lake"), RUN)) == [("USD", "d", "FX", 5.25, dt.date(2025, 10, 19))]


def test_filings(spark, tmp_path, rows):
    text = "CNPJ_Companhia;Categoria;Link_Download;Versao;Data_Referencia\nA;Fato Relevante;u1;1;2024-01-05\nA;Ata;u2;1;2024-01-06\n"
    folder = write(tmp_path / "ipe", "ipe_cia_aberta_2024.csv", text)
    schema = "CNPJ_Companhia string, Categoria string, Link_Download string, Versao string, Data_Referencia string"
    fetch, missing = etl.filings_manifest(spark, folder, schema)
    assert rows(fetch, "url") == [("u1",)] and missing.count() == 2
    forms = write(tmp_path / "fre", "fre.csv", "CNPJ_CIA;DT_RECEB;DT_REFER;LINK_DOC;ID_DOC\nA;2024-05-01;2024-01-01;u1;1\nA;2024-06-01;2024-01-01;u2;2\n")
    latest = etl.latest_reference_forms(spark, forms, "CNPJ_CIA string, DT_RECEB string, DT_REFER string, LINK_DOC string, ID_DOC int", "ID_DOC")
    assert rows(latest, "LINK_DOC") == [("u2",)]


def test_index_documents_skips_complete_ones(spark, rows):
    docs = spark.createDataFrame([("p1", "a b"), ("p2", "c d")], "object_path string, text string")
    meta = op.catalog_rows(docs, RUN, content="text")
    first = etl.index_documents(docs, meta, spark.createDataFrame([], "doc_id string"))
    assert rows(first, "chunk_id") == [("p1#chunk_0",), ("p2#chunk_0",)]
    stored = first.filter("doc_id = 'p1'").select("doc_id")
    assert rows(etl.index_documents(docs, meta, stored), "chunk_id") == [("p2#chunk_0",)]
    assert etl.index_documents(docs, meta, stored, force=True).count() == 2


def dated(cnpj, refer, end, value):
    return f"{cnpj};{refer};1;{end};ÚLTIMO;MIL;3.01;x;{value}\n"


def test_years_of_reference_and_period_end_may_differ(spark, tmp_path, rows):
    """Gold is chosen and replaced by the year of the reference date: no issuer goes because another one comes."""
    lake = str(tmp_path / "lake")
    write(tmp_path / "a", "itr_cia_aberta_DRE_con_2024.csv", HEADER + dated("X", "2024-12-31", "2023-12-31", 1) + dated("Y", "2024-12-31", "2024-12-31", 2))
    etl.financial_statements(spark, str(tmp_path / "a"), lake, RUN)
    write(tmp_path / "b", "dfp_cia_aberta_DRE_con_2024.csv", HEADER + dated("Z", "2024-12-31", "2024-12-31", 3))
    gold = etl.financial_statements(spark, str(tmp_path / "b"), lake, RUN)
    assert rows(gold, "issuer_cnpj", "year", "revenue") == [("X", 2024, 1e3), ("Y", 2024, 2e3), ("Z", 2024, 3e3)]


def test_years_a_file_no_longer_has_leave_gold(spark, tmp_path, rows):
    lake = str(tmp_path / "lake")
    name = "itr_cia_aberta_DRE_con_2024.csv"
    write(tmp_path / "a", name, HEADER + dated("X", "2023-12-31", "2023-12-31", 1) + dated("X", "2024-12-31", "2024-12-31", 2))
    write(tmp_path / "a", "itr_cia_aberta_DRE_ind_2024.csv", HEADER + dated("X", "2024-12-31", "2024-12-31", 5))
    assert etl.financial_statements(spark, str(tmp_path / "a"), lake, RUN).count() == 3
    write(tmp_path / "b", name, HEADER + dated("X", "2024-12-31", "2024-12-31", 2))
    write(tmp_path / "b", "itr_cia_aberta_DRE_ind_2024.csv", HEADER)
    gold = etl.financial_statements(spark, str(tmp_path / "b"), lake, RUN)
    assert rows(gold, "enr_aggregation_type", "year", "revenue") == [("Consolidado", 2024, 2e3)]
    # A file whose year is not covered by the run is not replaced, and a run that fails replaces nothing.
    write(tmp_path / "c", name, HEADER)
    with pytest.raises(ValueError, match="issuer_missing"):
        etl.financial_statements(spark, str(tmp_path / "c"), lake, RUN)
    assert rows(spark.read.parquet(f"{lake}/silver/enriched/statements"), "CNPJ_CIA", "DT_REFER") == [("X", dt.date(2024, 12, 31))]
    write(tmp_path / "d", name, HEADER + dated("X", "2024-12-31", "2024-12-31", 9))
    write(tmp_path / "d", "itr_cia_aberta_DRE_con_2030.csv", HEADER + dated("X", "2030-03-31", "2030-03-31", 4))
    assert rows(etl.financial_statements(spark, str(tmp_path / "d"), lake, RUN, as_of=2030), "year", "revenue") == [(2024, 2e3), (2030, 4e3)]


def test_paths_are_read_once_per_file_and_rows_are_not_shuffled(spark, tmp_path, rows, monkeypatch):
    """Names that need escaping in a path match as well."""
    raw = tmp_path / "raw a%20b"
    write(raw, "itr_cia_aberta_DRE_con_2024 é 1+1%.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "3.01", 10) + line("B", "2024-03-31", "ÚLTIMO", "MIL", "3.01", 2))
    write(raw, "itr_cia_aberta_DVA_con_2024.csv", HEADER + line("A", "2024-03-31", "ÚLTIMO", "MIL", "3.01", 5))
    plans, stage = [], op.stage_gold

    def seen(df, path, *args, **more):
        if "/silver/" in path:
            plans.append(df._jdf.queryExecution().toString())
        return stage(df, path, *args, **more)

    monkeypatch.setattr(op, "stage_gold", seen)
    spark.createDataFrame([("A",), ("B",)], "issuer_cnpj string").write.parquet(str(tmp_path / "issuers"))
    issuers = spark.read.parquet(str(tmp_path / "issuers"))
    for name in ("A", "B"):
        gold = etl.financial_statements(spark, str(raw), str(tmp_path / "lake"), RUN, issuers=issuers.filter(f"issuer_cnpj = '{name}'"))
    assert rows(gold, "issuer_cnpj", "revenue") == [("A", 10e3), ("B", 2e3)]
    for text in plans:
        physical = text[text.index("== Physical Plan =="):]
        assert not any(word in physical for word in ("RLIKE", "regexp_extract", "SortMergeJoin", "ShuffledHashJoin")), physical
        # The rows stored before are laid out anew, those of the files are not.
        assert physical.count("REBALANCE") <= 1


def test_stored_rows_are_laid_out_anew(spark, tmp_path):
    """Runs over one issuer each do not leave a file of each run behind."""
    raw, lake, n = tmp_path / "raw", str(tmp_path / "lake"), 6
    write(raw, "itr_cia_aberta_DRE_con_2024.csv", HEADER + "".join(line(f"I{i}", "2024-03-31", "ÚLTIMO", "MIL", "3.01", i) for i in range(n)))
    for i in range(n):
        gold = etl.financial_statements(spark, str(raw), lake, RUN, issuers=spark.createDataFrame([(f"I{i}",)], "issuer_cnpj string"))
    assert gold.count() == n
    assert len(spark.read.parquet(f"{lake}/silver/enriched/statements").inputFiles()) <= 2
