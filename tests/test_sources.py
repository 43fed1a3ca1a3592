from __future__ import annotations

import base64
import json
import time

import pytest

from issuerlake import sources as src

SCHEMA = "CNPJ_CIA string, ORDEM_EXERC string, VL_CONTA double"


def write(path, text, encoding="ISO-8859-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path.parent)


def test_delimited_reads_latin1_and_tags_files(spark, tmp_path, rows):
    body = "CNPJ_CIA;ORDEM_EXERC;VL_CONTA\n1;ÚLTIMO;1.5\n2;PENÚLTIMO;\n"
    for name in ("itr_cia_aberta_BPA_con_2023.csv", "dfp_cia_aberta_DRE_ind_2022.csv", "itr_cia_aberta_DMPL_con_2023.csv"):
        write(tmp_path / "raw" / name, body)
    df = src.tag_origin_file(src.tag_files(src.with_path(src.read_delimited(spark, str(tmp_path / "raw"), SCHEMA))))
    assert rows(df, "CNPJ_CIA", "ORDEM_EXERC", "VL_CONTA", "statement_code", "enr_aggregation_type", "file_year", "ORIGIN_FILE") == [
        ("1", "ÚLTIMO", 1.5, "BPA", "Consolidado", 2023, "ITR"),
        ("1", "ÚLTIMO", 1.5, "DRE", "Individual", 2022, "DFP"),
        ("2", "PENÚLTIMO", None, "BPA", "Consolidado", 2023, "ITR"),
        ("2", "PENÚLTIMO", None, "DRE", "Individual", 2022, "DFP"),
    ]


@pytest.mark.parametrize("header", ["ORDEM_EXERC;CNPJ_CIA;VL_CONTA", "CNPJ_CIA;ORDEM;VL_CONTA"])
def test_delimited_rejects_other_headers(spark, tmp_path, header):
    path = write(tmp_path / "raw" / "x.csv", header + "\na;b;1\n")
    with pytest.raises(Exception, match="(?i)header"):
        src.read_delimited(spark, path, SCHEMA).collect()


def test_preamble_tsv(spark, tmp_path, rows):
    path = write(tmp_path / "replies" / "a.tsv", "título\r\nlinha\r\nData\tLiquidação\r\n01/02/2024\tx\r\nnan\t\r\nshort\r\n")
    df = src.read_preamble_tsv(spark, path, 2, ["Data", "Liquidação"], names=["d", "s"])
    assert rows(df, "line_no", "d", "s") == [(0, "01/02/2024", "x"), (1, None, None), (2, "short", None)]
    with pytest.raises(Exception, match="unexpected header"):
        src.read_preamble_tsv(spark, path, 1, ["Data", "Liquidação"]).collect()


def quote(i, group, value, rate):
    return dict(securityIdentificationCode=i, description="d" + i, groupDescription=group, value=value, rate=rate, lastUpdate="2025-10-19")


def test_macro_feed(spark, rows):
    body = [quote("USD", "TAXAS DE CÂMBIO", 5.25, 0), quote("SELIC", "TAXAS DE JUROS NACIONAL", 0, 11.25)]
    df = spark.createDataFrame([(json.dumps(body),), ("[]",)], "body string")
    gold = src.macro_gold(src.parse_macro(df))
    assert rows(gold, "security_id", "data_type", "value") == [("SELIC", "DOMESTIC_RATES", 11.25), ("USD", "FX", 5.25)]
    empty = src.macro_gold(src.parse_macro(spark.createDataFrame([("[]",)], "body string")))
    assert empty.count() == 0 and empty.columns == ["security_id", "description", "data_type", "value", "ref_date"]


def test_macro_compares_numbers_not_text(spark, rows):
    body = [quote("A", "TAXAS DE CÂMBIO", "9,5", "10,25"), quote("B", "TAXAS DE CÂMBIO", -1, 0), quote("C", "TAXAS DE CÂMBIO", None, 2)]
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    assert rows(src.macro_gold(src.parse_macro(df)), "security_id", "value") == [("A", 10.25), ("B", 0.0), ("C", 2.0)]


def test_macro_rejects_bad_input(spark):
    bad_label = spark.createDataFrame([(json.dumps([quote("X", "OTHER", 1, 0)]),)], "body string")
    with pytest.raises(Exception, match="unmapped label"):
        src.macro_gold(src.parse_macro(bad_label)).collect()
    assert src.macro_gold(src.parse_macro(bad_label), strict=False).first()["data_type"] is None
    with pytest.raises(Exception):
        src.parse_macro(spark.createDataFrame([("[{",)], "body string")).collect()


def test_rad_records(spark):
    buttons = "OpenDownloadDocumentos('77','x')NumeroProtocoloEntrega=123 mostraLocaisPublicacao('a', 'Jornal X')"
    full = "$&".join(["1 ", " ACME", "Cat", "PDF", "<b>T</b> 1 ", "em 01/02/2024", "sem", " Ativo", "", "", buttons, ""])
    df = src.parse_rad(spark.createDataFrame([(f"* *{full}*short$&only*",)], "text string"))
    first, second = sorted(df.collect(), key=lambda r: r["company_code"])
    assert first.asDict() == dict(
        company_code="1", company_name="ACME", category="Cat", document_type="PDF", title="T 1", reference_date="01/02/2024",
        delivery_date=None, status="Ativo", protocol_id="123", download_id="77", publication_info="Jornal X",
    )
    assert (second["company_name"], second["title"], second["protocol_id"]) == ("only", "", None)
    with pytest.raises(Exception, match="search result without"):
        src.rad_manifest(df, "X").collect()


def test_listing_rows(spark, rows):
    row = "<tr><td></td><td><a href='x'> AB&amp;C <b>1</b></a></td><td> Emissor </td><td></td><td>Registrado</td></tr>"
    html = (
        f'<table class="Tab10333333 x">{row}<tr><td>1</td><td>no link</td><td></td><td></td><td></td></tr>'
        f"<tr><td>1</td><td><a>few</a></td></tr></table><table class='Tab1033'>{row}</table>"
    )
    df = src.extract_rows(spark.createDataFrame([(1, html), (2, "")], "page_id int, html string"))
    assert rows(df) == [(1, "AB&C 1", "Emissor", "Registrado")]


def test_listing_rows_of_any_markup(spark, rows):
    html = (
        "<table class=Tab10333333><tr><td><td><a href=1>A1 </a><td>CONSTRU&Ccedil;&Otilde;ES &#65; &amp; B<td><td>ok"
        "<tr><td></td><td><a>B2</a></td><td>x</td><td><table><tr><td>n<td>m</table></td><td>s</td></tr></table>"
        '<table class="Tab10333333-x"><tr><td>1<td><a>NO</a><td>3<td>4<td>5</table>'
    )
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert rows(src.extract_rows(df)) == [(1, "A1", "CONSTRUÇÕES A & B", "ok"), (1, "B2", "x", "s")]


def test_replies_with_quotes_and_extra_cells(spark, tmp_path, rows):
    head = "a\tb\n"
    (tmp_path / "x.tsv").write_text(head + '"x ""y"""\t1\nz\n"t\tu"\tnan\n')
    assert rows(src.read_preamble_tsv(spark, str(tmp_path), 0, ["a", "b"]), "a", "b") == [("t\tu", None), ('x "y"', "1"), ("z", None)]
    (tmp_path / "y.tsv").write_text(head + "1\t2\t3\n")
    with pytest.raises(Exception, match="more cells than columns"):
        src.read_preamble_tsv(spark, str(tmp_path), 0, ["a", "b"]).select("b").collect()


def test_update_stamp(spark, rows):
    span = '<span class="automatic-local-datetime" data-datetime="{}">x</span>'
    labelled = f'<tr><th>Última Atualização</th><td>{span.format("2025-10-06T11:01:00+0000")}</td></tr>'
    pages = [
        (1, span.format("2001-01-01T00:00:00Z") + labelled),
        (2, '<span class="automatic-local-datetime">em 2025-10-06T11:01:00+02:00 (local)</span>'),
        (3, '<span class="automatic-local-datetime">outubro 6</span>'),
        (4, "<p>none</p>"),
        (5, "<tr><th>Última Atualização</th><td>-</td></tr>" + f"<tr><td>{span.format('2025-01-01T00:00:00-0300')}</td></tr>"),
    ]
    df = spark.createDataFrame(pages, "id int, html string")
    want = [(1, "2025-10-06T08:01:00"), (2, "2025-10-06T06:01:00"), (3, None), (4, None), (5, "2025-01-01T00:00:00")]
    assert rows(src.extract_stamp(df)) == want
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert rows(src.extract_stamp(df)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_payloads(spark, rows):
    pdf = base64.b64encode(b"%PDF-1").decode()
    xml = (
        f"<R><A><NomeArquivoPdf>a.pdf</NomeArquivoPdf><ImagemObjetoArquivoPdf> {pdf} </ImagemObjetoArquivoPdf></A>"
        "<B x='1'>\n <NomeArquivoPdf>b.pdf</NomeArquivoPdf>\n <ImagemObjetoArquivoPdf>@@bad@@</ImagemObjetoArquivoPdf></B>"
        "<C><NomeArquivoPdf>c.pdf</NomeArquivoPdf><ImagemObjetoArquivoPdf></ImagemObjetoArquivoPdf></C></R>"
    )
    df = spark.createDataFrame([(1, xml)], "id int, xml string")
    assert rows(src.extract_payloads(df), "ordinal", "tag", "file_name", "n_bytes") == [(0, "A", "a.pdf", 6), (1, "B", "b.pdf", None)]
    stripped = src.strip_payloads(df).first()["xml"]
    assert pdf not in stripped and "@@" not in stripped and stripped.count("<ImagemObjetoArquivoPdf></ImagemObjetoArquivoPdf>") == 3
    replies = spark.createDataFrame([(f" {pdf}\n",), ("***",)], "payload string")
    assert [(r["content"], r["n_bytes"]) for r in src.decode_payload(replies).collect()] == [(b"%PDF-1", 6), (None, None)]


def test_payloads_in_any_place(spark, rows):
    p = lambda t: f"<ImagemObjetoArquivoPdf>{t}</ImagemObjetoArquivoPdf>"
    xml = (
        f"<R><S a='http://x/y>'><Id>1</Id><NomeArquivoPdf>a &amp; b</NomeArquivoPdf><!-- {p('QQ==')} -->{p('QQ==')}</S>"
        f"<T>{p('Qg==')}<D/><NomeArquivoPdf>t</NomeArquivoPdf></T><U>{p('Qw==')}{p(' ')}</U></R>"
    )
    df = spark.createDataFrame([(1, xml, "k"), (2, None, "k")], "id int, xml string, other string")
    assert rows(src.extract_payloads(df), "ordinal", "tag", "file_name", "n_bytes") == [(0, "S", "a & b", 1), (1, "T", "t", 1), (2, "U", None, 1)]
    stripped = {r["id"]: r["xml"] for r in src.strip_payloads(df).collect()}
    assert stripped[2] is None
    assert stripped[1] == xml.replace(" -->" + p("QQ=="), " -->" + p("")).replace(p("Qg=="), p("")).replace(p("Qw=="), p(""))


def test_manifest_paths(spark, rows):
    df = spark.createDataFrame(
        [("c", "Fato Relevante", "u1", "2", "2024-01-05"), ("c", "Ata", "u2", "1", "2024-01-06")],
        "issuer_cnpj string, category string, url string, version string, ref_date string",
    )
    assert rows(src.manifest(df), "url", "target_path") == [("u1", "gold/documents/CVM/FATO_RELEVANTE_2-20240105.pdf")]


def test_ragged_layouts(spark):
    df = src.select_ragged(spark.createDataFrame([("x",)], "a string"), ["a", "b"])
    assert df.columns == ["a", "b"] and df.first()["b"] is None


def test_quoted_cells_may_hold_line_breaks(spark, tmp_path, rows):
    body = 'a\tb\n1\t"two\nlines"\n\n"3 ""x""\r\n"\t4\r\n"t\tab"\tno "quote" here\n5\t"last"'
    (tmp_path / "a.tsv").write_bytes(body.encode())
    (tmp_path / "b.tsv").write_bytes(b"a\tb\n6\t7\n")
    got = rows(src.read_preamble_tsv(spark, str(tmp_path), 0, ["a", "b"]), "line_no", "a", "b")
    assert got == [(0, "1", "two\nlines"), (0, "6", "7"), (2, '3 "x"\n', "4"), (3, "t\tab", 'no "quote" here'), (4, "5", "last")]
    (tmp_path / "c.tsv").write_bytes(b'a\tb\n1\t"open\n2\t3\n')
    with pytest.raises(Exception, match="not closed"):
        src.read_preamble_tsv(spark, str(tmp_path), 0, ["a", "b"]).collect()


def test_records_take_linear_time():
    from issuerlake.sources.parsers import records

    assert records(None, "\t") is None and records("", "\t") == [""]
    for piece in ('"a""b\n', '""', '"x"\t"y\nz"\n', 'a"b"c\t\n'):
        text = piece * (600_000 // len(piece) // 2 * 2)
        start = time.perf_counter()
        try:
            records(text, "\t")
        except ValueError:
            pass
        assert time.perf_counter() - start < 5


@pytest.mark.parametrize("piece", ['<a b="x ', "<a<a", "<a ", "<!--", "<![CDATA[", "<?x", "<a b='c>d' ", "<SecText><", "a<b", "<b></i>"])
def test_malformed_xml_takes_linear_time(piece):
    from issuerlake.sources.parsers import payloads

    start = time.perf_counter()
    payloads(piece * (500_000 // len(piece)))
    assert time.perf_counter() - start < 5
