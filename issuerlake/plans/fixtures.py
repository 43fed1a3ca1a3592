"""Domain inputs derived from the provided tables.

Every input is a projection of a whole table, or a grouping of it by a key that bounds the group
(blocks of consecutive unique keys). The issuer of a row is one of fifty, taken from its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuerlake.schemas import EVENTS_SCHEDULE_COLUMNS, EVENTS_SCHEDULE_SOURCE, STATEMENT_CODES
from issuerlake.session import shared_dir

ACCOUNT_CODES = [
    "1.01.01", "2.01.04", "2.01.04.01", "2.02.01", "2.02.01.02", "3.01", "3.04.04", "3.05", "3.06.02", "6.01.02",
    "6.01.02.02", "6.02.01", "6.02.01.01", "1.02",
]
RUN = {
    "trace_id": "trace-0001", "source": "CVM", "last_update": "2025-10-06T08:01:00", "ref_date": "2025-10-19",
    "ingest_ts": "2025-10-19T12:00:00",
}
PREAMBLE = ["SND - Sistema Nacional de Debêntures", "Agenda de eventos"]
CATEGORIES = ["Fato Relevante", "Comunicado ao Mercado", "Escrituras e aditamentos de debêntures", "Calendário", "Ata"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cnpj(k: str) -> str:
    nn = f"lpad(cast({k} % 50 as string), 2, '0')"
    return f"concat('00.000.0', {nn}, '/0001-', {nn})"


def br(cents: str) -> str:
    return (
        f"concat(replace(format_number({cents} div 100, 0), ',', '.'), ',', "
        f"lpad(cast({cents} % 100 as string), 2, '0'))"
    )


def dmy(d: str) -> str:
    iso = f"cast(cast({d} as date) as string)"
    return f"concat(substr({iso}, 9, 2), '/', substr({iso}, 6, 2), '/', substr({iso}, 1, 4))"


def asset(k: str, n: int) -> str:
    return f"concat('DEB', lpad(cast({k} % {n} as string), 3, '0'))"


def statement_rows(spark: SparkSession, sf: str, lineitem: DataFrame | None = None) -> DataFrame:
    """account rows as the statement files hold them, with the path of the file they belong to."""
    codes = ", ".join(f"'{c}'" for c in ACCOUNT_CODES)
    quarter_end = "last_day(make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1))"
    code = f"element_at(array({codes}), cast(l_partkey % 14 as int) + 1)"
    stmts = "'BPA', 'BPP', 'DRE'"
    rows = (lineitem or table(spark, sf, "lineitem")).selectExpr(
        f"{cnpj('l_orderkey')} AS CNPJ_CIA",
        f"{quarter_end} AS DT_REFER",
        "1 AS VERSAO",
        f"{quarter_end} AS DT_FIM_EXERC",
        "CASE WHEN l_linestatus = 'F' THEN 'ÚLTIMO' ELSE 'PENÚLTIMO' END AS ORDEM_EXERC",
        "element_at(array('UNIDADE', 'MIL', 'MILHOES', 'DESCONHECIDA'), l_linenumber % 4 + 1) AS ESCALA_MOEDA",
        f"{code} AS CD_CONTA",
        "l_returnflag AS DS_CONTA",
        "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS VL_CONTA",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'con' ELSE 'ind' END AS agg",
        f"CASE WHEN startswith({code}, '6') THEN 'DFC_MI' "
        f"ELSE element_at(array({stmts}), cast(left({code}, 1) as int)) END AS stmt",
        f"year({quarter_end}) AS file_year",
        f"CASE WHEN quarter({quarter_end}) = 4 THEN 'dfp' ELSE 'itr' END AS form",
    )
    return rows.selectExpr(
        "* EXCEPT (form)",
        "upper(form) AS ORIGIN_FILE",
        "concat('bronze/raw/', form, '_cia_aberta_', stmt, '_', agg, '_', file_year, '.csv') AS source_path",
    )


def tagged_statements(spark: SparkSession, sf: str, lineitem: DataFrame | None = None) -> DataFrame:
    """F1 with document and aggregation type, without going through file names."""
    doc_types = ", ".join(f"'{k}', '{v}'" for k, v in STATEMENT_CODES.items())
    return statement_rows(spark, sf, lineitem).selectExpr(
        "* EXCEPT (agg, stmt, source_path)",
        f"map({doc_types})[stmt] AS enr_origin_document_type",
        "CASE WHEN agg = 'con' THEN 'Consolidado' ELSE 'Individual' END AS enr_aggregation_type",
    )


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """event schedule as text, under the names of the gold table."""
    pay = "date_add(ts, cast(event_id % 5 as int))"
    rows = table(spark, sf, "events").selectExpr("*", "cast(round(value * 100) as bigint) AS cents")
    return rows.selectExpr(
        "event_id",
        f"{dmy('ts')} AS event_date",
        f"CASE WHEN event_id % 97 = 0 THEN '31/02/2024' ELSE {dmy(pay)} END AS payment_date",
        f"{cnpj('user_id')} AS issuer",
        f"{asset('user_id', 200)} AS asset_code",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN ' Juros ' ELSE 'Amortizacao' END AS event",
        "concat(event_type, event_type) AS yield_type",
        "CASE WHEN event_id % 11 = 0 THEN '-' WHEN event_id % 13 = 0 THEN 'nan' WHEN event_id % 17 = 0 THEN '' "
        f"ELSE {br('cents')} END AS rate_or_percent",
        f"{dmy(pay)} AS settlement_date",
    )


def past_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events paid in the years of the price table; a few have no date."""
    return table(spark, sf, "events").selectExpr(
        "event_id",
        f"{asset('user_id', 210)} AS asset_code",
        "CASE WHEN event_id % 97 <> 0 THEN date_add(date'1994-12-01', cast(event_id * 37 % 2600 as int)) END AS payment_date",
    )


def event_replies(spark: SparkSession, sf: str, rows_per_reply: int = 2000, quoted: bool = False) -> str:
    """F2 written as replies with a preamble, one file each; returns the folder. With ``quoted`` every 19th issuer is a
    quoted cell of two lines, in two replies of three."""
    path = shared_dir(spark, "event-replies")
    cells = {c: F.col(c) for c in EVENTS_SCHEDULE_COLUMNS}
    if quoted:
        cells["issuer"] = F.expr(f"""CASE WHEN event_id % 19 = 0 AND (event_id div {rows_per_reply}) % 3 > 0
          THEN concat('"', issuer, '\n""matriz"" / SP"') ELSE issuer END""")
    line = F.concat_ws("\t", *cells.values())
    head = "\n".join([*PREAMBLE, "\t".join(EVENTS_SCHEDULE_SOURCE)])
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"]), "\n"
    )
    (
        raw_events(spark, sf)
        .groupBy(F.expr(f"event_id div {rows_per_reply}").alias("reply"))
        .agg(F.concat(F.lit(head + "\n"), body).alias("value"))
        .write.partitionBy("reply")
        .text(path)
    )
    return path


def reply_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """F2 as replies of up to 100 events. Every seventh has another header; every fifth knows no issuer; every
    eleventh holds one event."""
    line = F.concat_ws("\t", *[F.col(c) for c in EVENTS_SCHEDULE_COLUMNS])
    ordered = F.array_sort(F.collect_list(F.struct("event_id", line.alias("line"))))
    head = "\t".join(EVENTS_SCHEDULE_SOURCE)
    lines = (
        raw_events(spark, sf).withColumn("reply_id", F.expr("event_id div 100")).groupBy("reply_id")
        .agg(F.transform(ordered, lambda x: x["line"]).alias("lines"))
    )
    rows = F.expr("CASE WHEN reply_id % 5 = 0 THEN array('Nenhum evento encontrado') WHEN reply_id % 11 = 0 THEN slice(lines, 1, 1) ELSE lines END")
    header = F.when(F.col("reply_id") % 7 == 0, head.replace("\t", ";")).otherwise(head)
    return lines.select("reply_id", F.concat(F.lit("\n".join(PREAMBLE) + "\n"), header, F.lit("\n"), F.array_join(rows, "\n")).alias("body"))


def raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    """traded prices as text."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_shipdate", "l_partkey", "l_quantity", "l_linenumber", "cast(round(l_extendedprice * 100) as bigint) AS cents",
    ).selectExpr("*", "cents * 9 div 10 AS low", "cents * 11 div 10 AS high", "l_partkey % 20000 AS curve")
    return rows.selectExpr(
        f"{dmy('l_shipdate')} AS ref_date",
        f"{cnpj('l_partkey')} AS issuer",
        f"{asset('l_partkey', 200)} AS asset_code",
        "concat('BR', cast(l_partkey as string)) AS ISIN",
        "cast(l_quantity as bigint) AS qty",
        "cast(l_linenumber as bigint) AS amt_of_trades",
        f"{br('low')} AS min_unit_price",
        f"{br('cents')} AS avg_unit_price",
        f"{br('high')} AS max_unit_price",
        f"{br('curve')} AS curve_price_percent",
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """debenture listing, one row per asset code."""
    return (
        table(spark, sf, "part")
        .groupBy(F.expr(asset("p_partkey", 250)).alias("asset_code"), F.expr(cnpj("p_partkey")).alias("issuer"))
        .agg(F.max("p_type").alias("situation"))
    )


def listing_pages(spark: SparkSession, sf: str, rows_per_page: int = 40) -> DataFrame:
    """Listing pages: one table of the listing class per block of parts, and one of another class."""
    row = F.expr(
        f"""concat('<tr><td>&nbsp;</td><td><a href="x?selecao=', {asset('p_partkey', 250)}, '"> ', {asset('p_partkey', 250)},
        ' </a></td><td> ', {cnpj('p_partkey')}, ' &amp; CIA &Ccedil;&#213;ES</td><td></td><td>',
        CASE WHEN p_partkey % 3 = 0 THEN concat('<table class=inner><tr><td>', p_type, '</td></tr></table>') ELSE p_type END,
        '</td><td></td></tr>')"""
    )
    empty = "<tr><td></td><td>no link</td><td>x</td><td></td><td>y</td></tr><tr><th>head</th></tr>"
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]), "\n")
    html = F.concat(
        F.lit('<html><table class="other"><tr><td>1</td><td><a>NO</a></td><td>3</td><td>4</td><td>5</td></tr></table>'),
        F.expr("""CASE WHEN page_id % 2 = 0 THEN '<TABLE width="1" class="wide Tab10333333">' ELSE '<table class=Tab10333333 width=1>' END"""),
        F.lit(empty), F.col("body"), F.lit("</TABLE></html>"),
    )
    grouped = table(spark, sf, "part").withColumn("page_id", F.expr(f"p_partkey div {rows_per_page}")).groupBy("page_id")
    return grouped.agg(body.alias("body")).select("page_id", html.alias("html"))


def rad_texts(spark: SparkSession, sf: str, per_reply: int = 20) -> DataFrame:
    """search replies as one text per block of orders."""
    record = F.expr(
        f"""concat_ws('$&', cast(o_custkey % 50 as string), concat(' Company ', o_custkey % 50, ' '), o_orderpriority,
        CASE WHEN o_orderkey % 2 = 0 THEN 'PDF' ELSE 'XML' END, concat('<b>Doc ', o_orderkey, '</b>'),
        concat('<span>', {dmy('o_orderdate')}, '</span>'),
        CASE WHEN o_orderkey % 7 = 0 THEN 'sem data' ELSE {dmy('date_add(o_orderdate, 3)')} END,
        o_orderstatus, '1', 'x',
        concat('<i onclick="OpenDownloadDocumentos(''', o_orderkey, ''')"></i><a href="?NumeroProtocoloEntrega=',
        o_orderkey + 100000, '">'))"""
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("r")))), lambda x: x["r"]), "*")
    return (
        table(spark, sf, "orders").groupBy(F.expr(f"o_orderkey div {per_reply}").alias("reply_id"))
        .agg(F.concat(F.lit("*"), body, F.lit("* ")).alias("text"))
    )


def macro_bodies(spark: SparkSession, sf: str, per_body: int = 100) -> DataFrame:
    """quote feed, one JSON array per block of parts."""
    item = F.expr(
        """named_struct('securityIdentificationCode', concat('S', p_partkey), 'description', p_name,
        'groupDescription', element_at(array('TAXAS DE CÂMBIO', 'TAXAS DE JUROS INTERNACIONAL', 'TAXAS DE JUROS NACIONAL'),
        cast(p_partkey % 3 as int) + 1),
        'value', CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE 0D END,
        'rate', CASE WHEN p_partkey % 3 = 0 THEN 0D ELSE cast(p_size as double) END, 'lastUpdate', '2025-10-19')"""
    )
    return (
        table(spark, sf, "part").groupBy(F.expr(f"p_partkey div {per_body}").alias("body_id"))
        .agg(F.to_json(F.collect_list(item)).alias("body"))
    )


def filings(spark: SparkSession, sf: str, documents: DataFrame | None = None) -> DataFrame:
    """filings and catalog objects, one per document; the text is their content."""
    cats = ", ".join(f"'{c}'" for c in CATEGORIES)
    return (documents or table(spark, sf, "documents")).selectExpr(
        "doc_id",
        "text",
        "source",
        "concat('gold/documents/', source, '/doc_', doc_id, '.pdf') AS object_path",
        "concat('gold/documents/', source) AS folder",
        "sha2(text, 256) AS file_hash",
        f"{cnpj('doc_id')} AS issuer_cnpj",
        f"element_at(array({cats}), cast(doc_id % 5 as int) + 1) AS category",
        f"element_at(array({cats}), cast(doc_id % 5 as int) + 1) AS title",
        "element_at(array('FATO_RELEVANTE', 'COMUNICADOS_AO_MERCADO', 'ESCRITURAS_E_ADITAMENTO_DE_DEBENTURES', "
        "'OUTROS', 'OUTROS'), cast(doc_id % 5 as int) + 1) AS document_type",
        "cast(1 + doc_id % 3 as string) AS version",
        "date_format(date_add(date'2024-01-01', cast(doc_id % 366 as int)), 'yyyy-MM-dd') AS ref_date",
        "date_format(date_add(date'2024-01-01', cast(doc_id * 7 % 366 as int)), 'yyyy-MM-dd') AS receipt_date",
        "cast(2022 + doc_id % 4 as int) AS file_year",
        "CASE WHEN doc_id % 2 = 0 THEN 'ITR' ELSE 'DFP' END AS form",
        "CASE WHEN doc_id % 4 = 0 THEN 'Consolidado' WHEN doc_id % 4 = 1 THEN 'Individual' END AS aggregation_type",
        "concat('https://filings.example.org/', doc_id) AS url",
        "CASE WHEN doc_id % 3 <> 0 THEN concat('Resumo ', doc_id) END AS summary",
        "CASE WHEN doc_id % 2 = 0 THEN concat('https://filings.example.org/', doc_id) END AS document_url",
    )


def landed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("receipt_date") < "2024-07-01")


def arriving(df: DataFrame) -> DataFrame:
    return df.filter(F.col("receipt_date") >= "2024-07-01")


def litigation(spark: SparkSession, sf: str) -> DataFrame:
    """F8: court cases, one per order."""
    return table(spark, sf, "orders").selectExpr(
        "concat(lpad(cast(o_orderkey as string), 7, '0'), '-56.2024.8.26.0100') AS case_id",
        f"{cnpj('o_custkey')} AS issuer_cnpj",
        "concat(cast(1 + o_orderkey % 9 as string), 'a Vara') AS court",
        "o_orderstatus AS stage",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS last_movement_date",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'Ação de Indenização' ELSE 'Ação Trabalhista' END AS case_type",
        "CASE WHEN o_orderkey % 4 <> 0 THEN concat('Fatos ', o_orderkey) END AS enr_principais_fatos",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat('Impacto ', o_orderkey) END AS enr_impacto_em_caso_de_perda",
        "CASE WHEN o_orderkey % 31 = 0 THEN 'n/d' ELSE cast(o_totalprice as string) END AS claimed_value",
        "element_at(array('high', 'Provável', 'medium', 'Possível', 'Remoto'), cast(left(o_orderpriority, 1) as int)) AS risk",
    )


def payload_xml(spark: SparkSession, sf: str) -> DataFrame:
    """XML documents whose sections hold a base64 payload: beside other elements, before or after its
    name, with attributes, and in every fifth document one without a name."""

    def payload(content: str) -> str:
        encoded = f"replace(base64(encode({content}, 'UTF-8')), '\\r\\n', '')"
        return f"concat('<ImagemObjetoArquivoPdf>', {encoded}, '</ImagemObjetoArquivoPdf>')"

    name = lambda prefix: f"concat('<NomeArquivoPdf>{prefix}_', doc_id, '.pdf</NomeArquivoPdf>')"
    return table(spark, sf, "documents").selectExpr(
        "doc_id",
        f"""concat('<Doc><Note>n', doc_id, '</Note><SecText ref="http://x/y>z"><Id>1</Id>', {name('doc')}, '<!-- <x> -->', {payload('text')},
        '</SecText><SecSource>', CASE WHEN doc_id % 3 = 0 THEN concat({payload('source')}, '<Date/>', {name('src')})
        ELSE concat({name('src')}, {payload('source')}) END, '</SecSource>',
        CASE WHEN doc_id % 5 = 0 THEN concat('<SecBare>', {payload('lang')}, '<ImagemObjetoArquivoPdf/></SecBare>') ELSE '' END, '</Doc>') AS xml""",
    )


def stamp_pages(spark: SparkSession, sf: str) -> DataFrame:
    """dataset pages; every third lacks the labelled row, every seventh any stamp."""
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return table(spark, sf, "events").selectExpr(
        "event_id",
        f"""CASE WHEN event_id % 7 = 0 THEN '<html><span class="other">none</span></html>'
        WHEN event_id % 3 = 0 THEN concat('<p><span class="automatic-local-datetime">em ', {iso}, 'Z (UTC)</span></p>')
        ELSE concat('<p><span class="automatic-local-datetime" data-datetime="2020-01-01T00:00:00+0000">x</span></p>',
          '<table><tr><th>Criado</th><td>y</td></tr><tr><th> Última Atualização </th><td>',
          '<span class="automatic-local-datetime" data-datetime="', {iso}, '+0000">z</span></td></tr></table>') END AS html""",
    )


def issuers(spark: SparkSession, sf: str) -> DataFrame:
    """issuer dimension; name and industry are those of the issuer's first customer."""
    return (
        table(spark, sf, "customer").groupBy(F.expr(cnpj("c_custkey")).alias("issuer_cnpj"))
        .agg(F.min_by("c_name", "c_custkey").alias("issuer_name"), F.min_by("c_mktsegment", "c_custkey").alias("industry"))
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """lookup requests with none, one or two keys, some of them unknown."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS request_id",
        f"CASE WHEN event_id % 4 IN (0, 3) AND event_id % 7 <> 0 THEN {asset('event_id', 300)} END AS ticker",
        f"CASE WHEN event_id % 4 = 1 THEN {cnpj('user_id')} END AS issuer_cnpj",
        "CASE WHEN event_id % 4 IN (2, 3) THEN concat('Customer#', lpad(cast(user_id % 60 as string), 9, '0')) END AS issuer_name",
    )


def raw_terms(spark: SparkSession, sf: str) -> DataFrame:
    """F16: terms under the source's headers."""
    return table(spark, sf, "part").selectExpr(
        f"{asset('p_partkey', 250)} AS asset_code",
        "p_partkey AS `Codigo (Interno)`",
        "p_brand AS `Serie Emissao`",
        "CASE WHEN p_partkey % 9 = 0 THEN '31/02/2024' ELSE '17/04/2029' END AS `Data de Vencimento`",
        "CASE WHEN p_size % 5 = 0 THEN ' - ' ELSE p_type END AS indice",
        "CASE WHEN (p_partkey % 250) % 4 = 0 OR (p_partkey % 4 = 1 AND p_size % 2 = 0) THEN NULL "
        "ELSE concat(p_size div 10, CASE WHEN p_partkey % 3 = 0 THEN '.' ELSE ',' END, p_size % 10) END AS `Juros Criterio Novo - Taxa`",
        "cast(p_size + 100 as string) AS `Percentual Multiplicador/Rentabilidade`",
        "element_at(array('S', 'N', ''), cast(p_partkey % 3 as int) + 1) AS `Resgate Antecipado`",
        "CASE WHEN p_partkey % 5 <> 0 THEN 'N' END AS `Escritura Padronizada`",
        "left(p_type, 3) AS Classe",
        "p_name AS `Ato Societario (1)`",
    )


def search_queries(spark: SparkSession, sf: str) -> DataFrame:
    """every benchmark text as a query, with a vector between those of two other ids, so that it is none of the corpus."""
    b = table(spark, sf, "benchmark").selectExpr(
        "item_id AS query_id", "text AS q", "(item_id * 7 + 13) % 97 AS near", "(item_id * 11 + 129) % 193 AS far"
    )
    v = vectors(spark, sf)
    both = b.join(v.selectExpr("doc_id AS near", "vector AS a"), "near", "left").join(v.selectExpr("doc_id AS far", "vector AS b"), "far", "left")
    return both.selectExpr("query_id", "q", "zip_with(a, b, (x, y) -> cast(x as double) + 0.8D * cast(y as double)) AS vector")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr("vec_id AS doc_id", "embedding AS vector", "label")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source")


def synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Word pairs that follow each other in the query texts stand in for a synonym table."""
    t = table(spark, sf, "benchmark").selectExpr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+', 0) AS t")
    pair = F.explode(F.arrays_zip(F.slice("t", 1, F.size("t") - 1).alias("term"), F.slice("t", 2, F.size("t")).alias("synonym")))
    return t.filter(F.size("t") > 1).select(pair.alias("p")).select("p.term", "p.synonym").distinct()
