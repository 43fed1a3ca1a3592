"""The same results in DuckDB SQL, straight from the tables.

Inputs are stated here a second time, independently of the Spark fixtures; parsers are checked
against the rows their text inputs were made of.
"""

from __future__ import annotations


def cnpj(k: str) -> str:
    nn = f"lpad(CAST({k} % 50 AS VARCHAR), 2, '0')"
    return f"('00.000.0' || {nn} || '/0001-' || {nn})"


def br(cents: str) -> str:
    return (
        f"(replace(format('{{:,}}', {cents} // 100), ',', '.') || ',' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"
    )


def dmy(d: str) -> str:
    return f"strftime({d}, '%d/%m/%Y')"


def asset(k: str, n: int) -> str:
    return f"('DEB' || lpad(CAST({k} % {n} AS VARCHAR), 3, '0'))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- inputs --------------------------------------------------------------------------------------

CODES = (
    "['1.01.01','2.01.04','2.01.04.01','2.02.01','2.02.01.02','3.01','3.04.04','3.05','3.06.02','6.01.02',"
    "'6.01.02.02','6.02.01','6.02.01.01','1.02']"
)
F1 = f"""f1 AS (
  SELECT *, CASE form WHEN 'dfp' THEN 'DFP' ELSE 'ITR' END AS ORIGIN_FILE,
    'bronze/raw/' || form || '_cia_aberta_' || stmt || '_' || agg || '_' || file_year || '.csv' AS source_path,
    CASE stmt WHEN 'BPA' THEN 'BALANCO_PATRIMONIAL_ATIVO' WHEN 'BPP' THEN 'BALANCO_PATRIMONIAL_PASSIVO'
      WHEN 'DFC_MI' THEN 'FLUXO_DE_CAIXA_INDIRETO' ELSE 'DRE' END AS enr_origin_document_type,
    CASE agg WHEN 'con' THEN 'Consolidado' ELSE 'Individual' END AS enr_aggregation_type,
    CAST(VL_CONTA AS DECIMAL(14,2)) * CAST(CASE ESCALA_MOEDA WHEN 'UNIDADE' THEN 1 WHEN 'MIL' THEN 1000
      WHEN 'MILHOES' THEN 1000000 END AS DECIMAL(8,0)) AS adj
  FROM (
    SELECT *, CASE left(CD_CONTA, 1) WHEN '1' THEN 'BPA' WHEN '2' THEN 'BPP' WHEN '3' THEN 'DRE' ELSE 'DFC_MI' END AS stmt,
      CAST(year(DT_REFER) AS INTEGER) AS file_year, CASE WHEN month(DT_REFER) = 12 THEN 'dfp' ELSE 'itr' END AS form
    FROM (
      SELECT {cnpj('l_orderkey')} AS CNPJ_CIA,
        CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS DT_REFER,
        CASE WHEN l_linestatus = 'F' THEN 'ÚLTIMO' ELSE 'PENÚLTIMO' END AS ORDEM_EXERC,
        ['UNIDADE','MIL','MILHOES','DESCONHECIDA'][l_linenumber % 4 + 1] AS ESCALA_MOEDA,
        {CODES}[l_partkey % 14 + 1] AS CD_CONTA,
        l_returnflag AS DS_CONTA,
        CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS VL_CONTA,
        CASE WHEN l_suppkey % 2 = 0 THEN 'con' ELSE 'ind' END AS agg
      FROM lineitem)))"""

F2 = f"""f2 AS (
  SELECT event_id, CAST(ts AS DATE) AS event_d,
    CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) AS settle_d,
    CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) END AS pay_d,
    {cnpj('user_id')} AS issuer, {asset('user_id', 200)} AS asset_code,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'Juros' ELSE 'Amortizacao' END AS event, event_type,
    CASE WHEN event_id % 11 = 0 THEN '-' WHEN event_id % 13 = 0 THEN 'nan' WHEN event_id % 17 = 0 THEN ''
      ELSE {br('CAST(round(value * 100) AS BIGINT)')} END AS rate_text,
    CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE value END AS rate
  FROM events)"""

F3 = f"""f3 AS (
  SELECT CAST(l_shipdate AS DATE) AS d, {cnpj('l_partkey')} AS issuer, {asset('l_partkey', 200)} AS asset_code,
    'BR' || l_partkey AS ISIN, CAST(l_quantity AS BIGINT) AS qty, CAST(l_linenumber AS BIGINT) AS amt_of_trades,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_partkey
  FROM lineitem)"""
PRICES = """(cents * 9 // 10) / 100.0::DOUBLE AS min_unit_price, cents / 100.0::DOUBLE AS avg_unit_price,
  (cents * 11 // 10) / 100.0::DOUBLE AS max_unit_price"""

F4 = f"""f4 AS (SELECT {asset('p_partkey', 250)} AS asset_code, {cnpj('p_partkey')} AS issuer, max(p_type) AS situation
  FROM part GROUP BY 1, 2)"""

MACRO_LABELS = "['TAXAS DE CÂMBIO','TAXAS DE JUROS INTERNACIONAL','TAXAS DE JUROS NACIONAL']"
F6 = f"""f6 AS (SELECT 'S' || p_partkey AS security_id, p_name AS description,
  {MACRO_LABELS}[p_partkey % 3 + 1] AS group_label,
  CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE 0 END AS value,
  CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE CAST(p_size AS DOUBLE) END AS rate, '2025-10-19' AS last_update FROM part)"""
MACRO_TYPE = """CASE group_label WHEN 'TAXAS DE CÂMBIO' THEN 'FX' WHEN 'TAXAS DE JUROS INTERNACIONAL'
  THEN 'INTERNATIONAL_RATES' WHEN 'TAXAS DE JUROS NACIONAL' THEN 'DOMESTIC_RATES' END"""

CATS = "['Fato Relevante','Comunicado ao Mercado','Escrituras e aditamentos de debêntures','Calendário','Ata']"
TYPES = "['FATO_RELEVANTE','COMUNICADOS_AO_MERCADO','ESCRITURAS_E_ADITAMENTO_DE_DEBENTURES','OUTROS','OUTROS']"
F7 = f"""f7 AS (SELECT doc_id, text, source, 'gold/documents/' || source || '/doc_' || doc_id || '.pdf' AS object_path,
  'gold/documents/' || source AS folder, sha256(text) AS file_hash, {cnpj('doc_id')} AS issuer_cnpj,
  {CATS}[doc_id % 5 + 1] AS category, {TYPES}[doc_id % 5 + 1] AS document_type,
  CAST(1 + doc_id % 3 AS VARCHAR) AS version,
  strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') AS ref_date,
  strftime(DATE '2024-01-01' + CAST(doc_id * 7 % 366 AS INTEGER), '%Y-%m-%d') AS receipt_date,
  CAST(2022 + doc_id % 4 AS INTEGER) AS file_year, CASE WHEN doc_id % 2 = 0 THEN 'ITR' ELSE 'DFP' END AS form,
  CASE doc_id % 4 WHEN 0 THEN 'Consolidado' WHEN 1 THEN 'Individual' END AS aggregation_type,
  'https://filings.example.org/' || doc_id AS url FROM documents)"""

F8 = f"""f8 AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '-56.2024.8.26.0100' AS case_id,
  {cnpj('o_custkey')} AS issuer_cnpj, ['high','high','medium','medium','low'][CAST(left(o_orderpriority, 1) AS INTEGER)] AS level,
  CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount, o_orderkey, o_orderstatus, o_orderdate FROM orders)"""

F14 = f"""f14 AS (SELECT {cnpj('c_custkey')} AS issuer_cnpj, arg_min(c_name, c_custkey) AS issuer_name,
  arg_min(c_mktsegment, c_custkey) AS industry FROM customer GROUP BY 1)"""

F15 = f"""f15 AS (SELECT event_id AS request_id,
  CASE WHEN event_id % 4 IN (0, 3) AND event_id % 7 <> 0 THEN {asset('event_id', 300)} END AS ticker,
  CASE WHEN event_id % 4 = 1 THEN {cnpj('user_id')} END AS issuer_cnpj,
  CASE WHEN event_id % 4 IN (2, 3) THEN 'Customer#' || lpad(CAST(user_id % 60 AS VARCHAR), 9, '0') END AS issuer_name
  FROM events)"""

F16 = f"""f16 AS (SELECT {asset('p_partkey', 250)} AS asset_code, p_partkey, p_brand AS series, p_type AS indexer, p_name, p_size,
  CASE WHEN (p_partkey % 250) % 4 = 0 OR (p_partkey % 4 = 1 AND p_size % 2 = 0) THEN NULL
    ELSE (p_size // 10) || CASE WHEN p_partkey % 3 = 0 THEN '.' ELSE ',' END || (p_size % 10) END AS coupon,
  CAST(p_size + 100 AS VARCHAR) AS coupon_alt,
  concat_ws('; ', CASE p_partkey % 3 WHEN 0 THEN 'Resgate Antecipado: S' WHEN 1 THEN 'Resgate Antecipado: N' END,
    CASE WHEN p_partkey % 5 <> 0 THEN 'Escritura Padronizada: N' END, 'Classe: ' || left(p_type, 3)) AS covenants
  FROM part)"""
COUPON = """CASE WHEN count(coupon) OVER (PARTITION BY asset_code) = 0 THEN coupon_alt ELSE coupon END"""

# Whitespace as the cleaning functions define it.
WSC = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def collapsed(t: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({t}, ''), '^{WSC}+|{WSC}+$', '', 'g'), '{WSC}+', ' ', 'g')"


def words(t: str) -> str:
    return f"CASE WHEN {collapsed(t)} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({collapsed(t)}, ' ') END"


ORACLES: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLES[name] = sql


# --- scans and parsers ---------------------------------------------------------------------------

ISO = "strftime(DT_REFER, '%Y-%m-%d')"
add("scan_statements", with_(F1) + f"""SELECT CNPJ_CIA, {ISO} AS DT_REFER, 1 AS VERSAO, {ISO} AS DT_FIM_EXERC, ORDEM_EXERC,
  ESCALA_MOEDA, CD_CONTA, DS_CONTA, VL_CONTA, stmt AS statement_code, enr_aggregation_type, file_year, ORIGIN_FILE FROM f1""")
add("scan_preamble_tsv", with_(F2) + f"""SELECT
  CAST(row_number() OVER (PARTITION BY event_id // 2000 ORDER BY event_id) - 1 AS INTEGER) AS line_no,
  {dmy('event_d')} AS event_date, CASE WHEN pay_d IS NULL THEN '31/02/2024' ELSE {dmy('pay_d')} END AS payment_date, issuer,
  asset_code, CASE event WHEN 'Juros' THEN ' Juros ' ELSE event END AS event, event_type || event_type AS yield_type,
  CASE WHEN rate_text NOT IN ('', 'nan') THEN rate_text END AS rate_or_percent, {dmy('settle_d')} AS settlement_date FROM f2""")
add("scan_quoted_tsv", with_(F2) + f"""SELECT
  CAST(row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1 AS INTEGER) AS line_no,
  {dmy('event_d')} AS event_date, CASE WHEN pay_d IS NULL THEN '31/02/2024' ELSE {dmy('pay_d')} END AS payment_date,
  CASE WHEN event_id % 19 = 0 AND (event_id // 500) % 3 > 0 THEN issuer || chr(10) || '"matriz" / SP' ELSE issuer END AS issuer,
  asset_code, CASE event WHEN 'Juros' THEN ' Juros ' ELSE event END AS event, event_type || event_type AS yield_type,
  CASE WHEN rate_text NOT IN ('', 'nan') THEN rate_text END AS rate_or_percent, {dmy('settle_d')} AS settlement_date FROM f2""")
add("select_statement_files", with_(F1) + """SELECT stmt AS statement_code, enr_origin_document_type, enr_aggregation_type,
  file_year, count(*) AS n_rows FROM f1 GROUP BY ALL""")
add("tag_origin_file", with_(F1) + "SELECT source_path, ORIGIN_FILE, count(*) AS n_rows FROM f1 GROUP BY ALL")
add("parse_macro_feed", with_(F6) + "SELECT * FROM f6")
add("macro_gold", with_(F6) + f"""SELECT security_id, description, {MACRO_TYPE} AS data_type, greatest(value, rate) AS value,
  CAST(last_update AS DATE) AS ref_date FROM f6""")
add("parse_rad_results", f"""SELECT CAST(o_custkey % 50 AS VARCHAR) AS company_code, 'Company ' || o_custkey % 50 AS company_name,
  o_orderpriority AS category, CASE WHEN o_orderkey % 2 = 0 THEN 'PDF' ELSE 'XML' END AS document_type,
  'Doc ' || o_orderkey AS title, {dmy('o_orderdate')} AS reference_date,
  CASE WHEN o_orderkey % 7 <> 0 THEN {dmy('o_orderdate + INTERVAL 3 DAY')} END AS delivery_date, o_orderstatus AS status,
  CAST(o_orderkey + 100000 AS VARCHAR) AS protocol_id, CAST(o_orderkey AS VARCHAR) AS download_id,
  CAST(NULL AS VARCHAR) AS publication_info FROM orders""")
add("extract_listing_rows", f"""SELECT p_partkey // 40 AS page_id, {asset('p_partkey', 250)} AS asset_code,
  {cnpj('p_partkey')} || ' & CIA ÇÕES' AS issuer, p_type AS situation FROM part""")
add("extract_page_links", r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '<li[^>]*>\s*(<a [^>]*>[^<]*</a>)\s*</li>', 1) AS items FROM pages),
  b AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS i FROM a)
SELECT page_id, CAST(i - 1 AS INTEGER) AS position, regexp_extract(item, 'href="([^"]*)"', 1) AS href,
  trim(replace(replace(regexp_extract(item, '>([^<]*)<', 1), '&lt;', '<'), '&amp;', '&')) AS label FROM b""")
add("extract_update_stamp", """SELECT event_id, CASE WHEN event_id % 7 <> 0
  THEN strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') END AS last_update FROM events""")
add("extract_embedded_pdfs", """SELECT doc_id, CAST(0 AS INTEGER) AS ordinal, 'SecText' AS tag, 'doc_' || doc_id || '.pdf' AS file_name,
  sha256(text) AS file_hash, CAST(octet_length(CAST(encode(text) AS BLOB)) AS INTEGER) AS n_bytes FROM documents
UNION ALL SELECT doc_id, 1, 'SecSource', 'src_' || doc_id || '.pdf', sha256(source),
  CAST(octet_length(CAST(encode(source) AS BLOB)) AS INTEGER) FROM documents
UNION ALL SELECT doc_id, 2, 'SecBare', NULL, sha256(lang),
  CAST(octet_length(CAST(encode(lang) AS BLOB)) AS INTEGER) FROM documents WHERE doc_id % 5 = 0""")
BLANK = "<ImagemObjetoArquivoPdf></ImagemObjetoArquivoPdf>"
add("strip_embedded_pdfs", f"""SELECT doc_id, '<Doc><Note>n' || doc_id || '</Note><SecText ref="http://x/y>z"><Id>1</Id><NomeArquivoPdf>doc_'
  || doc_id || '.pdf</NomeArquivoPdf><!-- <x> -->{BLANK}</SecText><SecSource>'
  || CASE WHEN doc_id % 3 = 0 THEN '{BLANK}<Date/><NomeArquivoPdf>src_' || doc_id || '.pdf</NomeArquivoPdf>'
    ELSE '<NomeArquivoPdf>src_' || doc_id || '.pdf</NomeArquivoPdf>{BLANK}' END || '</SecSource>'
  || CASE WHEN doc_id % 5 = 0 THEN '<SecBare>{BLANK}<ImagemObjetoArquivoPdf/></SecBare>' ELSE '' END || '</Doc>' AS xml FROM documents""")
add("decode_rad_payload", """SELECT doc_id, sha256(text) AS file_hash,
  CAST(octet_length(CAST(encode(text) AS BLOB)) AS INTEGER) AS n_bytes FROM documents""")
add("download_manifest", with_(F7) + """SELECT issuer_cnpj, document_type, url, version, ref_date,
  'gold/documents/CVM/' || document_type || '_' || version || '-' || replace(ref_date, '-', '') || '.pdf' AS target_path
  FROM f7 WHERE document_type <> 'OUTROS'""")
add("rad_manifest", """SELECT CAST(o_custkey % 50 AS VARCHAR) AS company_code, CAST(o_orderkey + 100000 AS VARCHAR) AS protocol_id,
  'DADOS_ECONOMICO_E_FINANCEIROS' AS document_type, CAST(o_orderdate AS DATE) AS ref_date,
  'gold/documents/CVM/DADOS_ECONOMICO_E_FINANCEIROS_Doc_' || o_orderkey || '-' || strftime(o_orderdate, '%Y-%m-%d') || '.pdf'
  AS target_path FROM orders""")

# --- cleaning ------------------------------------------------------------------------------------

add("br_number", with_(F3) + f"SELECT asset_code, {dmy('d')} AS ref_date, {PRICES} FROM f3")
add("br_number_bad", with_(F2) + "SELECT event_id, rate AS rate_or_percent FROM f2")
add("parse_dates_strict", with_(F7) + """SELECT doc_id, CAST(ref_date AS DATE) AS ref_date,
  CAST(receipt_date AS DATE) AS receipt_date FROM f7""")
add("parse_dates_lenient", with_(F2) + "SELECT event_id, event_d AS event_date, pay_d AS payment_date FROM f2")
add("numeric_lenient", with_(F16) + """SELECT p_partkey AS row_id, TRY_CAST(coupon AS DOUBLE) AS coupon,
  TRY_CAST(coupon_alt AS DOUBLE) AS coupon_alt FROM f16""")
add("null_tokens", with_(F2) + f"""SELECT event_id, {dmy('event_d')} AS event_date,
  CASE WHEN pay_d IS NULL THEN '31/02/2024' ELSE {dmy('pay_d')} END AS payment_date, issuer, asset_code, event,
  event_type || event_type AS yield_type, CASE WHEN rate IS NOT NULL THEN rate_text END AS rate_or_percent,
  {dmy('settle_d')} AS settlement_date FROM f2""")
add("snake_names", r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(
  translate(lower(' ' || p_brand || ' (' || p_name || ') / Código-' || p_type || '!?  Ação '), 'áàãâéêíóôõúüç', 'aaaaeeiooouuc'),
  '[^a-z0-9_\s/()-]', '', 'g'), '[\s/()_-]+', '_', 'g'), '_') AS snake FROM part""")
add("conform_terms", with_(F16) + """SELECT asset_code, series,
  CASE WHEN p_partkey % 9 = 0 THEN '31/02/2024' ELSE '17/04/2029' END AS maturity,
  CASE WHEN p_size % 5 = 0 THEN ' - ' ELSE indexer END AS indexer, coupon, coupon_alt, covenants,
  p_partkey AS enr_codigo_interno, p_name AS enr_ato_societario_1 FROM f16""")
add("coupon_fallback", with_(F16) + f"SELECT asset_code, p_partkey AS enr_codigo_interno, {COUPON} AS coupon FROM f16")
add("terms_gold", with_(F16) + f"""SELECT asset_code, series,
  CASE WHEN p_partkey % 9 <> 0 THEN DATE '2029-04-17' END AS maturity,
  CASE WHEN p_size % 5 <> 0 THEN indexer END AS indexer, CAST(replace({COUPON}, ',', '.') AS DOUBLE) AS coupon, covenants,
  p_partkey AS enr_codigo_interno, p_name AS enr_ato_societario_1 FROM f16""")
add("covenants_text", with_(F16) + "SELECT p_partkey AS row_id, covenants FROM f16")
add("halve_doubled", "SELECT event_id, event_type AS yield_type FROM events")
add("scale_amounts", with_(F1) + """SELECT source_path, CD_CONTA, ESCALA_MOEDA, CAST(adj AS DOUBLE) AS amount FROM f1""")
add("map_labels_strict", with_(F6) + f"SELECT security_id, {MACRO_TYPE} AS data_type FROM f6")
add("pick_filled", with_(F6) + "SELECT security_id, CASE WHEN value > rate THEN value ELSE rate END AS value FROM f6")
ACCOUNT_TYPE = """CASE stmt WHEN 'BPA' THEN 'ATIVO' WHEN 'BPP' THEN 'PASSIVO' END"""
add("enrich_statement", with_(F1) + f"""SELECT enr_origin_document_type, '2025-10-06T08:01:00' AS enr_last_updated_date,
  'trace-0001' AS enr_ingestion_trace_id, 'CVM' AS enr_source, 'Q' || quarter(DT_REFER) AS enr_quarter, file_year AS enr_year,
  {ACCOUNT_TYPE} AS enr_account_type, enr_aggregation_type, count(*) AS n_rows FROM f1 GROUP BY ALL""")
add("cnpj_digits", with_(F7) + """SELECT doc_id, regexp_replace(issuer_cnpj, '[./-]', '', 'g') AS digits, issuer_cnpj AS formatted,
  replace(ref_date, '-', '') AS ref_date_digits FROM f7""")
EVENTS_GOLD = """SELECT event_d AS event_date, pay_d AS payment_date, issuer, asset_code, event, event_type AS yield_type,
  rate AS rate_or_percent, settle_d AS settlement_date FROM f2"""
add("conform_schema", with_(F2) + EVENTS_GOLD)
add("object_path", with_(F7) + """SELECT doc_id, 'gold/documents/' || source || '/' || concat_ws('_', document_type,
  aggregation_type, version, replace(category, ' ', '_')) || '-' || ref_date || '.pdf' AS path FROM f7""")
add("collapse_ws", f"SELECT doc_id, {collapsed('text')} AS text FROM documents")

# --- filters and checks --------------------------------------------------------------------------

add("filter_issuer", with_(F1, F14) + """SELECT CNPJ_CIA, count(*) AS n_rows FROM f1 WHERE CNPJ_CIA IN
  (SELECT issuer_cnpj FROM f14 WHERE industry IN ('HOUSEHOLD', 'MACHINERY')) GROUP BY 1""")
add("filter_issuer_rows", with_(F1, F14) + """SELECT CNPJ_CIA, DT_REFER, CD_CONTA, VL_CONTA, source_path FROM f1 WHERE CNPJ_CIA IN
  (SELECT issuer_cnpj FROM f14 WHERE industry IN ('HOUSEHOLD', 'MACHINERY'))""")
add("filter_last_exercise", with_(F1) + """SELECT ORDEM_EXERC, CD_CONTA, count(*) AS n_rows FROM f1
  WHERE ORDEM_EXERC = 'ÚLTIMO' GROUP BY ALL""")
add("filter_categories", with_(F7) + "SELECT doc_id, category, document_type FROM f7 WHERE document_type <> 'OUTROS'")
add("filter_years", with_(F7) + """SELECT doc_id, file_year, form FROM f7 WHERE file_year IN (2023, 2024, 2025)
  AND NOT (file_year = 2025 AND form = 'DFP')""")
add("quality_report", with_(F1, F2, F6) + f"""SELECT 'statements' AS dataset, check_name, (SELECT count(*) FROM f1) AS n_rows, n_violations FROM (
  SELECT 'issuer_missing' AS check_name, count(*) FILTER (CNPJ_CIA IS NULL) AS n_violations FROM f1
  UNION ALL SELECT 'unmapped_scale', count(*) FILTER (ESCALA_MOEDA = 'DESCONHECIDA') FROM f1
  UNION ALL SELECT 'date_missing', count(*) FILTER (DT_REFER IS NULL) FROM f1
  UNION ALL SELECT 'not_last_exercise', count(*) FILTER (ORDEM_EXERC = 'PENÚLTIMO') FROM f1)
UNION ALL SELECT 'events', check_name, (SELECT count(*) FROM f2), n_violations FROM (
  SELECT 'payment_date_missing' AS check_name, count(*) FILTER (pay_d IS NULL) AS n_violations FROM f2
  UNION ALL SELECT 'rate_missing', count(*) FILTER (rate IS NULL) FROM f2)
UNION ALL SELECT 'macro', 'unmapped_label', count(*), count(*) FILTER ({MACRO_TYPE} IS NULL) FROM f6
UNION ALL SELECT 'replies', check_name, n, v FROM (
  SELECT unnest(['header_differs', 'not_found', 'one_row']) AS check_name, count(*) AS n,
    unnest([count(*) FILTER (r % 7 = 0), count(*) FILTER (r % 5 = 0), count(*) FILTER (r % 5 = 0 OR r % 11 = 0 OR c = 1)]) AS v
  FROM (SELECT event_id // 100 AS r, count(*) AS c FROM events GROUP BY 1))
UNION ALL SELECT 'filings', check_name, n, v FROM (
  SELECT unnest(['protocol_id_missing', 'reference_date_missing', 'delivery_date_missing']) AS check_name, count(*) AS n,
    unnest([0, 0, count(*) FILTER (o_orderkey % 7 = 0)]) AS v FROM orders)""")
add("missing_categories", with_(F7) + f"""SELECT issuer_cnpj, CASE WHEN count(*) OVER (PARTITION BY issuer_cnpj) = 3 THEN 'error'
  ELSE 'warning' END AS severity, category FROM (
  (SELECT DISTINCT issuer_cnpj, c.category FROM f7, (SELECT unnest({CATS}[1:3]) AS category) c)
  EXCEPT SELECT issuer_cnpj, category FROM f7)""")
add("uncovered_assets", with_(F3, F4) + "SELECT * FROM f4 WHERE asset_code NOT IN (SELECT asset_code FROM f3)")

# --- statements ----------------------------------------------------------------------------------

add("union_itr_dfp", with_(F1) + "SELECT stmt, ORIGIN_FILE, count(*) AS n_rows FROM f1 GROUP BY ALL")
add("union_ragged", with_(F1) + f"""SELECT enr_origin_document_type, {ACCOUNT_TYPE} AS enr_account_type, count(*) AS n_rows
  FROM f1 GROUP BY ALL""")
add("union_rows", with_(F1) + """SELECT CNPJ_CIA, DT_REFER, CD_CONTA, VL_CONTA, ORIGIN_FILE, NULL::VARCHAR AS ESCALA_MOEDA FROM f1
  UNION ALL SELECT CNPJ_CIA, NULL, NULL, VL_CONTA, NULL, ESCALA_MOEDA FROM f1 WHERE stmt = 'DRE'""")
add("split_by_aggregation", with_(F1) + """SELECT enr_aggregation_type, file_year AS enr_year, count(*) AS n_rows,
  CAST(sum(adj) AS DOUBLE) AS total FROM f1 GROUP BY ALL""")


def sums(source: str) -> str:
    exact = {"revenue": "3.01", "ebit": "3.05", "depreciation": "3.04.04", "cash": "1.01.01", "interest_is": "3.06.02"}
    prefix = {
        "debt_short_term": "2.01.04", "debt_long_term": "2.02.01", "interest_cf": "6.01.02.02", "capex_raw": "6.02.01",
        "wc_change": "6.01.02",
    }
    cols = [f"coalesce(sum(adj) FILTER (CD_CONTA = '{c}'), 0) AS {n}" for n, c in exact.items()]
    cols += [f"coalesce(sum(adj) FILTER (CD_CONTA LIKE '{c}%'), 0) AS {n}" for n, c in prefix.items()]
    return f"""a1 AS (SELECT enr_aggregation_type, CNPJ_CIA, DT_REFER, {', '.join(cols)} FROM {source}
  WHERE ORDEM_EXERC = 'ÚLTIMO' GROUP BY 1, 2, 3)"""


SUM_NAMES = [
    "revenue", "ebit", "depreciation", "cash", "interest_is", "debt_short_term", "debt_long_term", "interest_cf", "capex_raw",
    "wc_change",
]
AS_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SUM_NAMES)
LEAF = """leaf AS (SELECT * FROM f1 x WHERE ORDEM_EXERC = 'ÚLTIMO' AND NOT EXISTS (SELECT 1 FROM kids k WHERE
  k.enr_aggregation_type = x.enr_aggregation_type AND k.CNPJ_CIA = x.CNPJ_CIA AND k.DT_REFER = x.DT_REFER
  AND k.parent = x.CD_CONTA))"""
KIDS = r"""kids AS (SELECT DISTINCT enr_aggregation_type, CNPJ_CIA, DT_REFER, regexp_replace(CD_CONTA, '\.[^.]+$', '') AS parent
  FROM f1 WHERE ORDEM_EXERC = 'ÚLTIMO')"""
FINANCIALS = """SELECT enr_aggregation_type, CNPJ_CIA AS issuer_cnpj, DT_REFER AS date, 'Q' || quarter(DT_REFER) AS quarter,
  CAST(year(DT_REFER) AS INTEGER) AS year, CAST(revenue AS DOUBLE) AS revenue, CAST(ebit + depreciation AS DOUBLE) AS ebitda,
  CAST(ebit AS DOUBLE) AS ebit, CAST(depreciation AS DOUBLE) AS depreciation,
  CAST(debt_short_term + debt_long_term - cash AS DOUBLE) AS net_debt,
  CAST(debt_short_term + debt_long_term AS DOUBLE) AS total_debt, CAST(debt_short_term AS DOUBLE) AS debt_short_term,
  CAST(debt_long_term AS DOUBLE) AS debt_long_term, CAST(cash AS DOUBLE) AS cash,
  CAST(abs(CASE WHEN interest_cf <> 0 THEN interest_cf ELSE interest_is END) AS DOUBLE) AS interest_paid,
  CAST(abs(capex_raw) AS DOUBLE) AS capex, CAST(wc_change AS DOUBLE) AS wc_change FROM a1"""
add("account_sums", with_(F1, sums("f1")) + f"SELECT enr_aggregation_type, CNPJ_CIA, DT_REFER, {AS_DOUBLES} FROM a1")
add("account_sums_leaf_only", with_(F1, KIDS, LEAF, sums("leaf")) +
    f"SELECT enr_aggregation_type, CNPJ_CIA, DT_REFER, {AS_DOUBLES} FROM a1")
for key in ("financials_quarterly", "write_gold", "export_sheets", "stream_gold_refresh", "incremental_financials"):
    add(key, with_(F1, sums("f1")) + FINANCIALS)
add("dataset_ref_date", with_(F1) + "SELECT enr_aggregation_type, strftime(max(DT_REFER), '%Y-%m-%d') AS ref_date FROM f1 GROUP BY 1")

# --- debentures ----------------------------------------------------------------------------------

PLACE = """CAST(row_number() OVER (PARTITION BY issuer ORDER BY payment_date NULLS LAST, asset_code, event, event_date, yield_type,
  rate_or_percent NULLS LAST, settlement_date) AS INTEGER)"""
add("events_schedule", with_(F2) + f"SELECT *, {PLACE} AS place FROM ({EVENTS_GOLD})")
add("traded_prices", with_(F3) + f"""SELECT d AS ref_date, issuer, asset_code, ISIN, qty, amt_of_trades, {PRICES},
  (l_partkey % 20000) / 100.0::DOUBLE AS curve_price_percent FROM f3""")
T4 = """t4 AS (SELECT *, row_number() OVER (PARTITION BY issuer ORDER BY pay_d, asset_code, event, event_d, event_type,
  rate NULLS LAST, settle_d) AS rank FROM f2 WHERE pay_d >= DATE '2024-01-15' QUALIFY rank <= 10)"""
add("upcoming_payments", with_(F2, T4) + """SELECT event_d AS event_date, pay_d AS payment_date, issuer, asset_code, event,
  event_type AS yield_type, rate AS rate_or_percent, settle_d AS settlement_date, CAST(rank AS INTEGER) AS rank FROM t4""")
add("asset_price_coverage", with_(F3, F4) + """SELECT issuer, coalesce(n_listed, 0) AS n_listed, coalesce(n_priced, 0) AS n_priced,
  coalesce(n_listed, 0) <> coalesce(n_priced, 0) AS count_differs
  FROM (SELECT issuer, count(DISTINCT asset_code) AS n_listed FROM f4 GROUP BY 1)
  FULL JOIN (SELECT issuer, count(DISTINCT asset_code) AS n_priced FROM f3 GROUP BY 1) USING (issuer)""")

# --- catalog and issuers -------------------------------------------------------------------------

add("latest_filing", with_(F7) + """SELECT doc_id, issuer_cnpj, receipt_date, ref_date, url FROM f7
  QUALIFY row_number() OVER (PARTITION BY issuer_cnpj ORDER BY receipt_date DESC, doc_id) = 1""")
add("risk_exposure", with_(F8) + """SELECT issuer_cnpj, count(*) AS n_cases, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS exposure
  FROM f8 WHERE level <> 'low' GROUP BY 1""")
add("ingest_digest", with_(F7) + """SELECT *, CAST(sum(n_documents) OVER (PARTITION BY ref_date) AS BIGINT) AS day_documents,
  (SELECT string_agg(s, ', ' ORDER BY s) FROM (SELECT DISTINCT source AS s FROM f7 WHERE f7.ref_date = g.ref_date)) AS day_sources
  FROM (SELECT ref_date, document_type, source, count(*) AS n_documents, count(DISTINCT category) AS n_titles
    FROM f7 GROUP BY 1, 2, 3) g""")
add("digest_listing", with_(F7) + "SELECT ref_date, document_type, category AS title, object_path FROM f7")
T2 = """t2 AS (SELECT *, row_number() OVER (PARTITION BY issuer_cnpj ORDER BY ref_date DESC, doc_id) AS rank FROM f7
  QUALIFY rank <= 5)"""
T3 = """t3 AS (SELECT *, row_number() OVER (PARTITION BY issuer_cnpj ORDER BY level, amount DESC NULLS LAST, case_id) AS rank
  FROM f8 WHERE level <> 'low' QUALIFY rank <= 10)"""
add("latest_documents", with_(F7, T2) + """SELECT doc_id, issuer_cnpj, ref_date, category AS title, CAST(rank AS INTEGER) AS rank FROM t2""")
add("key_legal_risks", with_(F8, T3) + """SELECT issuer_cnpj, CAST(rank AS INTEGER) AS rank, case_id, level AS risk_level,
  CAST(amount AS DOUBLE) AS claimed FROM t3""")
add("resolve_issuer", with_(F4, F14, F15) + """SELECT request_id, CASE WHEN r.ticker IS NULL AND r.issuer_cnpj IS NULL
    AND r.issuer_name IS NULL THEN 'INVALID_INPUT' WHEN c IS NULL THEN 'NOT_FOUND' ELSE 'OK' END AS status,
  coalesce(c, 'N/A') AS resolved_cnpj, coalesce(d.issuer_name, 'N/A') AS resolved_name,
  coalesce(d.industry, 'N/A') AS resolved_industry, CASE WHEN t IS NULL THEN 'N/A' ELSE r.ticker END AS resolved_ticker
  FROM (SELECT f15.*, f4.issuer AS t, coalesce(f4.issuer, a.issuer_cnpj, b.issuer_cnpj) AS c FROM f15
    LEFT JOIN f4 ON f15.ticker = f4.asset_code LEFT JOIN f14 a ON f15.issuer_cnpj = a.issuer_cnpj
    LEFT JOIN f14 b ON f15.issuer_name = b.issuer_name) r
  LEFT JOIN f14 d ON d.issuer_cnpj = r.c""")
PROFILE_DOC = """concat_ws('~', document_type, category, ref_date, source, CASE WHEN doc_id % 2 = 0 THEN url ELSE object_path END,
  CASE WHEN doc_id % 3 <> 0 THEN 'Resumo ' || doc_id ELSE '-' END)"""
PROFILE_CASE = """concat_ws('~', case_id, (1 + o_orderkey % 9) || 'a Vara', CASE WHEN o_orderkey % 3 = 0 THEN 'Ação de Indenização'
  ELSE 'Ação Trabalhista' END, level, coalesce(amount::VARCHAR, '-'), o_orderstatus,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'Fatos ' || o_orderkey ELSE '-' END, CASE WHEN o_orderkey % 5 <> 0 THEN 'Impacto ' || o_orderkey ELSE '-' END,
  strftime(o_orderdate, '%Y-%m-%d'))"""
PROFILE_PAY = """concat_ws('~', asset_code, event, strftime(pay_d, '%Y-%m-%d'), coalesce((rate::DECIMAL(18,2) * 10)::DECIMAL(18,2)::VARCHAR, '-'),
  coalesce(rate::DECIMAL(18,2)::VARCHAR, '-'), CASE WHEN day(pay_d) % 2 = 0 THEN 'confirmed' ELSE 'scheduled' END)"""
add("issuer_profile", with_(F2, F4, F7, F8, F14, T2, T3, T4) + f"""SELECT i.issuer_cnpj, i.issuer_name, coalesce(f.ticker, 'N/A') AS ticker, i.industry,
  coalesce(d.n, 0) AS total_documents, coalesce(l.n, 0) AS total_legal_risks, coalesce(l.x, 0) AS total_risk_exposure,
  coalesce(p.n, 0) AS total_upcoming_payments, d.u AS latest_documents, l.u AS key_legal_risks, p.u AS upcoming_payments
  FROM f14 i
  LEFT JOIN (SELECT issuer_cnpj, count(*) AS n, string_agg({PROFILE_DOC}, ';' ORDER BY rank) AS u FROM t2 GROUP BY 1) d USING (issuer_cnpj)
  LEFT JOIN (SELECT issuer_cnpj, count(*) AS n, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS x,
    string_agg({PROFILE_CASE}, ';' ORDER BY rank) AS u FROM t3 GROUP BY 1) l USING (issuer_cnpj)
  LEFT JOIN (SELECT issuer AS issuer_cnpj, count(*) AS n, string_agg({PROFILE_PAY}, ';' ORDER BY rank) AS u FROM t4 GROUP BY 1) p USING (issuer_cnpj)
  LEFT JOIN (SELECT issuer AS issuer_cnpj, min(asset_code) AS ticker FROM f4 GROUP BY 1) f USING (issuer_cnpj)""")
add("attach_metadata", with_(F7, F14) + """SELECT doc_id, object_path, '{"empresa":"' || issuer_name || '","CNPJ":"' || issuer_cnpj
  || '","origem":"' || source || '","tipo_documento":"' || document_type || '","file_hash":"' || file_hash || '"'
  || coalesce(',"tipo_agregacao_demonstrativo_financeiro":"' || aggregation_type || '"', '') || '}' AS meta_fields
  FROM f7 JOIN f14 USING (issuer_cnpj)""")
add("freshness_gate", with_(F7) + """SELECT doc_id, document_type, file_year, ref_date AS last_update FROM f7 a WHERE NOT EXISTS
  (SELECT 1 FROM f7 b WHERE b.receipt_date < '2024-07-01' AND b.document_type = a.document_type AND b.file_year = a.file_year
   AND b.ref_date = a.ref_date)""")
add("dedup_content", with_(F7) + """SELECT min(doc_id) AS doc_id, folder, file_hash, arg_min(object_path, doc_id) AS object_path
  FROM f7 WHERE receipt_date >= '2024-07-01' AND (folder, file_hash) NOT IN
  (SELECT (folder, file_hash) FROM f7 WHERE receipt_date < '2024-07-01') GROUP BY folder, file_hash""")
CATALOG = """object_path, folder, file_hash, '2025-10-19T12:00:00' AS ingest_ts, 'trace-0001' AS trace_id, source, document_type,
  ref_date, coalesce(aggregation_type, '') AS aggregation_type"""
add("catalog_rows", with_(F7) + f"SELECT {CATALOG} FROM f7")
add("find_documents", with_(F7) + """SELECT object_path, CASE WHEN receipt_date < '2024-07-01' THEN file_hash END AS file_hash
  FROM f7 WHERE object_path LIKE '%src1/%'""")
add("serving_json", with_(F6) + f"""SELECT 'macro_data:' || security_id AS cache_key, security_id, {MACRO_TYPE} AS data_type,
  greatest(value, rate) AS value, CAST(last_update AS DATE) AS quote_date, 'gold/serving/macro_data.parquet' AS file_bucket_path,
  '2025-10-19' AS ref_date, 'trace-0001' AS trace_id FROM f6""")

# --- chunks --------------------------------------------------------------------------------------

LINES = r"string_split(text, chr(10))"
SENTENCES = r"string_split(regexp_replace(text, '([.!?])[\s\x0B]+', '\1' || chr(1), 'g'), chr(1))"


def packed(pieces: str, limit: int) -> str:
    """Greedy packing, one piece per recursion step, all documents at once."""
    return f"""RECURSIVE p0 AS (SELECT doc_id, unnest({pieces}) AS piece, generate_subscripts({pieces}, 1) AS i FROM documents),
p AS MATERIALIZED (SELECT doc_id, i, piece, CAST(len({words('piece')}) AS INTEGER) AS n FROM p0),
walk AS (
  SELECT doc_id, i, CASE WHEN n > 0 THEN 0 ELSE -1 END AS chunk_no, n AS used FROM p WHERE i = 1
  UNION ALL
  SELECT p.doc_id, p.i,
    CASE WHEN p.n > 0 AND (w.chunk_no < 0 OR w.used + p.n > {limit}) THEN w.chunk_no + 1 ELSE w.chunk_no END,
    CASE WHEN p.n > 0 AND (w.chunk_no < 0 OR w.used + p.n > {limit}) THEN p.n ELSE w.used + p.n END
  FROM walk w JOIN p ON p.doc_id = w.doc_id AND p.i = w.i + 1)"""


def packed_rows(pieces: str, limit: int, sep: str) -> str:
    return f"""WITH {packed(pieces, limit)}
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, string_agg(piece, {sep} ORDER BY i) AS text,
  CAST(sum(n) AS INTEGER) AS tokens FROM walk JOIN p USING (doc_id, i) WHERE chunk_no >= 0 GROUP BY 1, 2"""


add("chunk_naive", packed_rows(LINES, 512, "chr(10)"))
add("chunk_sentences", packed_rows(SENTENCES, 128, "' '"))
WINDOWS = f"""w AS (SELECT *, {words('text')} AS w FROM documents),
v AS (SELECT w.* EXCLUDE (w, text), CAST(unnest(range(0, greatest(1, CAST(ceil((len(w) - 128) / 384) AS BIGINT)))) AS INTEGER) AS chunk_no, w AS ws
  FROM w WHERE len(w) > 0),
chunks AS (SELECT doc_id, source, lang, chunk_no, array_to_string(ws[chunk_no * 384 + 1 : chunk_no * 384 + 512], ' ') AS text,
  CAST(len(ws[chunk_no * 384 + 1 : chunk_no * 384 + 512]) AS INTEGER) AS tokens FROM v)"""
add("chunk_overlap", with_(WINDOWS) + "SELECT doc_id, chunk_no, text, tokens FROM chunks")
add("chunk_rows", with_(WINDOWS, F7) + """SELECT f7.object_path AS doc_id, f7.object_path || '#chunk_' || chunk_no AS chunk_id, c.text,
  CASE WHEN doc_id % 4 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS confidence, CASE WHEN doc_id % 4 = 0 THEN 'ocr' ELSE 'text' END AS read_method,
  CAST(chunk_no // 2 + 1 AS INTEGER) AS page_start, CAST((chunk_no + 1) // 2 + 1 AS INTEGER) AS page_end,
  tokens::DOUBLE AS embedding_0, chunk_no::DOUBLE AS embedding_1,
  left(c.text, 512) AS text_raw, tokens, '2025-10-19T12:00:00' AS ingestion_ts, f7.source, file_hash, 'trace-0001' AS trace_id,
  document_type, ref_date, coalesce(aggregation_type, '') AS aggregation_type FROM chunks c JOIN f7 USING (doc_id)""")
add("l2_normalize", """WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (label + 2)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM s)
SELECT vec_id, CAST(unnest(range(0, len(v))) AS INTEGER) AS pos, round(unnest(v) / norm, 5) AS x FROM n""")
add("check_dimension", "SELECT vec_id, CAST(len(embedding) - 1 AS INTEGER) AS dimension FROM embeddings WHERE label < 2")
add("index_completeness", with_(WINDOWS) + """SELECT doc_id, count(*) AS n_chunks,
  count(*) FILTER (lang = 'en' OR (lang = 'fr' AND chunk_no > 0)) AS n_stored, lang = 'en' AS skip FROM chunks GROUP BY doc_id, lang""")
add("upsert_chunks", f"""WITH {packed(LINES, 512)}, {WINDOWS},
naive AS (SELECT doc_id, chunk_no, string_agg(piece, chr(10) ORDER BY i) AS text, CAST(sum(n) AS INTEGER) AS tokens
  FROM walk JOIN p USING (doc_id, i) WHERE chunk_no >= 0 GROUP BY 1, 2)
SELECT doc_id || '#chunk_' || chunk_no AS chunk_id, doc_id, text, tokens, 2 AS version FROM chunks
UNION ALL SELECT doc_id || '#chunk_' || chunk_no, doc_id, text, tokens, 1 FROM naive
  WHERE (doc_id, chunk_no) NOT IN (SELECT (doc_id, chunk_no) FROM chunks)""")
add("extract_doc_metadata", r"""SELECT doc_id,
  array_to_string(regexp_extract_all(text, '\b(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})\b'), '|') AS dates,
  array_to_string(regexp_extract_all(text, '\d+(?:[.,]\d+)*'), '|') AS numbers,
  array_to_string(regexp_extract_all(text, 'R\$|US\$|€|£|\b(?:BRL|USD|EUR|GBP)\b'), '|') AS currencies,
  array_to_string(regexp_extract_all(text, '\b(?:Q[1-4]|[1-4]T|FY) ?\d{4}\b'), '|') AS fiscal_periods FROM documents""")

# --- search --------------------------------------------------------------------------------------

QT = r"""qt AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark)"""
UNITS = """u AS (SELECT vec_id, label, list_transform(e, lambda x: x / norm) AS v FROM (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings))),
qm AS (SELECT item_id, list_transform(range(1, len(a.embedding) + 1), lambda i: CAST(a.embedding[i] AS DOUBLE) + CAST(0.8 AS DOUBLE) * CAST(c.embedding[i] AS DOUBLE)) AS e
  FROM benchmark JOIN embeddings a ON a.vec_id = (item_id * 7 + 13) % 97 JOIN embeddings c ON c.vec_id = (item_id * 11 + 129) % 193),
qu AS (SELECT item_id AS vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS v FROM qm)"""


def knn(k: int, where: str = "TRUE", name: str = "v6") -> str:
    return f"""{name} AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_dot_product(q.v, d.v), 6) AS score,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.v, d.v), 6) DESC, d.vec_id) AS rank
  FROM qu q CROSS JOIN u d WHERE {where} QUALIFY rank <= {k})"""


TOK = r"""tok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents),
st AS (SELECT count(*) AS n, avg(len(t)) AS a FROM tok),
tf AS MATERIALIZED (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM tok)
  WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""


def bm25(k: int) -> str:
    return f"""v7 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
  SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))), 6) AS score
  FROM qt JOIN tf USING (term) JOIN df USING (term) CROSS JOIN st GROUP BY 1, 2) QUALIFY rank <= {k})"""


RANKED = "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM"
add("knn_cosine", with_(UNITS, knn(20)) + f"{RANKED} v6")
add("knn_cosine_filtered", with_(UNITS, knn(5, "d.label = 3")) + f"{RANKED} v6")
add("bm25_topk", with_(QT, TOK, bm25(20)) + f"{RANKED} v7")
FUSED = f"""fused AS (SELECT query_id, c.doc_id, coalesce(cosine, 0) AS cosine,
  coalesce(keyword, 0) * CASE WHEN contains({collapsed('lower(d.text)')}, {collapsed('lower(b.text)')}) THEN 1.5 ELSE 1 END AS keyword,
  vr, kr
  FROM (SELECT query_id, doc_id, score AS cosine, rank AS vr FROM v6) v
  FULL JOIN (SELECT query_id, doc_id, score / max(score) OVER (PARTITION BY query_id) AS keyword, rank AS kr FROM v7) c
    USING (query_id, doc_id)
  JOIN benchmark b ON b.item_id = query_id LEFT JOIN documents d ON d.doc_id = coalesce(v.doc_id, c.doc_id))""".replace(
    "SELECT query_id, c.doc_id,", "SELECT query_id, coalesce(v.doc_id, c.doc_id) AS doc_id,"
)
add("hybrid_search", with_(QT, TOK, UNITS, knn(20), bm25(20), FUSED) + f"""{RANKED} (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT query_id, doc_id, round(CAST(0.7 AS DOUBLE) * cosine + CAST(0.3 AS DOUBLE) * keyword, 6) AS score FROM fused)
  WHERE score >= 0.3 QUALIFY rank <= 5)""")
add("agent_profiles", with_(QT, TOK, UNITS, knn(20), bm25(20), FUSED,
    """prof(i, profile, top, rerank, threshold, wv, wk) AS (VALUES
  (0, 'estruturacao', 20, 7, CAST(0.3 AS DOUBLE), CAST(0.65 AS DOUBLE), CAST(0.35 AS DOUBLE)),
  (1, 'monitor', 15, 5, 0.35, 0.60, 0.40), (2, 'geral', 20, 5, 0.25, 0.70, 0.30))""") +
    """SELECT query_id, profile, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT query_id, profile, doc_id, rerank, threshold,
      round(wv * CASE WHEN vr <= top THEN cosine ELSE 0 END + wk * CASE WHEN kr <= top THEN keyword ELSE 0 END, 6) AS score
    FROM fused JOIN prof ON prof.i = query_id % 3 WHERE vr <= top OR kr <= top)
  WHERE score >= threshold QUALIFY rank <= rerank)""")
add("expand_query", with_(QT, r"""bt AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM benchmark),
syn AS (SELECT DISTINCT t[i] AS term, t[i + 1] AS synonym FROM (SELECT t, unnest(range(1, len(t))) AS i FROM bt))""") +
    """SELECT query_id, term, bool_or(o) AS is_original FROM (
  SELECT query_id, term, TRUE AS o FROM qt UNION ALL SELECT query_id, synonym, FALSE FROM qt JOIN syn USING (term)) GROUP BY 1, 2""")

# --- streams -------------------------------------------------------------------------------------

add("stream_ingest", with_(F7) + """SELECT min(doc_id) AS doc_id, folder, file_hash, arg_min(object_path, doc_id) AS object_path
  FROM f7 GROUP BY folder, file_hash""")
add("stream_request_log", """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS endpoint, count(*) AS n_requests
  FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events)
  WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")

MICRO = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
add("stream_request_sliding", f"""SELECT {MICRO.format('w')} AS window_start, event_type AS endpoint, count(*) AS n_requests
  FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k FOR k IN range(4)]) AS w, event_type FROM events)
  WHERE w + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY ALL""")
add("stream_request_sessions", f"""WITH marked AS (SELECT ts, event_type, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) <= INTERVAL 30 MINUTE
    THEN 0 ELSE 1 END AS fresh FROM events),
  numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked)
SELECT {MICRO.format('min(ts)')} AS session_start, {MICRO.format('max(ts) + INTERVAL 30 MINUTE')} AS session_end, event_type AS endpoint, count(*) AS n_requests
FROM numbered GROUP BY event_type, n HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
add("stream_matched_requests", f"""WITH landed AS (SELECT doc_id AS object_id, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (doc_id * 2591 % 2592000) AS landed_at FROM documents),
  met AS (SELECT l.object_id, landed_at, event_id, ts AS asked_at FROM landed l LEFT JOIN events e
    ON e.event_id % 200 = l.object_id AND ts >= landed_at AND ts < landed_at + INTERVAL 1 DAY),
  mark AS (SELECT least((SELECT max(landed_at) FROM landed), (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE AS m)
SELECT object_id, {MICRO.format('landed_at')} AS landed_at, event_id, {MICRO.format('asked_at')} AS asked_at
FROM met, mark WHERE event_id IS NOT NULL OR landed_at + INTERVAL 1 DAY <= m""")

# --- time ----------------------------------------------------------------------------------------

PAST = f"""past AS (SELECT event_id, {asset('user_id', 210)} AS asset_code,
  CASE WHEN event_id % 97 <> 0 THEN DATE '1994-12-01' + CAST(event_id * 37 % 2600 AS INTEGER) END AS payment_date FROM events)"""
add("price_in_force", with_(F3, PAST) + """, best AS (SELECT asset_code, d AS ref_date, arg_max(ISIN, {'i': ISIN, 'c': cents}) AS ISIN,
  arg_max(cents / 100.0::DOUBLE, {'i': ISIN, 'c': cents}) AS avg_unit_price FROM f3 GROUP BY ALL)
SELECT event_id, asset_code, payment_date, CASE WHEN near THEN ref_date END AS ref_date, CASE WHEN near THEN ISIN END AS ISIN,
  CASE WHEN near THEN avg_unit_price END AS avg_unit_price
FROM (SELECT p.*, b.ref_date, b.ISIN, b.avg_unit_price, p.payment_date - b.ref_date <= 3 AS near
  FROM past p ASOF LEFT JOIN best b ON p.asset_code = b.asset_code AND p.payment_date >= b.ref_date)""")
VERSIONS = """versions AS (SELECT issuer_cnpj, category, doc_id, CAST(receipt_date AS DATE) AS valid_from,
  lead(CAST(receipt_date AS DATE)) OVER (PARTITION BY issuer_cnpj, category ORDER BY receipt_date, doc_id) AS valid_until FROM f7)"""
add("filing_in_force", with_(F7, VERSIONS) + f"""SELECT event_id AS request_id, v.* FROM (SELECT event_id, ts, {cnpj('user_id')} AS issuer_cnpj FROM events) e
  JOIN versions v USING (issuer_cnpj) WHERE ts >= valid_from AND (valid_until IS NULL OR ts < valid_until)""")
add("filings_by_month", with_(F7, VERSIONS) + """SELECT DISTINCT m.issuer_cnpj, m.month, category, doc_id, valid_from, valid_until
  FROM (SELECT DISTINCT issuer_cnpj, CAST(date_trunc('month', CAST(receipt_date AS DATE)) AS DATE) AS month FROM f7) m
  JOIN versions v USING (issuer_cnpj) WHERE valid_from < m.month + INTERVAL 1 MONTH AND (valid_until IS NULL OR (valid_until > m.month AND valid_until > valid_from))""")


def flow(f: str) -> str:
    return f"""s.{f}::DOUBLE AS {f}_quarter, CASE WHEN y.n_{f} = 4 THEN y.{f}::DECIMAL(18,2) END::DOUBLE AS {f}_ttm,
      CASE WHEN e.{f} <> 0 THEN (s.{f}::DOUBLE - e.{f}::DOUBLE) / abs(e.{f}::DOUBLE) END AS {f}_yoy"""


FLOWS = ("revenue", "ebit", "wc_change")
add("quarterly_flows", with_(F1, sums("f1")) + f""", g AS (SELECT enr_aggregation_type, issuer_cnpj, date, year(date) * 4 + quarter(date) AS q,
    {", ".join(f"CAST({f} AS DECIMAL(18,2)) AS {f}" for f in FLOWS)} FROM ({FINANCIALS})),
  kept AS (SELECT * FROM g WHERE (CAST(right(issuer_cnpj, 2) AS INTEGER) + q) % 7 > 0),
  single AS (SELECT a.enr_aggregation_type, a.issuer_cnpj, a.date, a.q,
    {", ".join(f"CASE WHEN quarter(a.date) = 1 THEN a.{f} ELSE CAST(a.{f} - b.{f} AS DECIMAL(18,2)) END AS {f}" for f in FLOWS)}
    FROM kept a LEFT JOIN kept b ON a.enr_aggregation_type = b.enr_aggregation_type AND a.issuer_cnpj = b.issuer_cnpj AND b.q = a.q - 1),
  years AS (SELECT a.enr_aggregation_type, a.issuer_cnpj, a.q, {", ".join(f"sum(b.{f}) AS {f}, count(b.{f}) AS n_{f}" for f in FLOWS)}
    FROM single a JOIN single b ON a.enr_aggregation_type = b.enr_aggregation_type AND a.issuer_cnpj = b.issuer_cnpj AND b.q BETWEEN a.q - 3 AND a.q GROUP BY ALL)
SELECT s.enr_aggregation_type, s.issuer_cnpj, s.date, {", ".join(flow(f) for f in FLOWS)}
FROM single s JOIN years y USING (enr_aggregation_type, issuer_cnpj, q)
  LEFT JOIN single e ON s.enr_aggregation_type = e.enr_aggregation_type AND s.issuer_cnpj = e.issuer_cnpj AND e.q = s.q - 4""")

# --- summaries -----------------------------------------------------------------------------------

add("distinct_documents", with_(F7) + """SELECT CAST(date_trunc('month', CAST(ref_date AS DATE)) AS DATE) AS month, document_type, source,
  count(*) AS n_rows, count(DISTINCT file_hash) AS n_exact, true AS within_bound FROM f7 GROUP BY ALL""")
SPREADS = f"""spreads AS (SELECT indexer, CAST(round(((cents * 11 // 10) / 100.0::DOUBLE - (cents * 9 // 10) / 100.0::DOUBLE) * 100) AS BIGINT) AS spread_cents
  FROM f3 LEFT JOIN (SELECT {asset('p_partkey', 250)} AS asset_code, min(p_type) AS indexer FROM part GROUP BY 1) USING (asset_code)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY indexer ORDER BY spread_cents) AS r, count(*) OVER (PARTITION BY indexer) AS n FROM spreads)"""
add("spread_percentiles", with_(F3, SPREADS) + """SELECT indexer, percent, n, spread_cents FROM ranked, (SELECT unnest([1, 25, 50, 75, 99])::INTEGER AS percent)
  WHERE r = greatest(1, (percent * n + 99) // 100)""")
add("spread_percentiles_sketched", with_(F3, SPREADS) + """SELECT DISTINCT indexer, percent, n, true AS within_bound
  FROM ranked, (SELECT unnest([10, 50, 90])::INTEGER AS percent) WHERE indexer IS NOT NULL""")
add("digest_levels", with_(F7) + """SELECT ref_date, document_type, source, CAST(grouping_id(ref_date, document_type, source) AS INTEGER) AS level,
  count(*) AS n_documents, count(DISTINCT title) AS n_titles
  FROM (SELECT * REPLACE (CASE WHEN doc_id % 13 > 0 THEN source END AS source), category AS title FROM f7) GROUP BY CUBE (ref_date, document_type, source)""")

# --- multisets and balances ----------------------------------------------------------------------

add("reconcile_export", with_(F1, sums("f1")) + f""", g AS ({FINANCIALS}), n AS (SELECT *, CAST(right(issuer_cnpj, 2) AS INTEGER) + quarter(date) AS k FROM g)
  SELECT * EXCLUDE (k), 1::BIGINT AS n_left, ((k % 11 > 0)::INTEGER + (k % 13 = 0)::INTEGER)::BIGINT AS n_right FROM n
  WHERE (k % 11 > 0)::INTEGER + (k % 13 = 0)::INTEGER <> 1""")
LOT = f"SELECT {asset('l_partkey', 200)} AS asset_code, CAST(l_quantity AS BIGINT) AS qty, CASE WHEN l_orderkey % 5 > 0 THEN l_returnflag END AS flag FROM lineitem WHERE l_linenumber % 2 = "
add("lots_in_both", f"({LOT} 0) INTERSECT ALL ({LOT} 1)")
add("lots_in_first_only", f"({LOT} 0) EXCEPT ALL ({LOT} 1)")
add("outstanding_balance", f"""WITH e AS (SELECT event_id, {asset('user_id', 200)} AS asset_code, ts,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE -1 END * CAST(round(value * 100) AS BIGINT) AS c FROM events WHERE value IS NOT NULL),
  s AS (SELECT *, sum(c) OVER w AS s FROM e WINDOW w AS (PARTITION BY asset_code ORDER BY ts, event_id))
SELECT event_id, asset_code, CAST(s - least(0, min(s) OVER (PARTITION BY asset_code ORDER BY ts, event_id)) AS BIGINT) / 100.0::DOUBLE AS balance FROM s""")
add("cash_flow_table", f"""WITH RECURSIVE e AS (SELECT {asset('user_id', 200)} AS asset_code,
    CAST(date_trunc('month', DATE '2023-01-01' + CAST(event_id % 700 AS INTEGER)) AS DATE) AS period,
    CAST(round(value * 100) AS BIGINT) AS c, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 WHEN event_type = 'view' THEN 2 ELSE 3 END AS kind
    FROM events WHERE value IS NOT NULL),
  p AS (SELECT asset_code, period, coalesce(sum(c) FILTER (kind = 1), 0)::BIGINT AS paid, coalesce(sum(c) FILTER (kind = 2), 0)::BIGINT AS interest,
    coalesce(sum(c) FILTER (kind = 3), 0)::BIGINT AS due, row_number() OVER (PARTITION BY asset_code ORDER BY period) AS i FROM e GROUP BY 1, 2),
  flow AS (SELECT asset_code, period, i, 0::BIGINT AS opening, paid, interest, least(due, paid) AS amortized, paid - least(due, paid) AS closing FROM p WHERE i = 1
    UNION ALL SELECT p.asset_code, p.period, p.i, f.closing, p.paid, p.interest, least(p.due, f.closing + p.paid), f.closing + p.paid - least(p.due, f.closing + p.paid)
    FROM flow f JOIN p ON p.asset_code = f.asset_code AND p.i = f.i + 1)
SELECT asset_code, period, opening / 100.0::DOUBLE AS opening, paid / 100.0::DOUBLE AS paid_in, interest / 100.0::DOUBLE AS interest,
  amortized / 100.0::DOUBLE AS amortized, closing / 100.0::DOUBLE AS closing FROM flow""")

# --- headers and metadata ------------------------------------------------------------------------

add("header_report", with_(F1, F7) + """SELECT source_path, form AS source, CASE WHEN y = 1 THEN 'CNPJ_CIA' ELSE '' END AS missing,
    CASE WHEN y = 2 THEN 'GRUPO_DFP' ELSE '' END AS unexpected, CASE WHEN y IN (1, 2) THEN NULL ELSE y = 0 END AS order_differs
  FROM (SELECT DISTINCT source_path, form, file_year % 5 AS y FROM f1)
UNION ALL SELECT object_path, CASE WHEN doc_id % 29 = 0 THEN 'ipe' ELSE 'fre' END, CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'DT_RECEB' ELSE '' END,
  CASE WHEN doc_id % 29 > 0 THEN '' END, CASE WHEN doc_id % 29 > 0 AND doc_id % 7 > 0 THEN false END FROM f7""")
add("catalog_metadata", with_(F7) + """SELECT doc_id, (5 + (aggregation_type IS NOT NULL)::INTEGER)::INTEGER AS n_entries, CAST(ref_date AS DATE) AS ref_date,
  CAST(version AS INTEGER) AS version, aggregation_type, NULL::INTEGER AS trace_id, 'document_type,source' AS others FROM f7""")
