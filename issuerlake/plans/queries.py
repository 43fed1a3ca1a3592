"""Registered queries: (spark, sf_dir) -> DataFrame, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuerlake import functions as fn
from issuerlake import operators as op
from issuerlake import schemas as sc
from issuerlake import sources as src
from issuerlake import streaming as st
from issuerlake.plans import fixtures as fx
from issuerlake.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
FROM_DATE = "2024-01-15"


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


# --- scans and parsers ---------------------------------------------------------------------------

CSV_COLUMNS = [
    "CNPJ_CIA", "DT_REFER", "VERSAO", "DT_FIM_EXERC", "ORDEM_EXERC", "ESCALA_MOEDA", "CD_CONTA", "DS_CONTA", "VL_CONTA",
]


@query
def scan_statements(spark, sf):
    """Statement rows written as the source's CSV files, read back strictly and tagged by file."""
    path = shared_dir(spark, "statements")
    rows = fx.statement_rows(spark, sf).withColumn("file", F.substring_index("source_path", "/", -1))
    (
        rows.select("file", *CSV_COLUMNS).hint("rebalance", "file").write.partitionBy("file")
        .option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    )
    scanned = src.with_path(src.read_delimited(spark, path, sc.STATEMENT_SCHEMA))
    return src.tag_origin_file(src.tag_files(scanned)).select(
        *CSV_COLUMNS, "statement_code", "enr_aggregation_type", "file_year", "ORIGIN_FILE"
    )


@query
def scan_preamble_tsv(spark, sf):
    raw = src.read_preamble_tsv(
        spark, fx.event_replies(spark, sf), len(fx.PREAMBLE), sc.EVENTS_SCHEDULE_SOURCE, encoding="UTF-8",
        names=sc.EVENTS_SCHEDULE_COLUMNS,
    )
    return raw.select("line_no", *sc.EVENTS_SCHEDULE_COLUMNS)


@query
def scan_quoted_tsv(spark, sf):
    """Replies with cells that hold quotes and line breaks: records are counted, not lines."""
    raw = src.read_preamble_tsv(
        spark, fx.event_replies(spark, sf, 500, quoted=True), len(fx.PREAMBLE), sc.EVENTS_SCHEDULE_SOURCE, encoding="UTF-8",
        names=sc.EVENTS_SCHEDULE_COLUMNS,
    )
    return raw.select("line_no", *sc.EVENTS_SCHEDULE_COLUMNS)


@query
def incremental_financials(spark, sf):
    """Gold of three runs on one lake: half of the issuers, the other half, then files that arrived later."""
    from issuerlake.plans import etl

    path, lake = shared_dir(spark, "arriving"), shared_dir(spark, "lake")
    rows = fx.statement_rows(spark, sf).withColumn("file", F.substring_index("source_path", "/", -1))
    late = F.col("ORIGIN_FILE") == "DFP"
    for name, part in (("early", rows.filter(~late)), ("late", rows.filter(late))):
        (
            part.select("file", *CSV_COLUMNS).hint("rebalance", "file").write.partitionBy("file")
            .option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/{name}")
        )
    # Stored, since runs read them several times, and since a table's size tells Spark whether to broadcast it.
    fx.issuers(spark, sf).select("issuer_cnpj").write.parquet(f"{path}/issuers")
    issuers = spark.read.parquet(f"{path}/issuers")
    half = F.crc32(F.col("issuer_cnpj").cast("binary")) % 2 == 0
    etl.financial_statements(spark, f"{path}/early", lake, fx.RUN, issuers=issuers.filter(half))
    etl.financial_statements(spark, f"{path}/early", lake, fx.RUN, issuers=issuers.filter(~half))
    return etl.financial_statements(spark, f"{path}/late", lake, fx.RUN)


@query
def select_statement_files(spark, sf):
    tagged = src.tag_files(fx.statement_rows(spark, sf).drop("file_year"))
    return tagged.groupBy("statement_code", "enr_origin_document_type", "enr_aggregation_type", "file_year").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def tag_origin_file(spark, sf):
    tagged = src.tag_origin_file(fx.statement_rows(spark, sf).drop("ORIGIN_FILE"))
    return tagged.groupBy("source_path", "ORIGIN_FILE").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def parse_macro_feed(spark, sf):
    return src.parse_macro(fx.macro_bodies(spark, sf)).withColumns(
        {c: src.feed_number(F.col(c)) for c in ("value", "rate")}
    )


@query
def macro_gold(spark, sf):
    return src.macro_gold(src.parse_macro(fx.macro_bodies(spark, sf)))


@query
def parse_rad_results(spark, sf):
    return src.parse_rad(fx.rad_texts(spark, sf)).drop("reply_id")


@query
def extract_listing_rows(spark, sf):
    return src.extract_rows(fx.listing_pages(spark, sf))


@query
def extract_page_links(spark, sf):
    return src.extract_links(fx.table(spark, sf, "pages").select("page_id", "html"))


@query
def extract_update_stamp(spark, sf):
    return src.extract_stamp(fx.stamp_pages(spark, sf))


@query
def extract_embedded_pdfs(spark, sf):
    return src.extract_payloads(fx.payload_xml(spark, sf)).drop("content")


@query
def strip_embedded_pdfs(spark, sf):
    return src.strip_payloads(fx.payload_xml(spark, sf))


@query
def decode_rad_payload(spark, sf):
    replies = fx.table(spark, sf, "documents").selectExpr(
        "doc_id", "concat(' ', base64(encode(text, 'UTF-8')), '\\n') AS payload"
    )
    return src.decode_payload(replies).drop("content")


@query
def download_manifest(spark, sf):
    return src.manifest(fx.filings(spark, sf).drop("document_type"))


@query
def rad_manifest(spark, sf):
    return src.rad_manifest(src.parse_rad(fx.rad_texts(spark, sf)), "DADOS_ECONOMICO_E_FINANCEIROS")


# --- cleaning ------------------------------------------------------------------------------------


@query
def br_number(spark, sf):
    return fx.raw_prices(spark, sf).select(
        "asset_code", "ref_date",
        *[fn.br_number(F.col(c)).alias(c) for c in ("min_unit_price", "avg_unit_price", "max_unit_price")],
    )


@query
def br_number_bad(spark, sf):
    return fx.raw_events(spark, sf).select("event_id", fn.br_number(F.col("rate_or_percent")).alias("rate_or_percent"))


@query
def parse_dates_strict(spark, sf):
    return fx.filings(spark, sf).select(
        "doc_id", *[fn.date_strict(F.col(c)).alias(c) for c in ("ref_date", "receipt_date")]
    )


@query
def parse_dates_lenient(spark, sf):
    return fx.raw_events(spark, sf).select(
        "event_id", *[fn.date_lenient(F.col(c)).alias(c) for c in ("event_date", "payment_date")]
    )


@query
def numeric_lenient(spark, sf):
    return fx.raw_terms(spark, sf).select(
        F.col("Codigo (Interno)").alias("row_id"),
        fn.numeric_lenient(F.col("`Juros Criterio Novo - Taxa`")).alias("coupon"),
        fn.numeric_lenient(F.col("`Percentual Multiplicador/Rentabilidade`")).alias("coupon_alt"),
    )


@query
def null_tokens(spark, sf):
    return fn.null_tokens(fx.raw_events(spark, sf))


@query
def snake_names(spark, sf):
    raw = F.concat(F.lit(" "), "p_brand", F.lit(" ("), "p_name", F.lit(") / Código-"), "p_type", F.lit("!?  Ação "))
    return fx.table(spark, sf, "part").select("p_partkey", fn.snake_col(raw).alias("snake"))


@query
def conform_terms(spark, sf):
    return op.conform(fx.raw_terms(spark, sf))


@query
def coupon_fallback(spark, sf):
    renamed = op.conform(fx.raw_terms(spark, sf)).select("asset_code", "enr_codigo_interno", "coupon", "coupon_alt")
    return op.fallback_by_group(renamed)


@query
def terms_gold(spark, sf):
    return op.terms_gold(fx.raw_terms(spark, sf))


@query
def covenants_text(spark, sf):
    raw = fx.raw_terms(spark, sf)
    return raw.select(F.col("Codigo (Interno)").alias("row_id"), op.covenants(raw.columns).alias("covenants"))


@query
def halve_doubled(spark, sf):
    return fx.raw_events(spark, sf).select("event_id", fn.halve_doubled(F.col("yield_type")).alias("yield_type"))


@query
def scale_amounts(spark, sf):
    return op.scale_amounts(fx.statement_rows(spark, sf)).select(
        "source_path", "CD_CONTA", "ESCALA_MOEDA", F.col("enr_adjusted_account_value").cast("double").alias("amount")
    )


@query
def map_labels_strict(spark, sf):
    items = src.parse_macro(fx.macro_bodies(spark, sf))
    return items.select("security_id", fn.map_labels(F.col("group_label"), sc.MACRO_TYPES, strict=True).alias("data_type"))


@query
def pick_filled(spark, sf):
    items = src.parse_macro(fx.macro_bodies(spark, sf))
    return items.select(
        "security_id", fn.pick_filled(src.feed_number(F.col("value")), src.feed_number(F.col("rate"))).alias("value")
    )


def enriched_statements(spark, sf):
    return op.scale_amounts(op.enrich(fx.tagged_statements(spark, sf), fx.RUN))


@query
def enrich_statement(spark, sf):
    cols = [
        "enr_origin_document_type", "enr_last_updated_date", "enr_ingestion_trace_id", "enr_source", "enr_quarter",
        "enr_year", "enr_account_type", "enr_aggregation_type",
    ]
    return enriched_statements(spark, sf).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def cnpj_digits(spark, sf):
    digits = fn.cnpj_digits(F.col("issuer_cnpj"))
    return fx.filings(spark, sf).select(
        "doc_id", digits.alias("digits"), fn.cnpj_format(digits).alias("formatted"),
        fn.cnpj_digits(F.col("ref_date")).alias("ref_date_digits"),
    )


@query
def conform_schema(spark, sf):
    return op.clean_events(fx.raw_events(spark, sf))


@query
def object_path(spark, sf):
    path = fn.object_path(
        F.lit("gold/documents"), F.col("source"), F.col("document_type"), agg=F.col("aggregation_type"),
        version=F.col("version"), extra=F.col("title"), ref_date=F.col("ref_date"), ext=F.lit("pdf"),
    )
    return fx.filings(spark, sf).select("doc_id", path.alias("path"))


@query
def collapse_ws(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", fn.collapse_ws(F.col("text")).alias("text"))


# --- filters and checks --------------------------------------------------------------------------


@query
def filter_issuer(spark, sf):
    wanted = fx.issuers(spark, sf).filter(F.col("industry").isin("HOUSEHOLD", "MACHINERY"))
    kept = op.filter_issuer(fx.statement_rows(spark, sf), wanted)
    return kept.groupBy("CNPJ_CIA").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def filter_issuer_rows(spark, sf):
    """The filtered rows themselves, with accounts and amounts."""
    wanted = fx.issuers(spark, sf).filter(F.col("industry").isin("HOUSEHOLD", "MACHINERY"))
    return op.filter_issuer(fx.statement_rows(spark, sf), wanted).select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA", "source_path")


@query
def filter_last_exercise(spark, sf):
    return op.filter_last_exercise(fx.statement_rows(spark, sf)).groupBy("ORDEM_EXERC", "CD_CONTA").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def filter_categories(spark, sf):
    return op.filter_categories(fx.filings(spark, sf).drop("document_type"), sc.FILING_CATEGORIES).select(
        "doc_id", "category", "document_type"
    )


@query
def filter_years(spark, sf):
    return op.filter_years(fx.filings(spark, sf), as_of=2025).select("doc_id", "file_year", "form")


@query
def quality_report(spark, sf):
    rules = {
        "issuer_missing": F.col("CNPJ_CIA").isNull(),
        "unmapped_scale": ~F.col("ESCALA_MOEDA").isin(list(sc.AMOUNT_SCALES)),
        "date_missing": F.col("DT_REFER").isNull(),
        "not_last_exercise": F.col("ORDEM_EXERC") != sc.LAST_EXERCISE,
    }
    statements = op.quality_report(fx.statement_rows(spark, sf), rules).withColumn("dataset", F.lit("statements"))
    events = op.quality_report(
        op.clean_events(fx.raw_events(spark, sf)),
        {"payment_date_missing": F.col("payment_date").isNull(), "rate_missing": F.col("rate_or_percent").isNull()},
    ).withColumn("dataset", F.lit("events"))
    items = src.parse_macro(fx.macro_bodies(spark, sf))
    macro = op.quality_report(
        items, {"unmapped_label": fn.map_labels(F.col("group_label"), sc.MACRO_TYPES).isNull()}
    ).withColumn("dataset", F.lit("macro"))
    checked = op.reply_checks(fx.reply_bodies(spark, sf), sc.EVENTS_SCHEDULE_SOURCE, len(fx.PREAMBLE), required=[0, 3])
    replies = op.quality_report(checked, {
        "header_differs": F.col("header_differs"), "not_found": F.col("not_found"), "one_row": F.col("n_rows") == 1,
    }).withColumn("dataset", F.lit("replies"))
    found = src.parse_rad(fx.rad_texts(spark, sf))
    filings = op.quality_report(found, {
        f"{c}_missing": F.col(c).isNull() for c in ("protocol_id", "reference_date", "delivery_date")
    }).withColumn("dataset", F.lit("filings"))
    return op.union_ragged(statements, events, macro, replies, filings)


@query
def missing_categories(spark, sf):
    return op.missing_categories(fx.filings(spark, sf), list(sc.FILING_CATEGORIES))


@query
def uncovered_assets(spark, sf):
    return op.uncovered_assets(fx.listing(spark, sf), fx.raw_prices(spark, sf))


# --- statements ----------------------------------------------------------------------------------


@query
def union_itr_dfp(spark, sf):
    rows = fx.statement_rows(spark, sf)
    parts = [rows.filter(F.col("ORIGIN_FILE") == o) for o in ("ITR", "DFP")]
    return op.union_itr_dfp(*parts).groupBy("stmt", "ORIGIN_FILE").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def union_ragged(spark, sf):
    rows = enriched_statements(spark, sf).drop("enr_account_type")
    doc_type = F.col("enr_origin_document_type")
    sheets = [
        rows.filter(doc_type == d).withColumn("enr_account_type", F.lit(a)) for d, a in sc.ACCOUNT_TYPES.items()
    ]
    flows = rows.filter(~doc_type.isin(list(sc.ACCOUNT_TYPES)))
    return op.union_ragged(*sheets, flows).groupBy("enr_origin_document_type", "enr_account_type").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def union_rows(spark, sf):
    """Quarterly and annual rows of layouts with different columns in one table: what a layout lacks is null."""
    rows = fx.statement_rows(spark, sf)
    itr = rows.filter("ORIGIN_FILE = 'ITR'").select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA", "ORIGIN_FILE")
    dfp = rows.filter("ORIGIN_FILE = 'DFP'").select("ORIGIN_FILE", "VL_CONTA", "DT_REFER", "CNPJ_CIA", "CD_CONTA")
    scaled = rows.filter("stmt = 'DRE'").select("CNPJ_CIA", "ESCALA_MOEDA", "VL_CONTA")
    return op.union_ragged(op.union_itr_dfp(itr, dfp), scaled)


@query
def split_by_aggregation(spark, sf):
    return op.split_by_aggregation(enriched_statements(spark, sf)).groupBy("enr_aggregation_type", "enr_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("enr_adjusted_account_value").cast("double").alias("total")
    )


def last_exercise(spark, sf):
    return op.filter_last_exercise(op.scale_amounts(fx.tagged_statements(spark, sf)))


@query
def account_sums(spark, sf):
    sums = op.account_sums(last_exercise(spark, sf))
    amounts = [*sc.ACCOUNTS_EXACT, *sc.ACCOUNTS_PREFIX]
    return sums.withColumns({c: F.col(c).cast("double") for c in amounts})


@query
def account_sums_leaf_only(spark, sf):
    sums = op.account_sums(last_exercise(spark, sf), leaf_only=True)
    amounts = [*sc.ACCOUNTS_EXACT, *sc.ACCOUNTS_PREFIX]
    return sums.withColumns({c: F.col(c).cast("double") for c in amounts})


@query
def financials_quarterly(spark, sf):
    return op.financials_quarterly(last_exercise(spark, sf))


@query
def dataset_ref_date(spark, sf):
    return op.dataset_ref_date(fx.tagged_statements(spark, sf))


# --- debentures ----------------------------------------------------------------------------------


@query
def events_schedule(spark, sf):
    # The place within the issuer, numbered in the order of the rows, shows the order of the whole.
    placed = op.events_schedule(fx.raw_events(spark, sf)).withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("issuer").orderBy("_at"))
    return placed.withColumn("place", place).drop("_at")


@query
def traded_prices(spark, sf):
    return op.traded_prices(fx.raw_prices(spark, sf))


@query
def upcoming_payments(spark, sf):
    return op.upcoming_payments(op.clean_events(fx.raw_events(spark, sf)), FROM_DATE)


@query
def asset_price_coverage(spark, sf):
    return op.asset_price_coverage(fx.listing(spark, sf), fx.raw_prices(spark, sf))


# --- catalog and issuers -------------------------------------------------------------------------


@query
def latest_filing(spark, sf):
    return op.latest_filing(fx.filings(spark, sf).select("doc_id", "issuer_cnpj", "receipt_date", "ref_date", "url"))


@query
def risk_exposure(spark, sf):
    return op.risk_exposure(fx.litigation(spark, sf))


@query
def ingest_digest(spark, sf):
    return op.ingest_digest(fx.filings(spark, sf))


@query
def digest_listing(spark, sf):
    return op.digest_listing(fx.filings(spark, sf))


@query
def latest_documents(spark, sf):
    return op.latest_documents(fx.filings(spark, sf).select("doc_id", "issuer_cnpj", "ref_date", "title"))


@query
def key_legal_risks(spark, sf):
    out = op.key_legal_risks(fx.litigation(spark, sf))
    return out.select("issuer_cnpj", "rank", "case_id", "risk_level", F.col("claimed_amount").cast("double").alias("claimed"))


@query
def resolve_issuer(spark, sf):
    return op.resolve_issuer(fx.requests(spark, sf), fx.issuers(spark, sf), fx.listing(spark, sf))


@query
def issuer_profile(spark, sf):
    events = op.clean_events(fx.raw_events(spark, sf)).withColumns({
        "amount": F.expr("cast(rate_or_percent * 10 as decimal(18,2))"),
        "status": F.expr("CASE WHEN day(payment_date) % 2 = 0 THEN 'confirmed' END"),
    })
    profile = op.issuer_profile(
        fx.issuers(spark, sf), fx.filings(spark, sf), fx.litigation(spark, sf), events, FROM_DATE, listing=fx.listing(spark, sf)
    )
    exact = {"claimed_value": "decimal(18,2)", "interest_rate": "decimal(18,2)"}

    def items(c):
        """Every field of every struct, as text."""
        names = profile.schema[c].dataType.elementType.names

        def item(x):
            fields = [x[n].cast(exact[n]) if n in exact else x[n] for n in names]
            return F.concat_ws("~", *[F.coalesce(f.cast("string"), F.lit("-")) for f in fields])

        return F.array_join(F.transform(c, item), ";").alias(c)

    return profile.select(
        "issuer_cnpj", "issuer_name", "ticker", "industry", "total_documents", "total_legal_risks", "total_risk_exposure",
        "total_upcoming_payments", *[items(c) for c in ("latest_documents", "key_legal_risks", "upcoming_payments")],
    )


@query
def attach_metadata(spark, sf):
    docs = fx.filings(spark, sf)
    return op.attach_metadata(docs, docs, fx.issuers(spark, sf))


@query
def freshness_gate(spark, sf):
    docs = fx.filings(spark, sf).withColumn("last_update", F.col("ref_date"))
    return op.freshness_gate(docs, fx.landed(docs)).select("doc_id", "document_type", "file_year", "last_update")


@query
def dedup_content(spark, sf):
    docs = fx.filings(spark, sf).select("doc_id", "folder", "file_hash", "object_path", "receipt_date")
    return op.dedup_content(fx.arriving(docs), fx.landed(docs), [F.asc("doc_id")]).select(
        "doc_id", "folder", "file_hash", "object_path"
    )


@query
def catalog_rows(spark, sf):
    return op.catalog_rows(fx.filings(spark, sf), fx.RUN, content="text")


@query
def find_documents(spark, sf):
    docs = fx.filings(spark, sf).select("object_path", "file_hash", "receipt_date")
    return op.find_documents(docs, fx.landed(docs), "SRC1/")


@query
def write_gold(spark, sf):
    path = shared_dir(spark, "gold")
    op.write_gold(
        op.financials_quarterly(last_exercise(spark, sf)).withColumn("ref_year", F.col("year")), path,
        ["enr_aggregation_type", "ref_year"],
    )
    return spark.read.parquet(path).select("enr_aggregation_type", *sc.FINANCIALS_COLUMNS)


@query
def export_sheets(spark, sf):
    path = shared_dir(spark, "sheets")
    op.export_sheets(op.financials_quarterly(last_exercise(spark, sf)), path)
    schema = "issuer_cnpj string, date date, quarter string, year int, " + ", ".join(
        f"{c} double" for c in sc.FINANCIALS_COLUMNS[4:]
    )
    back = spark.read.option("header", True).schema(schema + ", enr_aggregation_type string").csv(path)
    return back.select("enr_aggregation_type", *sc.FINANCIALS_COLUMNS)


@query
def serving_json(spark, sf):
    gold = src.macro_gold(src.parse_macro(fx.macro_bodies(spark, sf)))
    records = op.serving_json(gold, "macro_data", fx.RUN, ["security_id"])
    envelope = f"data struct<{sc.MACRO_GOLD.replace(' ', ':').replace(',:', ',')}>, file_bucket_path string, ref_date string, trace_id string"
    parsed = records.select("cache_key", F.from_json("payload", envelope).alias("p"))
    return parsed.select(
        "cache_key", "p.data.security_id", "p.data.data_type", "p.data.value",
        F.col("p.data.ref_date").alias("quote_date"), "p.file_bucket_path", "p.ref_date", "p.trace_id",
    )


# --- chunks --------------------------------------------------------------------------------------


@query
def chunk_naive(spark, sf):
    return op.chunk_naive(fx.table(spark, sf, "documents").select("doc_id", "text"))


@query
def chunk_sentences(spark, sf):
    return op.chunk_naive(fx.table(spark, sf, "documents").select("doc_id", "text"), limit=128, unit="sentence")


@query
def chunk_overlap(spark, sf):
    return op.chunk_overlap(fx.table(spark, sf, "documents").select("doc_id", "text"))


@query
def chunk_rows(spark, sf):
    docs = op.catalog_rows(fx.filings(spark, sf), fx.RUN, content="text", keep=("text", "doc_id"))
    read = op.chunk_overlap(docs).withColumns({
        "confidence": F.expr("CASE WHEN doc_id % 4 = 0 THEN 0.5 ELSE 1.0 END"),
        "read_method": F.expr("CASE WHEN doc_id % 4 = 0 THEN 'ocr' ELSE 'text' END"),
        "page_start": F.expr("chunk_no div 2 + 1"), "page_end": F.expr("(chunk_no + 1) div 2 + 1"),
        "embedding": F.expr("array(cast(tokens as float), cast(chunk_no as float))"),
    })
    records = op.chunk_rows(read)
    # Arrays are compared as their elements.
    return records.select(
        *[c for c in records.columns if c not in ("embedding", "confidence")], F.col("confidence").cast("double").alias("confidence"),
        *[F.col("embedding")[i].cast("double").alias(f"embedding_{i}") for i in (0, 1)],
    )


@query
def l2_normalize(spark, sf):
    scaled = fx.table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2)).alias("v")
    )
    return scaled.select("vec_id", F.posexplode(fn.l2_normalize(F.col("v"))).alias("pos", "x")).withColumn("x", F.round("x", 5))


@query
def check_dimension(spark, sf):
    # Vectors of two labels lose their last value, so there is something to find.
    v = fx.table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("label") < 2, F.slice("embedding", 1, F.size("embedding") - 1)).otherwise(F.col("embedding")).alias("embedding")
    )
    return op.check_dimension(v, 64)


@query
def index_completeness(spark, sf):
    # English documents are stored completely, French ones without their first chunk, others not at all.
    chunks = op.chunk_overlap(fx.table(spark, sf, "documents").select("doc_id", "lang", "text"))
    stored = chunks.filter((F.col("lang") == "en") | ((F.col("lang") == "fr") & (F.col("chunk_no") > 0)))
    return op.index_completeness(chunks.select("doc_id"), stored.select("doc_id"))


@query
def upsert_chunks(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")

    def records(chunks, version):
        return chunks.select(
            F.concat_ws("#chunk_", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string")).alias("chunk_id"),
            "doc_id", "text", "tokens", F.lit(version).alias("version"),
        )

    return op.upsert_chunks(records(op.chunk_naive(docs), 1), records(op.chunk_overlap(docs), 2))


@query
def extract_doc_metadata(spark, sf):
    found = op.extract_doc_metadata(fx.table(spark, sf, "documents").select("doc_id", "text"))
    cols = ["dates", "numbers", "currencies", "fiscal_periods"]
    return found.select("doc_id", *[F.array_join(c, "|").alias(c) for c in cols])


# --- search --------------------------------------------------------------------------------------


def plain_queries(spark, sf):
    return fx.table(spark, sf, "benchmark").selectExpr("item_id AS query_id", "text AS q")


@query
def knn_cosine(spark, sf):
    return op.knn_cosine(fx.search_queries(spark, sf).select("query_id", "vector"), fx.vectors(spark, sf))


@query
def knn_cosine_filtered(spark, sf):
    q = fx.search_queries(spark, sf).select("query_id", "vector")
    return op.knn_cosine(q, fx.vectors(spark, sf), k=5, filters={"label": 3})


@query
def bm25_topk(spark, sf):
    return op.bm25_topk(op.query_terms(plain_queries(spark, sf)), fx.texts(spark, sf))


@query
def hybrid_search(spark, sf):
    # Made-up texts agree less than real ones: a lower threshold lets several candidates through.
    return op.hybrid_search(fx.search_queries(spark, sf), fx.vectors(spark, sf), fx.texts(spark, sf), threshold=0.3)


@query
def agent_profiles(spark, sf):
    names = ", ".join(f"'{n}'" for n in sc.AGENT_PROFILES)
    asked = fx.search_queries(spark, sf).withColumn(
        "profile", F.expr(f"element_at(array({names}), cast(query_id % {len(sc.AGENT_PROFILES)} as int) + 1)")
    )
    profiles = spark.createDataFrame(
        [(n, top, rerank, low, *weights) for (n, (top, rerank, _, *weights)), low in zip(sc.AGENT_PROFILES.items(), (0.3, 0.35, 0.25))],
        "profile string, retrieval_top_k int, rerank_top_k int, similarity_threshold double, vector_weight double, "
        "keyword_weight double",
    )
    return op.agent_profiles(asked, profiles, fx.vectors(spark, sf), fx.texts(spark, sf))


@query
def expand_query(spark, sf):
    table = fx.synonyms(spark, sf).unionByName(op.synonym_table(spark))
    return op.expand_query(plain_queries(spark, sf), table)


# --- streams -------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    return st.stream_ingest_documents(spark, sf)


@query
def stream_request_log(spark, sf):
    return st.stream_request_windows(spark, sf)


@query
def stream_gold_refresh(spark, sf):
    return st.stream_gold_from_statements(spark, sf)


@query
def stream_request_sessions(spark, sf):
    return st.stream_sessions_of_requests(spark, sf)


@query
def stream_request_sliding(spark, sf):
    return st.stream_sliding_requests(spark, sf)


@query
def stream_matched_requests(spark, sf):
    return st.stream_documents_requested(spark, sf)


# --- time ----------------------------------------------------------------------------------------


@query
def price_in_force(spark, sf):
    """The average price that an asset last had when an event was paid, and its day; none older than three days."""
    paid = fx.past_events(spark, sf)
    prices = op.traded_prices(fx.raw_prices(spark, sf))
    return op.asof_join(
        paid, prices, ["asset_code"], "payment_date", "ref_date", ["ref_date", "ISIN", "avg_unit_price"], ties=["ISIN", "avg_unit_price"],
        bucket_seconds=90 * 86_400, tolerance_seconds=3 * 86_400,
    )


def filing_versions(spark, sf):
    rows = fx.filings(spark, sf).select("issuer_cnpj", "category", "doc_id", "version", F.to_date("receipt_date").alias("valid_from"))
    return op.validity(rows, ["issuer_cnpj", "category"], "valid_from", [F.asc("doc_id")], "valid_until")


@query
def filing_in_force(spark, sf):
    """Per request the filing of every category that was the issuer's last one then."""
    asked = fx.table(spark, sf, "events").selectExpr("event_id AS request_id", "ts", f"{fx.cnpj('user_id')} AS issuer_cnpj")
    found = op.interval_join(asked, filing_versions(spark, sf), ["issuer_cnpj"], "ts", "valid_from", "valid_until")
    return found.select("request_id", "issuer_cnpj", "category", "doc_id", "valid_from", "valid_until")


@query
def filings_by_month(spark, sf):
    """The versions that were valid on some day of a month in which the issuer filed anything."""
    months = fx.filings(spark, sf).select("issuer_cnpj", F.trunc("receipt_date", "month").alias("month")).distinct()
    months = months.withColumn("next_month", F.add_months("month", 1))
    found = op.overlap_join(months, filing_versions(spark, sf), ["issuer_cnpj"], ("month", "next_month"), ("valid_from", "valid_until"))
    return found.select("issuer_cnpj", "month", "category", "doc_id", "valid_from", "valid_until")


@query
def quarterly_flows(spark, sf):
    # Every seventh quarter of an issuer is left out, so that there are gaps.
    gold = op.financials_quarterly(last_exercise(spark, sf))
    gaps = gold.filter("(cast(right(issuer_cnpj, 2) as int) + year(date) * 4 + quarter(date)) % 7 > 0")
    return op.quarterly_flows(gaps, ["revenue", "ebit", "wc_change"])


# --- summaries -----------------------------------------------------------------------------------


@query
def distinct_documents(spark, sf):
    """Distinct contents per month, type and source: exact, and from daily sketches merged batch by batch."""
    docs = fx.filings(spark, sf).select("doc_id", F.to_date("ref_date").alias("day"), "document_type", "source", "file_hash")
    path = shared_dir(spark, "sketches")
    by = ["day", "document_type", "source"]
    for batch in range(3):
        op.add_sketches(spark, path, op.distinct_sketches(docs.filter(F.pmod("doc_id", F.lit(3)) == batch), by, "file_hash"), "day")
    span = [F.trunc("day", "month").alias("month"), F.col("document_type"), F.col("source")]
    estimated = op.distinct_estimates(spark.read.parquet(path), span)
    exact = docs.groupBy(*span).agg(F.count_distinct("file_hash").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    keys = ["month", "document_type", "source"]
    return estimated.join(exact, keys).select(*keys, "n_rows", "n_exact", (off <= F.greatest(F.lit(1.0), 0.06 * F.col("n_exact"))).alias("within_bound"))


def price_spreads(spark, sf):
    """Spread of a traded price in cents, with the indexer of its asset."""
    indexers = fx.table(spark, sf, "part").groupBy(F.expr(fx.asset("p_partkey", 250)).alias("asset_code")).agg(F.min("p_type").alias("indexer"))
    prices = op.traded_prices(fx.raw_prices(spark, sf))
    spread = F.round((F.col("max_unit_price") - F.col("min_unit_price")) * 100).cast("bigint")
    return prices.select("asset_code", spread.alias("spread_cents")).join(indexers, "asset_code", "left")


@query
def spread_percentiles(spark, sf):
    """Exact percentiles of the price spread per indexer."""
    return op.exact_percentiles(price_spreads(spark, sf), ["indexer"], "spread_cents", [1, 25, 50, 75, 99])


@query
def spread_percentiles_sketched(spark, sf):
    """Percentiles per indexer from sketches per asset, and whether their exact rank is within one percent of the rows."""
    path = shared_dir(spark, "spreads")
    # Prices are read once, and once the few percentiles are written, the rows do not move to meet them.
    price_spreads(spark, sf).write.parquet(f"{path}/rows")
    spreads = spark.read.parquet(f"{path}/rows")
    sketches = op.percentile_sketches(spreads, ["indexer", "asset_code"], "spread_cents")
    op.approximate_percentiles(sketches, ["indexer"], [10, 50, 90], "approximate").write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    below = spreads.join(found, "indexer").groupBy("indexer", "percent", "n").agg(
        F.count_if(F.col("spread_cents") < F.col("approximate")).alias("_lt"), F.count_if(F.col("spread_cents") <= F.col("approximate")).alias("_le")
    )
    wanted, slack = F.col("percent") * F.col("n") / 100, F.col("n") / 100 + 1
    return below.select("indexer", "percent", "n", ((F.col("_lt") <= wanted + slack) & (F.col("_le") >= wanted - slack)).alias("within_bound"))


@query
def digest_levels(spark, sf):
    """The ingest digest on every level of day, type and source, total rows told from those of unknown sources."""
    rows = fx.filings(spark, sf).withColumn("source", F.when(F.col("doc_id") % 13 > 0, F.col("source")))
    return op.digest_levels(rows, ["ref_date", "document_type", "source"])


# --- multisets and balances ----------------------------------------------------------------------


@query
def reconcile_export(spark, sf):
    """Gold rows against an export that lost the rows of some quarters and has others twice."""
    gold = op.financials_quarterly(last_exercise(spark, sf))
    n = "cast(right(issuer_cnpj, 2) as int) + quarter(date)"
    path = shared_dir(spark, "export")
    exported = gold.filter(f"({n}) % 11 > 0").unionByName(gold.filter(f"({n}) % 13 = 0"))
    op.export_sheets(exported, path)
    back = spark.read.option("header", True).schema(gold.schema).csv(path)
    return op.reconcile(gold, back)


def lots(spark, sf, odd: int):
    return fx.table(spark, sf, "lineitem").filter(f"l_linenumber % 2 = {odd}").selectExpr(
        f"{fx.asset('l_partkey', 200)} AS asset_code", "cast(l_quantity AS bigint) AS qty", "CASE WHEN l_orderkey % 5 > 0 THEN l_returnflag END AS flag"
    )


@query
def lots_in_both(spark, sf):
    return op.multiset_intersect(lots(spark, sf, 0), lots(spark, sf, 1))


@query
def lots_in_first_only(spark, sf):
    return op.multiset_difference(lots(spark, sf, 0), lots(spark, sf, 1))


@query
def outstanding_balance(spark, sf):
    """What is outstanding of a debenture after every event: some pay in, the others amortize as far as anything is owed."""
    events = fx.table(spark, sf, "events").selectExpr(
        "event_id", f"{fx.asset('user_id', 200)} AS asset_code", "ts", "event_type", "cast(round(value * 100) AS bigint) / 100 AS amount",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    change = F.when(F.col("event_type").isin("purchase", "signup"), F.col("amount")).otherwise(-F.col("amount"))
    found = op.running_balance(events, ["asset_code"], "ts", ["event_id"], change, bucket_seconds=3 * 86_400)
    return found.select("event_id", "asset_code", F.col("balance").cast("double").alias("balance"))


@query
def cash_flow_table(spark, sf):
    kind = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'paid_in' WHEN event_type = 'view' THEN 'interest' ELSE 'amortized' END AS kind"
    events = fx.table(spark, sf, "events").selectExpr(
        f"{fx.asset('user_id', 200)} AS asset_code", "date_add(date'2023-01-01', cast(event_id % 700 AS int)) AS event_date", kind,
        "cast(round(value * 100) AS bigint) / 100 AS amount",
    )
    flows = op.cash_flow_table(events)
    return flows.select("asset_code", "period", *[F.col(c).cast("double").alias(c) for c in ("opening", "paid_in", "interest", "amortized", "closing")])


# --- headers and metadata ------------------------------------------------------------------------


@query
def header_report(spark, sf):
    """Headers of statement files, form lists and replies, some of them in another order, short of a column or with one more."""
    order = ", ".join(f"'{c}'" for c in CSV_COLUMNS)
    files = fx.statement_rows(spark, sf).select("source_path", "file_year").distinct().selectExpr(
        "source_path", "CASE WHEN startswith(source_path, 'bronze/raw/dfp') THEN 'dfp' ELSE 'itr' END AS source",
        f"""array_join(CASE WHEN file_year % 5 = 0 THEN reverse(array({order})) WHEN file_year % 5 = 1 THEN slice(array({order}), 2, 8)
        WHEN file_year % 5 = 2 THEN concat(array({order}), array('GRUPO_DFP')) ELSE array({order}) END, ';') AS header""",
    )
    forms = fx.filings(spark, sf).selectExpr(
        "object_path AS source_path", "CASE WHEN doc_id % 29 = 0 THEN 'ipe' ELSE 'fre' END AS source",
        "CASE WHEN doc_id % 7 = 0 THEN 'CNPJ_CIA;LINK_DOC' ELSE '\"LINK_DOC\"; DT_RECEB ;CNPJ_CIA' END AS header",
    )
    expected = {"itr": CSV_COLUMNS, "dfp": CSV_COLUMNS, "fre": ["DT_RECEB", "LINK_DOC"]}
    found = op.header_report(files.unionByName(forms), expected, loose={"fre"})
    return found.select("source_path", "source", F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected"), "order_differs")


@query
def catalog_metadata(spark, sf):
    """Lineage as a map of strings and back."""
    rows = op.catalog_rows(fx.filings(spark, sf), fx.RUN, content="text", keep=("doc_id", "version"))
    packed = op.metadata_map(rows, ["document_type", "ref_date", "aggregation_type", "trace_id", "version", "source"])
    n = F.size("metadata").alias("n_entries")
    back = op.metadata_columns(packed.select("doc_id", n, "metadata"), {"ref_date": "date", "version": "int", "aggregation_type": "string", "trace_id": "int"})
    return back.select("doc_id", "n_entries", "ref_date", "version", "aggregation_type", "trace_id", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("others"))
