"""End-to-end jobs: landed files to gold tables, for all issuers at once.

Each job is one lazy plan per output table; silver layers are written only where later jobs read them.
``run`` holds trace_id, source, last_update, ref_date and ingest_ts of the ingestion run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake import operators as op
from issuerlake import schemas as sc
from issuerlake import sources as src
from issuerlake.functions import date_strict

Run = dict[str, str]


def require(report: DataFrame, checks: list[str]) -> None:
    """Fail if one of the named checks has violations, or there were no rows at all.

    A report has one row per check, whatever the size of the data behind it.
    """
    rows = report.filter(F.col("check_name").isin(checks)).collect()
    failed = [f"{r['check_name']}: {r['n_violations']} of {r['n_rows']}" for r in rows if r["n_violations"] or not r["n_rows"]]
    if failed:
        raise ValueError("quality checks failed: " + "; ".join(failed))


def _serve(df: DataFrame, out: str, table: str, run: Run, keys: list[str], agg: str | None = None) -> None:
    op.serving_json(df, table, run, keys, agg).write.mode("overwrite").parquet(f"{out}/gold/cache/{table}")


def _landed(spark: SparkSession, landing: str | list[str]) -> DataFrame:
    """path of every file below ``landing``, by listing only."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path")


def financial_statements(
    spark: SparkSession, landing: str | list[str], out: str, run: Run, schema: str = sc.STATEMENT_SCHEMA,
    issuers: DataFrame | None = None, as_of: int | None = None, years_back: int = 2,
) -> DataFrame:
    """Quarterly and annual statement files -> enriched silver rows -> ``financials_quarterly``.

    A run covers the files it reads, for the issuers it names or all. In silver, which keeps rows by source
    file, it replaces what it covers and leaves the rest; gold, whose years are those of the reference date, is then
    rebuilt from all of silver for the aggregation types and years that the files have rows of, before or after.
    Runs over subsets of issuers or over new files only thus end where one run over everything does.
    """

    rows = src.with_path(src.read_delimited(spark, landing, schema))
    # By the path that rows carry too: the reader of whole files writes some characters otherwise.
    tagged = src.tag_origin_file(src.tag_files(src.with_path(_landed(spark, landing)).drop("path")))
    if as_of is not None:
        tagged = op.filter_years(tagged, as_of, years_back, year="file_year", form="ORIGIN_FILE")
    tagged = op.split_by_aggregation(tagged).withColumn("source_file", F.substring_index("source_path", "/", -1))
    # One row per file, as the scan's own listing has: a path is read once per file, not once per row. As plain values,
    # since Spark would otherwise infer the filters on the path for the rows as well.
    files = F.broadcast(spark.createDataFrame(tagged.distinct().collect(), tagged.schema))
    if issuers is not None:
        rows = op.filter_issuer(rows, issuers)
    cleaned = op.parse_statement_dates(op.filter_last_exercise(rows).join(files, "source_path"))
    enriched = op.enrich(op.scale_amounts(cleaned), run).drop("source_path")
    silver, table = f"{out}/silver/enriched/statements", f"{out}/gold/serving/financials_quarterly"
    stored = op.table_or_empty(spark, silver, enriched.schema, own=True)
    before = stored.join(files, "source_file", "left_semi")
    merged, parts = enriched, ["enr_aggregation_type", "source_file"]
    if issuers is not None:
        others = before.join(issuers.select(F.col("issuer_cnpj").alias("CNPJ_CIA")), "CNPJ_CIA", "left_anti")
        # What was stored is laid out anew, so that its files do not pile up over the runs.
        merged = enriched.unionByName(others.hint("rebalance", *parts))
    staged = op.stage_gold(merged, silver, parts, as_read=True)
    now = spark.read.schema(enriched.schema).parquet(staged)
    require(op.quality_report(now, {"issuer_missing": F.col("CNPJ_CIA").isNull()}), ["issuer_missing"])
    years = ["enr_aggregation_type", F.year("DT_REFER").alias("ref_year")]
    # As many rows as aggregation types have years.
    touched = {tuple(r) for part in (before, now) for r in part.select(*years).distinct().collect() if r[1] is not None}
    changed = F.broadcast(spark.createDataFrame(sorted(touched), "enr_aggregation_type string, ref_year int"))
    keys = changed.columns
    op.switch_gold(spark, silver, staged, before.select(*parts))

    stored = op.table_or_empty(spark, silver, enriched.schema, own=True).withColumn("ref_year", F.year("DT_REFER"))
    rebuilt = op.financials_quarterly(stored.join(changed, keys, "left_semi"))
    in_gold = T.StructType([*rebuilt.schema.fields, T.StructField("ref_year", T.IntegerType())])
    outdated = op.table_or_empty(spark, table, in_gold, own=True).join(changed, keys, "left_semi")
    op.write_gold(rebuilt.withColumn("ref_year", F.col("year")), table, keys, clear=outdated.select(*keys))
    gold = spark.read.parquet(table).select("enr_aggregation_type", *sc.FINANCIALS_COLUMNS)
    op.export_sheets(gold, f"{out}/gold/export/financials_quarterly")
    _serve(gold, out, "financials_quarterly", run, ["issuer_cnpj", "date"], "enr_aggregation_type")
    return gold


def _publish(
    df: DataFrame, out: str, table: str, run: Run, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    path = f"{out}/gold/serving/{table}"
    op.write_gold(df.withColumn("snapshot_date", F.lit(run["ref_date"])), path, ["snapshot_date"], order)
    gold = df.sparkSession.read.parquet(path).filter(F.col("snapshot_date") == run["ref_date"]).drop("snapshot_date")
    gold.write.mode("overwrite").option("header", True).csv(f"{out}/gold/export/{table}")
    _serve(gold, out, table, run, keys)
    return gold


def _known(spark: SparkSession, replies: str, raw: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of replies that have content, and (source_path, n_rows) of the others, files without a row included."""
    paths = _landed(spark, replies).withColumnRenamed("path", "source_path")
    counted = raw.groupBy("source_path").agg(F.count(F.lit(1)).alias("n_rows"))
    empty = paths.join(counted, "source_path", "left_anti").select("source_path", F.lit(0).cast("bigint").alias("n_rows"))
    dropped = op.reply_not_found(raw, "source_path", required).unionByName(empty)
    return raw.join(dropped.select("source_path"), "source_path", "left_anti"), dropped


def events_schedule(
    spark: SparkSession, replies: str, skip: int, out: str, run: Run, encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame]:
    """Event schedule replies -> ``debentures_financial_events_schedule`` in payment order, and the replies
    without an event."""
    raw = src.read_preamble_tsv(
        spark, replies, skip, sc.EVENTS_SCHEDULE_SOURCE, encoding=encoding, names=sc.EVENTS_SCHEDULE_COLUMNS
    )
    known, dropped = _known(spark, replies, raw, ["event_date", "asset_code"])
    gold = _publish(
        op.clean_events(known), out, "debentures_financial_events_schedule", run, ["asset_code", "event_date", "event"],
        op.SCHEDULE_ORDER,
    )
    return gold, dropped


def debenture_terms(
    spark: SparkSession, layouts: list[tuple[str, list[str]]], skip: int, out: str, run: Run, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Terms replies -> ``debentures_terms``; one (folder, columns) entry per source layout, not per asset."""
    parts = []
    for path, columns in layouts:
        raw = src.read_preamble_tsv(spark, path, skip, columns, encoding=encoding).drop("line_no")
        # A reply holds one asset, so the file is the group in which the coupon falls back.
        parts.append(op.terms_gold(raw, key="source_path").drop("source_path"))
    return _publish(op.union_ragged(*parts), out, "debentures_terms", run, ["enr_codigo_do_ativo"])


def traded_prices(
    spark: SparkSession, replies: str, skip: int, listing: DataFrame, out: str, run: Run, encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Price replies -> ``debentures_secondary_market_traded_prices``, the listed assets without a price, and the
    replies without one."""
    raw = src.read_preamble_tsv(spark, replies, skip, sc.TRADED_PRICES_SOURCE, encoding=encoding, names=sc.TRADED_PRICES_COLUMNS)
    known, dropped = _known(spark, replies, raw, ["ref_date", "asset_code"])
    table = "debentures_secondary_market_traded_prices"
    gold = _publish(op.traded_prices(known.drop("source_path", "line_no")), out, table, run, ["asset_code", "ref_date"])
    return gold, op.uncovered_assets(listing, gold), dropped


def macro_data(spark: SparkSession, bodies: str, out: str, run: Run) -> DataFrame:
    """JSON replies, one per file -> ``macro_data``."""
    body = spark.read.text(bodies, wholetext=True, recursiveFileLookup=True).select(F.col("value").alias("body"))
    return _publish(src.macro_gold(src.parse_macro(body)), out, "macro_data", run, ["security_id", "ref_date"])


def filings_manifest(
    spark: SparkSession, landing: str, schema: str, issuers: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Periodic-filing lists -> what to fetch and where it lands, and the categories an issuer lacks."""
    rows = src.read_delimited(spark, landing, schema).withColumnsRenamed(
        {"CNPJ_Companhia": "issuer_cnpj", "Categoria": "category", "Versao": "version", "Data_Referencia": "ref_date",
         "Link_Download": "url"}
    )
    if issuers is not None:
        rows = op.filter_issuer(rows, issuers, col="issuer_cnpj")
    return src.manifest(rows), op.missing_categories(rows, list(sc.FILING_CATEGORIES))


def latest_reference_forms(spark: SparkSession, landing: str, schema: str, tiebreak: str) -> DataFrame:
    """Reference-form lists -> the form received last per issuer, dates read strictly."""
    rows = src.read_delimited(spark, landing, schema)
    dated = rows.withColumns({c: date_strict(F.col(c)) for c in ("DT_RECEB", "DT_REFER")})
    return op.latest_filing(dated, issuer="CNPJ_CIA", receipt="DT_RECEB", tiebreak=tiebreak)


def index_documents(
    docs: DataFrame, meta: DataFrame, stored: DataFrame, force: bool = False, unit: str = "line"
) -> DataFrame:
    """Chunk records of documents that are not completely indexed yet.

    ``docs`` is (object_path, text), ``stored`` the index table; the result is what to upsert.
    """
    lineage = ["ingest_ts", "source", "file_hash", "trace_id", "document_type", "ref_date", "aggregation_type"]
    kept = stored.groupBy(F.col("doc_id").alias("object_path")).agg(F.count(F.lit(1)).alias("_stored"))
    about = meta.select("object_path", *lineage).join(kept, "object_path", "left")
    # Documents meet what is known of them once, before they are chunked, and are chunked once.
    chunks = op.chunk_naive(docs.select("object_path", "text").join(about, "object_path", "left"), unit=unit, count="_n")
    return op.chunk_rows(chunks.filter(F.lit(force) | F.col("_stored").isNull() | (F.col("_n") != F.col("_stored"))))
