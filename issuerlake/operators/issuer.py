"""Issuer lookup: resolve requests, rank legal risks, assemble profiles, attach metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.clean import map_labels
from issuerlake.operators.catalog import latest_documents
from issuerlake.operators.common import first_per_group, spread_nulls, top_per_group
from issuerlake.operators.debentures import upcoming_payments
from issuerlake.schemas import RISK_LEVELS


def claimed_amount(c: Column) -> Column:
    """Leading number of a claimed value as a decimal; text without one is null."""
    number = F.regexp_extract(F.trim(c.cast("string")), r"^[+-]?\d+(\.\d+)?", 0)
    return number.try_cast("decimal(20,2)")


def risk_level(c: Column) -> Column:
    return map_labels(c, RISK_LEVELS)


def risk_exposure(cases: DataFrame, levels: tuple[str, ...] = ("high", "medium")) -> DataFrame:
    """Claimed total and number of cases per issuer over the given levels; unreadable values count as 0."""
    return (
        cases.filter(risk_level(F.col("risk")).isin(list(levels)))
        .groupBy("issuer_cnpj")
        .agg(
            F.count(F.lit(1)).alias("n_cases"),
            F.coalesce(F.sum(claimed_amount(F.col("claimed_value"))), F.lit(0)).cast("double").alias("exposure"),
        )
    )


def key_legal_risks(cases: DataFrame, levels: tuple[str, ...] = ("high", "medium"), k: int = 10) -> DataFrame:
    """The ``k`` gravest cases per issuer: severity, then claimed value, then case id."""
    graded = cases.withColumn("risk_level", risk_level(F.col("risk"))).filter(F.col("risk_level").isin(list(levels)))
    severity = F.array_position(F.array(*[F.lit(x) for x in levels]), F.col("risk_level"))
    amount = claimed_amount(F.col("claimed_value"))
    return top_per_group(
        graded.withColumns({"_severity": severity, "claimed_amount": amount}),
        ["issuer_cnpj"],
        [F.asc("_severity"), F.desc_nulls_last("claimed_amount"), F.asc("case_id")],
        k,
    ).drop("_severity")


def resolve_issuer(requests: DataFrame, issuers: DataFrame, listing: DataFrame) -> DataFrame:
    """Issuer of each request: by ticker, else by tax id, else by name.

    Lookups are made unique per key and joined with the issuers first, so that a request takes part
    in three equi-joins and is never multiplied. Of rows that repeat a tax id the first name counts.
    Null keys are spread so that they do not share a partition.
    """
    dim = first_per_group(
        issuers.filter(F.col("issuer_cnpj").isNotNull()), ["issuer_cnpj"], [F.asc_nulls_last("issuer_name"), F.asc_nulls_last("industry")]
    ).select(F.col("issuer_cnpj").alias("_id"), F.col("issuer_name").alias("_name"), F.col("industry").alias("_industry"))
    by_ticker = first_per_group(listing.select("asset_code", "issuer"), ["asset_code"], [F.asc("issuer")])
    by_name = first_per_group(issuers.select("issuer_name", "issuer_cnpj"), ["issuer_name"], [F.asc("issuer_cnpj")])
    rid = F.col("request_id")

    def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
        side = df.select(F.col(key).alias("_k"), F.col(value).alias("_v")).filter(F.col("_k").isNotNull())
        found = F.struct(F.col("_v").alias("cnpj"), F.col("_name").alias("name"), F.col("_industry").alias("industry"))
        return side.join(dim, side["_v"] == dim["_id"], "left").select("_k", F.when(F.col("_v").isNotNull(), found).alias("_found"))

    def attach(df: DataFrame, key: str, side: DataFrame, out: str) -> DataFrame:
        keyed = df.withColumn("_k", spread_nulls(F.col(key), rid))
        return keyed.join(side, "_k", "left").withColumnRenamed("_found", out).drop("_k")

    known = F.struct(F.col("_id").alias("cnpj"), F.col("_name").alias("name"), F.col("_industry").alias("industry"))
    found = attach(requests, "ticker", lookup(by_ticker, "asset_code", "issuer"), "_by_ticker")
    found = attach(found, "issuer_cnpj", dim.select(F.col("_id").alias("_k"), known.alias("_found")), "_by_cnpj")
    found = attach(found, "issuer_name", lookup(by_name, "issuer_name", "issuer_cnpj"), "_by_name")
    resolved = found.withColumn("_r", F.coalesce("_by_ticker", "_by_cnpj", "_by_name"))
    no_key = F.col("ticker").isNull() & F.col("issuer_cnpj").isNull() & F.col("issuer_name").isNull()
    na = F.lit("N/A")
    return resolved.select(
        "request_id",
        F.when(no_key, "INVALID_INPUT").when(F.col("_r").isNull(), "NOT_FOUND").otherwise("OK").alias("status"),
        F.coalesce("_r.cnpj", na).alias("resolved_cnpj"),
        F.coalesce("_r.name", na).alias("resolved_name"),
        F.coalesce("_r.industry", na).alias("resolved_industry"),
        F.when(F.col("_by_ticker").isNotNull(), F.col("ticker")).otherwise(na).alias("resolved_ticker"),
    )


def _ranked_list(df: DataFrame, key: str, fields: dict[str, Column], out: str) -> DataFrame:
    """One row per key with its ranked rows as an array of structs; the input has at most k rows per key."""
    item = F.struct("rank", F.struct(*[c.alias(n) for n, c in fields.items()]).alias("item"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    return df.groupBy(F.col(key).alias("issuer_cnpj")).agg(ordered.alias(out))


def _optional(df: DataFrame, names: list[str], kind: str = "string") -> Column:
    """The first of the columns that the table has, else null."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast(kind))


def issuer_profile(
    issuers: DataFrame, documents: DataFrame, cases: DataFrame, events: DataFrame, from_date: str,
    document_k: int = 5, risk_k: int = 10, payment_k: int = 10, listing: DataFrame | None = None,
) -> DataFrame:
    """Latest documents, gravest cases and next payments of every issuer, with counts and exposure.

    Summaries, case type, impact, amount and status come from columns of the tables that have them; a
    payment without a status is scheduled. The ticker is the first listed code of the issuer.

    Counts and exposure cover the listed rows, as in the response this reproduces; ``risk_exposure``
    gives the totals. Each branch has one row per issuer before the joins.
    """
    docs = _ranked_list(
        latest_documents(documents, document_k),
        "issuer_cnpj",
        {
            "document_type": F.col("document_type"),
            "title": F.col("title"),
            "date": F.col("ref_date"),
            "source": F.col("source"),
            "url": F.coalesce(_optional(documents, ["document_url"]), F.col("object_path")),
            "summary": _optional(documents, ["summary"]),
        },
        "latest_documents",
    )
    risks = _ranked_list(
        key_legal_risks(cases, k=risk_k),
        "issuer_cnpj",
        {
            "case_id": F.col("case_id"),
            "court": F.col("court"),
            "case_type": _optional(cases, ["case_type"]),
            "risk_level": F.col("risk_level"),
            "claimed_value": F.col("claimed_amount"),
            "stage": F.col("stage"),
            "summary": _optional(cases, ["enr_principais_fatos"]),
            "impact": _optional(cases, ["enr_impacto_em_caso_de_perda"]),
            "last_update": F.col("last_movement_date"),
        },
        "key_legal_risks",
    )
    payments = _ranked_list(
        upcoming_payments(events, from_date, payment_k),
        "issuer",
        {
            "debenture_ticker": F.col("asset_code"),
            "event_type": F.col("event"),
            "payment_date": F.col("payment_date"),
            "amount": _optional(events, ["amount"], "decimal(18,2)"),
            "interest_rate": F.col("rate_or_percent"),
            "status": F.coalesce(_optional(events, ["status"]), F.lit("scheduled")),
        },
        "upcoming_payments",
    )
    joined = issuers
    sides = [docs, risks, payments]
    if listing is not None:
        sides.append(listing.groupBy(F.col("issuer").alias("issuer_cnpj")).agg(F.min("asset_code").alias("_ticker")))
    for side in sides:
        joined = joined.join(side, "issuer_cnpj", "left")

    def count(c: str) -> Column:
        return F.coalesce(F.array_size(c), F.lit(0)).cast("bigint")

    exposure = F.aggregate(
        F.coalesce(F.col("key_legal_risks"), F.array().cast(risks.schema["key_legal_risks"].dataType)),
        F.lit(0).cast("decimal(24,2)"),
        lambda acc, r: (acc + F.coalesce(r["claimed_value"], F.lit(0))).cast("decimal(24,2)"),
    )
    return joined.select(
        "issuer_cnpj",
        F.coalesce("issuer_name", F.lit("N/A")).alias("issuer_name"),
        F.coalesce(_optional(joined, ["_ticker", "ticker"]), F.lit("N/A")).alias("ticker"),
        F.coalesce("industry", F.lit("N/A")).alias("industry"),
        count("latest_documents").alias("total_documents"),
        count("key_legal_risks").alias("total_legal_risks"),
        exposure.cast("double").alias("total_risk_exposure"),
        count("upcoming_payments").alias("total_upcoming_payments"),
        "latest_documents",
        "key_legal_risks",
        "upcoming_payments",
    )


def attach_metadata(docs: DataFrame, catalog: DataFrame, issuers: DataFrame) -> DataFrame:
    """Documents with the JSON metadata their index entry carries; absent fields are left out of it."""
    meta = catalog.select("object_path", "source", "document_type", "file_hash", "aggregation_type")
    company = issuers.select("issuer_cnpj", "issuer_name")
    agg = F.nullif(F.col("aggregation_type"), F.lit(""))
    return (
        docs.select("doc_id", "object_path", "issuer_cnpj")
        .join(meta, "object_path", "left")
        .join(company, "issuer_cnpj", "left")
        .select(
            "doc_id",
            "object_path",
            F.to_json(
                F.struct(
                    F.col("issuer_name").alias("empresa"),
                    F.col("issuer_cnpj").alias("CNPJ"),
                    F.col("source").alias("origem"),
                    F.col("document_type").alias("tipo_documento"),
                    "file_hash",
                    agg.alias("tipo_agregacao_demonstrativo_financeiro"),
                )
            ).alias("meta_fields"),
        )
    )
