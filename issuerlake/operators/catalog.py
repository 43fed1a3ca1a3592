"""Object catalog: lineage rows, duplicate content, freshness, latest rows and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.operators.common import first_per_group, same_keys, top_per_group


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def catalog_rows(
    files: DataFrame, run: dict[str, str], content: str = "content", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One lineage row per object; the content is replaced by its SHA-256, further columns on request."""
    return files.select(
        *keep,
        "object_path",
        parent_folder(F.col("object_path")).alias("folder"),
        F.sha2(F.col(content).cast("binary"), 256).alias("file_hash"),
        F.lit(run["ingest_ts"]).alias("ingest_ts"),
        F.lit(run["trace_id"]).alias("trace_id"),
        *[
            F.coalesce(F.col(c), F.lit("")).alias(c) if c in files.columns else F.lit("").alias(c)
            for c in ("source", "document_type", "ref_date", "aggregation_type")
        ],
    )


def metadata_map(rows: DataFrame, columns: list[str], name: str = "metadata") -> DataFrame:
    """The columns as one map of strings, as object stores keep metadata; nulls and empty texts are no entry."""
    entry = lambda c: F.struct(F.lit(c).alias("key"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("value"))
    entries = F.filter(F.array(*[entry(c) for c in columns]), lambda e: e["value"].isNotNull())
    return rows.withColumn(name, F.map_from_entries(entries)).select(*[c for c in rows.columns if c not in columns], name)


def metadata_columns(rows: DataFrame, schema: dict[str, str], name: str = "metadata") -> DataFrame:
    """The entries of a map of strings as columns of the given types; without an entry, or one of another type, null. The rest of
    the entries stays in the map."""
    known = F.array(*[F.lit(c) for c in schema])
    rest = F.map_filter(name, lambda k, _: ~F.array_contains(known, k))
    typed = [F.try_element_at(F.col(name), F.lit(c)).try_cast(t).alias(c) for c, t in schema.items()]
    return rows.select(*[c for c in rows.columns if c != name], *typed, rest.alias(name))


def freshness_gate(available: DataFrame, landed: DataFrame, keys=("document_type", "file_year", "last_update")) -> DataFrame:
    """Offered items that have not landed yet, item by item."""
    return available.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def dedup_content(
    incoming: DataFrame, catalog: DataFrame, order: list[Column], scope: str = "folder", hash_col: str = "file_hash"
) -> DataFrame:
    """Objects whose content is not yet in their scope; among incoming copies the first in ``order`` wins.

    Copies collapse before the shuffle (a group limit of one row per task), so a content that makes
    up much of the input costs no more than any other. The catalog side is distinct before it moves.
    Objects without content are copies of each other.
    """
    keys = [scope, hash_col]
    firsts = first_per_group(incoming, keys, order)
    known = catalog.select(*keys).distinct()
    return firsts.alias("f").join(known.alias("k"), same_keys("f", "k", keys), "left_anti")


def find_documents(documents: DataFrame, catalog: DataFrame, keyword: str, name: str = "object_path") -> DataFrame:
    """Documents whose name contains the keyword, with their content hash or null."""
    hits = documents.filter(F.contains(F.lower(F.col(name)), F.lit(keyword.lower()))).select(name)
    return hits.join(catalog.select(name, "file_hash"), name, "left")


def latest_filing(df: DataFrame, issuer: str = "issuer_cnpj", receipt: str = "receipt_date", tiebreak: str = "doc_id") -> DataFrame:
    """The row received last per issuer; rows without a date are skipped, the first row wins ties."""
    return first_per_group(df.filter(F.col(receipt).isNotNull()), [issuer], [F.desc(receipt), F.asc(tiebreak)])


def latest_documents(catalog: DataFrame, k: int = 5, issuer: str = "issuer_cnpj") -> DataFrame:
    return top_per_group(catalog, [issuer], [F.desc("ref_date"), F.asc("doc_id")], k)


def ingest_digest(catalog: DataFrame, day: str = "ref_date") -> DataFrame:
    """Per run day, document type and source: documents, distinct titles; and the day's totals and sources.

    Everything after the first aggregation works on its small result.
    """
    per_title = catalog.groupBy(day, "document_type", "source", "title").agg(F.count(F.lit(1)).alias("_n"))
    groups = per_title.groupBy(day, "document_type", "source").agg(
        F.sum("_n").alias("n_documents"), F.count("title").alias("n_titles")
    )
    days = groups.groupBy(day).agg(
        F.sum("n_documents").alias("day_documents"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("day_sources"),
    )
    return groups.join(days, day)


def digest_listing(catalog: DataFrame, day: str = "ref_date") -> DataFrame:
    """The digest's document list, one row per day, type, title and location, in reading order."""
    cols = [day, "document_type", "title", "object_path"]
    return catalog.select(*cols).orderBy(*cols)
