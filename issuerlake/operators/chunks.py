"""Chunking, chunk records, vector checks, and loading chunks into an index table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.clean import n_words, words
from issuerlake.operators.common import first_per_group, unnest
from issuerlake.schemas import CHUNK_OVERLAP, CHUNK_TOKENS

# How a text falls into pieces.
PIECE_SPLIT = {"line": r"\n", "sentence": r"(?<=[.!?])\s+", "paragraph": r"\n(?:[ \t\r]*\n)+"}
PIECE_JOIN = {"line": "\n", "sentence": " ", "paragraph": "\n\n"}


def chunk_naive(
    docs: DataFrame, limit: int = CHUNK_TOKENS, unit: str = "line", text: str = "text", count: str | None = None
) -> DataFrame:
    """Pieces packed in order into chunks of at most ``limit`` words; a longer piece stands alone.

    Packing is sequential within a document, so it is a fold over the document's pieces inside its
    row: no shuffle, parallel over documents. The fold carries only the first piece of each chunk,
    and pieces without words belong to the chunk they follow. Documents without words give no chunk.
    ``count`` names a column for the number of chunks of the document.
    """
    keep = [c for c in docs.columns if c != text]
    pieces = F.split(F.coalesce(F.col(text), F.lit("")), PIECE_SPLIT[unit])
    sized = docs.select(*keep, pieces.alias("_p")).select(
        *keep, "_p", F.transform("_p", lambda p: n_words(p)).alias("_n")
    )
    start = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"), F.lit(0).alias("used"))

    def step(acc: Column, n: Column) -> Column:
        opens = (n > 0) & ((F.size(acc["starts"]) == 0) | (acc["used"] + n > limit))
        return F.struct(
            F.when(opens, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            (acc["i"] + 1).alias("i"),
            F.when(opens, n).otherwise(acc["used"] + n).alias("used"),
        )

    packed = sized.select(
        *keep, "_p", "_n", F.aggregate("_n", start, step, lambda acc: acc["starts"]).alias("_starts")
    )

    def chunk(start: Column, i: Column) -> Column:
        size = F.coalesce(F.get("_starts", i + 1), F.size("_p")) - start
        return F.struct(
            F.array_join(F.slice("_p", start + 1, size), PIECE_JOIN[unit]).alias("text"),
            F.aggregate(F.slice("_n", start + 1, size), F.lit(0), lambda a, n: a + n).alias("tokens"),
        )

    # Chunks are finished inside the document's row; nothing of the document's size is copied to them.
    made = packed.select(*keep, F.transform("_starts", chunk).alias("_chunks"))
    if count:
        keep = [*keep, count]
        made = made.withColumn(count, F.size("_chunks"))
    return unnest(made, keep, F.col("_chunks"), "_c", "chunk_no").select(*keep, "chunk_no", "_c.text", "_c.tokens")


def chunk_overlap(
    docs: DataFrame, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP, text: str = "text"
) -> DataFrame:
    """Windows of ``size`` words starting every ``size - overlap`` words, until one reaches the end."""
    keep = [c for c in docs.columns if c != text]
    step = size - overlap
    n = F.size("_w")
    last = F.greatest(F.ceil((n - overlap) / step) - 1, F.lit(0)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), last))
    windows = unnest(
        docs.select(*keep, words(F.col(text)).alias("_w")), [*keep, "_w"], starts, "chunk_no"
    ).select(*keep, "chunk_no", F.slice("_w", F.col("chunk_no") * step + 1, size).alias("_w"))
    return windows.select(*keep, "chunk_no", F.array_join("_w", " ").alias("text"), n.alias("tokens"))


def chunk_rows(chunks: DataFrame, meta: DataFrame | None = None, key: str = "object_path") -> DataFrame:
    """Index records: id ``path#chunk_i``, the first 512 characters as exact-match text, lineage of the object.

    The chunkers keep the other columns of a document, so lineage that is there already needs no
    join and no text is shuffled; ``meta`` joins it in where it is not. Reading confidence and method,
    pages and embedding come from columns of these names, and are null where the chunks have none.
    """
    optional = {"confidence": "float", "read_method": "string", "page_start": "int", "page_end": "int", "embedding": "array<float>"}
    own = {n: (F.col(n).cast(t) if n in chunks.columns else F.lit(None).cast(t)).alias(n) for n, t in optional.items()}
    lineage = ["ingest_ts", "source", "file_hash", "trace_id", "document_type", "ref_date", "aggregation_type"]
    if meta is not None:
        present = [n for n in optional if n in chunks.columns]
        chunks = chunks.select(key, "chunk_no", "text", "tokens", *present).join(meta.select(key, *lineage), key, "left")
    return chunks.select(
        F.col(key).alias("doc_id"),
        F.concat(F.col(key), F.lit("#chunk_"), F.col("chunk_no").cast("string")).alias("chunk_id"),
        own["confidence"],
        own["read_method"],
        "text",
        F.substring("text", 1, 512).alias("text_raw"),
        own["page_start"],
        own["page_end"],
        "tokens",
        F.col("ingest_ts").alias("ingestion_ts"),
        *lineage[1:-1],
        F.coalesce("aggregation_type", F.lit("")).alias("aggregation_type"),
        own["embedding"],
    )


def check_dimension(vectors: DataFrame, dim: int, col: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Vectors whose length is not the index dimension; a missing vector counts as length 0."""
    size = F.coalesce(F.array_size(col), F.lit(0))
    return vectors.select(key, size.alias("dimension")).filter(F.col("dimension") != dim)


def index_completeness(chunks: DataFrame, stored: DataFrame, force: bool = False, key: str = "doc_id") -> DataFrame:
    """Per document, chunks made and chunks stored; complete documents are skipped unless forced."""
    made = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks"))
    kept = stored.groupBy(key).agg(F.count(F.lit(1)).alias("n_stored"))
    n_stored = F.coalesce("n_stored", F.lit(0).cast("bigint"))
    skip = (F.col("n_chunks") == n_stored) & F.lit(not force)
    return made.join(kept, key, "left").select(key, "n_chunks", n_stored.alias("n_stored"), skip.alias("skip"))


def upsert_chunks(stored: DataFrame, incoming: DataFrame, version: str = "version") -> DataFrame:
    """The newest record of every chunk id; ties between equal versions go to the incoming side.

    ``stored`` is an index table, unique by chunk id. It is only compared with the ids of the incoming
    records, so against a small batch its texts stay where they are.
    """
    newest = first_per_group(incoming, ["chunk_id"], [F.desc(version)])
    new_ids = newest.select(F.col("chunk_id").alias("_id"), F.col(version).alias("_v"))
    old_ids = stored.select(F.col("chunk_id").alias("_id"), F.col(version).alias("_v"))
    same = F.col("chunk_id") == F.col("_id")
    kept = stored.join(new_ids, same & (F.col("_v") >= F.col(version)), "left_anti")
    written = newest.join(old_ids, same & (F.col("_v") > F.col(version)), "left_anti")
    return kept.unionByName(written)
