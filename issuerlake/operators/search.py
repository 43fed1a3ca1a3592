"""Exact vector search, BM25, hybrid ranking and query expansion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.functions.clean import collapse_ws, tokens
from issuerlake.operators.blocks import HITS, SCORE_DIGITS, keyword_scorer, matrix, term_counter, unit_rows, vector_scorer
from issuerlake.operators.common import first_per_group, top_per_group, unnest
from issuerlake.schemas import (
    EXACT_MATCH_BOOST, KEYWORD_WEIGHT, RERANK_TOP_K, RETRIEVAL_TOP_K, SIMILARITY_THRESHOLD, SYNONYMS, VECTOR_WEIGHT,
)
from issuerlake.session import shared_dir

K1, B = 1.2, 0.75
# Queries, and distinct terms of queries, that a pass over the corpus serves. Results do not depend on them.
BLOCK_QUERIES, BLOCK_TERMS = 4_096, 5_000
TERM_BYTES = 8 << 20


def _union(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, parts) if parts else empty.sparkSession.createDataFrame([], HITS)


def knn_cosine(
    queries: DataFrame, corpus: DataFrame, k: int = RETRIEVAL_TOP_K, filters: dict[str, str] | None = None,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Exact top-k by cosine per query: (query_id, doc_id, score, rank).

    ``queries`` is (query_id bigint, vector), ``corpus`` is (doc_id bigint, vector, ...); ``filters``
    are equality filters on corpus columns, applied at the scan. Every row of the corpus is a hit of its
    own, also where its doc_id repeats. Vectors that are null or hold null, NaN or infinite elements are
    left out on both sides; a zero vector scores 0.

    Queries are streamed in blocks of limited size, and every block meets the whole corpus where it lies: a
    task computes all scores as matrix products and emits its k best of each query.
    """
    for c, v in (filters or {}).items():
        corpus = corpus.filter(F.col(c) == v)
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    docs = corpus.select(F.col("doc_id").cast("bigint"), "vector").filter(F.col("vector").isNotNull() & finite)
    wanted = queries.select(F.col("query_id").cast("bigint"), "vector").filter(F.col("vector").isNotNull() & finite)
    rows = wanted.toLocalIterator()
    partial = []
    while block := list(islice(rows, block_queries)):
        units = unit_rows(matrix(pa.array([r["vector"] for r in block])))
        shared = docs.sparkSession.sparkContext.broadcast((np.array([r["query_id"] for r in block], dtype=np.int64), units))
        partial.append(docs.mapInArrow(vector_scorer(shared, k), HITS))
    return top_per_group(_union(partial, docs), ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def query_terms(queries: DataFrame, text: str = "q") -> DataFrame:
    """Distinct terms of each query."""
    return unnest(queries, ["query_id"], F.array_distinct(tokens(F.col(text))), "term").drop("_pos")


def _term_blocks(terms: DataFrame, queries: int, size: int) -> Iterator[list[tuple[int, list[str]]]]:
    """(query, its terms) in blocks of limited size; a longer query stands alone."""
    grouped = terms.groupBy("query_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    block, seen = [], set()
    for q, ts in grouped.orderBy("query_id").toLocalIterator():
        if block and (len(block) == queries or len(seen.union(ts)) > size):
            yield block
            block, seen = [], set()
        block.append((q, ts))
        seen.update(ts)
    if block:
        yield block


def bm25_topk(
    queries: DataFrame, corpus: DataFrame, k: int = RETRIEVAL_TOP_K, filters: dict[str, str] | None = None,
    block_queries: int = BLOCK_QUERIES, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Top-k by BM25 per query: (query_id, doc_id, score, rank); documents without a query term are no hits.

    ``queries`` is (query_id, term) from ``query_terms`` or ``expand_query``, ``corpus`` is
    (doc_id bigint, text, ...). Document count and mean length are over the filtered corpus, empty
    documents included. Every row is a document and a hit of its own, also where its doc_id repeats.

    Texts are cut into terms once, into a table of the shared folder. Queries are streamed in blocks of limited
    size. A block's terms are all that leaves the scan of a document; one pass counts document frequencies, a
    second scores the terms that occur and keeps each task's k best. Nothing of the corpus is shuffled.
    Statistics are those of the corpus when called.
    """
    for c, v in (filters or {}).items():
        corpus = corpus.filter(F.col(c) == v)
    path = shared_dir(corpus.sparkSession, "terms")
    cut = corpus.select(F.col("doc_id").cast("bigint"), tokens(F.coalesce(F.col("text"), F.lit(""))).alias("terms"))
    # Small row groups let the passes over one large text file run in several tasks.
    cut.select("doc_id", F.size("terms").alias("len"), "terms").write.option("parquet.block.size", TERM_BYTES).parquet(path)
    docs = corpus.sparkSession.read.parquet(path)
    n_docs, mean = docs.agg(F.count(F.lit(1)), F.avg("len")).first()
    context = docs.sparkSession.sparkContext
    partial = []
    for block in _term_blocks(queries.select(F.col("query_id").cast("bigint"), "term").distinct(), block_queries, block_terms):
        words = sorted({t for _, ts in block for t in ts})
        place = {w: i for i, w in enumerate(words)}
        known = docs.select("doc_id", "len", F.filter("terms", lambda t: t.isin(words)).alias("terms"))
        vocabulary = context.broadcast(pa.array(words, pa.string()))
        counted = known.select("terms").mapInArrow(term_counter(vocabulary), "slot bigint, n bigint")
        df = np.zeros(len(words))
        for r in counted.groupBy("slot").agg(F.sum("n").alias("n")).collect():  # one row per term of the block
            df[r["slot"]] = r["n"]
        idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        pairs = np.array([(place[t], i) for i, (_, ts) in enumerate(block) for t in ts], dtype=np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        starts = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
        ids = np.array([q for q, _ in block], dtype=np.int64)
        shared = context.broadcast((ids, pa.array(words, pa.string()), starts, pairs[:, 1], idf[pairs[:, 0]]))
        partial.append(known.mapInArrow(keyword_scorer(shared, k, K1, B, mean or 1.0), HITS))
    return top_per_group(_union(partial, docs), ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def _per_document(hits: DataFrame) -> DataFrame:
    """Of the hits of a query on rows with one doc_id, the best."""
    return first_per_group(hits, ["query_id", "doc_id"], [F.asc("rank")])


def _fuse(
    queries: DataFrame, vectors: DataFrame, texts: DataFrame, retrieval_k: int, filters: dict[str, str] | None = None
) -> DataFrame:
    """Candidates of both rankings with cosine and normalized, phrase-boosted keyword score.

    A doc_id that repeats is one candidate with its best row in each ranking, and boosted if any of its rows holds the phrase.
    """
    keyword_hits = _per_document(bm25_topk(query_terms(queries), texts, retrieval_k, filters))
    # At most k hits per query.
    best = F.max("score").over(Window.partitionBy("query_id"))
    keyword = keyword_hits.select(
        "query_id", "doc_id", (F.col("score") / best).alias("keyword"), F.col("rank").alias("keyword_rank")
    )
    vector = _per_document(knn_cosine(queries, vectors, retrieval_k, filters)).select(
        "query_id", "doc_id", F.col("score").alias("cosine"), F.col("rank").alias("vector_rank")
    )
    candidates = vector.join(keyword, ["query_id", "doc_id"], "full_outer")
    # Only texts of keyword hits can be boosted: at most k per query, so their ids filter the texts
    # before anything of the corpus moves.
    ids = keyword_hits.select("doc_id").distinct()
    hit_texts = texts.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    phrase = F.nullif(collapse_ws(F.lower("q")), F.lit(""))
    boosted = (
        keyword_hits.select("query_id", "doc_id")
        .join(hit_texts, "doc_id")
        .join(queries.select("query_id", phrase.alias("_phrase")), "query_id")
        .filter(F.contains(collapse_ws(F.lower("text")), F.col("_phrase")))
        .select("query_id", "doc_id", F.lit(EXACT_MATCH_BOOST).alias("_boost"))
        .distinct()
    )
    zero, one = F.lit(0.0), F.lit(1.0)
    return candidates.join(boosted, ["query_id", "doc_id"], "left").select(
        "query_id",
        "doc_id",
        F.coalesce("cosine", zero).alias("cosine"),
        (F.coalesce("keyword", zero) * F.coalesce("_boost", one)).alias("keyword"),
        "vector_rank",
        "keyword_rank",
    )


def hybrid_search(
    queries: DataFrame, vectors: DataFrame, texts: DataFrame,
    weights: tuple[float, float] = (VECTOR_WEIGHT, KEYWORD_WEIGHT), threshold: float = SIMILARITY_THRESHOLD,
    k: int = RERANK_TOP_K, retrieval_k: int = RETRIEVAL_TOP_K, filters: dict[str, str] | None = None,
) -> DataFrame:
    """Weighted sum of cosine and keyword score over the candidates of both rankings.

    ``queries`` is (query_id, q, vector). The keyword score is divided by the query's best one and
    boosted where the whole phrase occurs. Both retrieval depths are settings of the search itself.
    """
    fused = _fuse(queries, vectors, texts, retrieval_k, filters)
    score = F.round(weights[0] * F.col("cosine") + weights[1] * F.col("keyword"), SCORE_DIGITS)
    ranked = fused.select("query_id", "doc_id", score.alias("score")).filter(F.col("score") >= threshold)
    return top_per_group(ranked, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def agent_profiles(requests: DataFrame, profiles: DataFrame, vectors: DataFrame, texts: DataFrame) -> DataFrame:
    """Hybrid search where weights, threshold and both depths are those of each request's profile.

    ``requests`` is (query_id, q, vector, profile); ``profiles`` is (profile, retrieval_top_k,
    rerank_top_k, similarity_threshold, vector_weight, keyword_weight). One retrieval at the deepest
    setting serves all profiles.
    """
    depth = profiles.agg(F.max("retrieval_top_k")).first()[0]
    fused = _fuse(requests, vectors, texts, depth)
    with_profile = fused.join(requests.select("query_id", "profile"), "query_id").join(profiles, "profile")
    in_vector = F.coalesce(F.col("vector_rank") <= F.col("retrieval_top_k"), F.lit(False))
    in_keyword = F.coalesce(F.col("keyword_rank") <= F.col("retrieval_top_k"), F.lit(False))
    cosine = F.when(in_vector, F.col("cosine")).otherwise(F.lit(0.0))
    keyword = F.when(in_keyword, F.col("keyword")).otherwise(F.lit(0.0))
    score = F.round(F.col("vector_weight") * cosine + F.col("keyword_weight") * keyword, SCORE_DIGITS)
    hits = (
        with_profile.filter(in_vector | in_keyword)
        .select("query_id", "profile", "doc_id", "rerank_top_k", score.alias("score"), "similarity_threshold")
        .filter(F.col("score") >= F.col("similarity_threshold"))
    )
    deepest = profiles.agg(F.max("rerank_top_k")).first()[0]
    ranked = top_per_group(hits, ["query_id"], [F.desc("score"), F.asc("doc_id")], deepest)
    return ranked.filter(F.col("rank") <= F.col("rerank_top_k")).select("query_id", "profile", "doc_id", "score", "rank")


def synonym_table(spark) -> DataFrame:
    """The built-in finance synonyms as (term, synonym)."""
    return spark.createDataFrame([(t, s) for t, ss in SYNONYMS.items() for s in ss], "term string, synonym string")


def expand_query(queries: DataFrame, synonyms: DataFrame, text: str = "q") -> DataFrame:
    """Query terms plus the words of their synonyms: (query_id, term, is_original), one row per term."""
    base = query_terms(queries, text)
    lowered = synonyms.select(F.lower("term").alias("term"), "synonym")
    words = unnest(lowered, ["term"], tokens(F.col("synonym")), "_s").select("term", "_s").distinct()
    added = base.join(words, "term").select("query_id", F.col("_s").alias("term"), F.lit(False).alias("is_original"))
    both = base.withColumn("is_original", F.lit(True)).unionByName(added)
    return both.groupBy("query_id", "term").agg(F.max("is_original").alias("is_original"))


def extract_doc_metadata(docs: DataFrame, text: str = "text") -> DataFrame:
    """Dates, numbers, currency marks and fiscal periods found in each whole text, in order of occurrence."""
    keep = [c for c in docs.columns if c != text]

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    return docs.select(
        *keep,
        found(r"\b(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})\b").alias("dates"),
        found(r"\d+(?:[.,]\d+)*").alias("numbers"),
        found(r"R\$|US\$|€|£|\b(?:BRL|USD|EUR|GBP)\b").alias("currencies"),
        found(r"\b(?:Q[1-4]|[1-4]T|FY) ?\d{4}\b").alias("fiscal_periods"),
    )
