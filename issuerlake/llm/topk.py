"""Exact top-k search by inner product, by distributed histogram selection.

Every query is scored against every candidate. Each task counts its scores in a histogram of the range
where a query's k-th best score can still lie, and keeps the bins from the top down to its own k-th
score: no lower bin can hold the k-th score of all. The summed histograms name the bin with the k-th
score, which is the range of the next pass, until a bin is one score wide. Then scores above it
are taken, and of scores equal to it, as many as are missing, smallest ids first.

Vectors are turned into floor(scale * x). Vectors that are null or hold null or non-finite components,
and rows without an id, take no part. Only vectors of the query's dimension are its candidates, and no
row with the query's own id. Queries that repeat both id and vector are asked once, those that repeat the id
alone each for itself; repeated candidates count as often as they occur. Fewer candidates than k give all of them.
Scores must fit into 64 bits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 1_024
# Queries sent to every task at once, and scores held at once in a task.
BLOCK_QUERIES, BLOCK_SCORES = 4_096, 2_000_000
EXACT = float(1 << 52)


def integers(vectors: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """id, v array<bigint>, norm of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    v: Column = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.select(F.col(key).cast("bigint").alias("id"), v.alias("v"))


class Block:
    """Queries of one dimension: ids ascending, matrix, range [low, high] of the k-th score, how many are above."""

    def __init__(self, ids: list[int], rows: list[list[int]]):
        self.ids, self.rows = np.array(ids, np.int64), np.array(rows, np.int64).reshape(len(ids), -1)
        self.low = self.high = self.above = None

    def score(self, m: np.ndarray) -> np.ndarray:
        """candidate x query; exact either way, doubles where they hold every sum."""
        width = max(1, m.shape[1])
        if float(np.abs(m).max(initial=0)) * float(np.abs(self.rows).max(initial=0)) * width < EXACT:
            return (m.astype(np.float64) @ self.rows.T.astype(np.float64)).astype(np.int64)
        return m @ self.rows.T


def scored(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate ids, scores, whether the pair counts) of a limited number of candidates at a time."""
    width = block.rows.shape[1]
    step = max(1, BLOCK_SCORES // max(1, len(block.ids)))
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        fits = np.array(lists.value_lengths()) == width
        ids = ids.to_numpy(zero_copy_only=False)[fits]
        m = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), width)
        for i in range(0, len(ids), step):
            part = ids[i : i + step]
            counts = np.ones((len(part), len(block.ids)), bool)
            first, last = np.searchsorted(block.ids, part), np.searchsorted(block.ids, part, "right")
            for own in np.flatnonzero(last > first).tolist():
                counts[own, first[own] : last[own]] = False
            yield part, block.score(m[i : i + step]), counts


def histogram(vectors: DataFrame, block: Block, k: int) -> DataFrame:
    """query (number), bin (from the top), n: the summed histograms, as far down as they matter."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        b = shared.value
        total = np.zeros((len(b.ids), BINS), np.int64)
        span = np.maximum(1, -(-(b.high - b.low + 1) // BINS))
        for _, s, counts in scored(batches, b):
            at = (b.high - s) // span
            counts &= (s >= b.low) & (s <= b.high)
            flat = (np.arange(len(b.ids)) * BINS + at)[counts]
            total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        before = np.cumsum(total, axis=1) - total
        q, n = np.nonzero((total > 0) & (before < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int32()), pa.array(n, pa.int32()), pa.array(total[q, n], pa.int64())], names=["query", "bin", "n"]
        )

    return vectors.mapInArrow(run, "query int, bin int, n bigint").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def narrow(vectors: DataFrame, block: Block, k: int) -> None:
    """One pass: the range of every query's k-th score becomes the bin that holds it."""
    rows = [(q, int(k - n)) for q, n in enumerate(block.above)]
    need = F.broadcast(vectors.sparkSession.createDataFrame(rows, "query int, need bigint"))  # a row per query of the block
    w = Window.partitionBy("query").orderBy("bin")
    running = histogram(vectors, block, k).withColumn("upto", F.sum("n").over(w)).join(need, "query")
    first = running.where("upto >= need and upto - n < need").select("query", "bin", (F.col("upto") - F.col("n")).alias("before"))
    span = np.maximum(1, -(-(block.high - block.low + 1) // BINS))
    found = {r["query"]: (r["bin"], r["before"]) for r in first.collect()}
    for q in range(len(block.ids)):
        if q in found:
            n, before = found[q]
            top = block.high[q] - n * span[q]
            block.low[q] = max(block.low[q], top - span[q] + 1)
            block.high[q] = top
            block.above[q] += before
        else:  # fewer than k candidates: all of them
            block.high[q] = block.low[q]


def select(vectors: DataFrame, block: Block, k: int) -> DataFrame:
    """query (number), query_id, vec_id, score: scores above the k-th one, and per task the smallest ids of those equal to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        b = shared.value
        ties: list[list[int]] = [[] for _ in b.ids]
        for ids, s, counts in scored(batches, b):
            c, q = np.nonzero(counts & (s > b.low))
            out = [(q, b.ids[q], ids[c], s[c, q])]
            c, q = np.nonzero(counts & (s == b.low))
            order = np.lexsort((ids[c], q))
            c, q = c[order], q[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            for x, y in zip(q[rank < k].tolist(), ids[c[rank < k]].tolist()):
                ties[x].append(y)
            yield table(*(np.concatenate(x) for x in zip(*out)))
        rows = [(q, b.ids[q], y, b.low[q]) for q, own in enumerate(ties) for y in sorted(own)[:k]]
        if rows:
            yield table(*(np.array(x, np.int64) for x in zip(*rows)))

    def table(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")


def blocks(queries: DataFrame, size: int) -> Iterator[Block]:
    """Query blocks of one dimension and limited size, streamed through the driver in order of dimension and id."""
    once = queries.select("id", "v").distinct().withColumn("d", F.size("v")).orderBy("d", "id", "v")
    ids: list[int] = []
    rows: list[list[int]] = []
    for r in once.toLocalIterator():
        if ids and (len(ids) == size or len(r["v"]) != len(rows[0])):
            yield Block(ids, rows)
            ids, rows = [], []
        ids.append(r["id"])
        rows.append(r["v"])
    if ids:
        yield Block(ids, rows)


def search(queries: DataFrame, candidates: DataFrame, k: int, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates; ties to the smaller id.

    Both tables have id and v (see ``integers``). Per block of queries, of which the driver holds one at a time, a few
    passes read all candidates; nothing but histogram bins and hits is shuffled. A block's hits are written
    to a shared folder, so no plan grows with the queries.
    """
    session = candidates.sparkSession
    path, schema = shared_dir(session, "topk"), "query_id bigint, rank int, vec_id bigint, score bigint"
    session.createDataFrame([], schema).write.parquet(path)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = float(candidates.agg(F.max(F.sqrt(norm))).first()[0] or 0)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    for block in blocks(queries, block_queries):
        reach = np.sqrt((block.rows.astype(np.float64) ** 2).sum(axis=1)) * longest * (1 + 1e-9) + 1
        block.high = np.minimum(reach, float(1 << 61)).astype(np.int64)
        block.low = -block.high
        block.above = np.zeros(len(block.ids), np.int64)
        while (block.high > block.low).any():
            narrow(candidates, block, k)
        ranked = select(candidates, block, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return session.read.schema(schema).parquet(path)
