"""Task-side helpers of the search operators: score blocks of documents and keep the best.

The module is pickled by value, so executors need numpy and pyarrow but not this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Scores or counts held at once in a task (32 MiB of doubles).
BLOCK_VALUES = 4_000_000
# Words of documents looked up at once in a task; a longer document stands alone.
BLOCK_WORDS = 500_000
SCORE_DIGITS = 6
HITS = "query_id bigint not null, doc_id bigint not null, score double not null"
HIT_ARROW = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    n[n == 0] = 1.0
    return m / n


def matrix(vectors: pa.Array | pd.Series) -> np.ndarray:
    """List column -> one row per vector; vectors of different length cannot be compared and fail."""
    column = pa.array(vectors) if isinstance(vectors, pd.Series) else vectors
    if len(column) == 0:
        return np.zeros((0, 0))
    lengths = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    if len(lengths) != 1:
        raise ValueError(f"vectors of different dimensions: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def term_entries(lists: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, vocabulary number, count) of the words of a list column that are in the vocabulary, in this order."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    slots = pc.index_in(lists.flatten(), value_set=vocabulary)
    rows = np.repeat(np.arange(len(lengths)), lengths)[slots.is_valid().to_numpy(zero_copy_only=False)]
    width = max(1, len(vocabulary))
    found, counts = np.unique(rows * width + slots.drop_null().to_numpy().astype(np.int64), return_counts=True)
    return found // width, found % width, counts


class Best:
    """Running k best hits of each query: score descending, then document id.

    Hits are flat arrays. A hit below the k-th score its query already has cannot get in, so most
    are dropped by comparison and only the rest is sorted.
    """

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.rows, self.ids, self.scores = (np.empty(0, t) for t in (np.int64, np.int64, np.float64))
        self.floor = np.full(len(query_ids), -np.inf)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def update(self, scores: np.ndarray, doc_ids: np.ndarray, hits: np.ndarray | None = None) -> None:
        """Take in scores, one row per query and one column per document; ``hits`` tells which of them count."""
        scores = np.round(scores, SCORE_DIGITS) + 0.0
        if hits is not None:
            scores[~hits] = -np.inf
        n, floor = scores.shape[1], self.floor
        if n > self.k:
            floor = np.maximum(floor, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
        rows, cols = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
        self.pending.append((rows, doc_ids[cols], scores[rows, cols]))
        if sum(len(p[0]) for p in self.pending) > BLOCK_VALUES:
            self.merge()

    def merge(self) -> None:
        if not self.pending:
            return
        rows, ids, scores = (np.concatenate(p) for p in zip((self.rows, self.ids, self.scores), *self.pending))
        self.pending = []
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        start = np.searchsorted(rows, np.arange(len(self.query_ids)))
        place = np.arange(len(rows)) - start[rows]
        keep = place < self.k
        self.rows, self.ids, self.scores = rows[keep], ids[keep], scores[keep]
        full = self.rows[place[keep] == self.k - 1]
        self.floor[full] = self.scores[place[keep] == self.k - 1]

    def frame(self) -> pd.DataFrame:
        self.merge()
        return pd.DataFrame({"query_id": self.query_ids[self.rows], "doc_id": self.ids, "score": self.scores})

    def batch(self) -> pa.RecordBatch:
        self.merge()
        return pa.RecordBatch.from_pandas(self.frame(), schema=HIT_ARROW, preserve_index=False)


def vector_scorer(shared, k: int):
    """Task function over (doc_id, vector) batches; ``shared`` broadcasts (query ids, unit vectors)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = shared.value
        best = Best(ids, k)
        step = max(1, BLOCK_VALUES // max(1, len(ids)))
        for batch in batches:
            docs, doc_ids = unit_rows(matrix(batch.column("vector"))), batch.column("doc_id").to_numpy()
            for i in range(0, len(doc_ids), step):
                best.update(units @ docs[i : i + step].T, doc_ids[i : i + step])
        yield best.batch()

    return score


def word_blocks(batch: pa.RecordBatch, limit: int = BLOCK_WORDS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``terms`` have ``limit`` words at most, so that what is derived from them does not grow with the texts."""
    lengths = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False)
    for lo, hi in row_blocks(lengths, limit):
        yield batch.slice(lo, hi - lo)


def term_counter(vocabulary):
    """Task function counting documents per vocabulary term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocabulary.value), dtype=np.int64)
        for batch in (part for whole in batches for part in word_blocks(whole)):
            seen += np.bincount(term_entries(batch.column("terms"), vocabulary.value)[1], minlength=len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], ["slot", "n"])

    return count


def row_blocks(costs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose costs add up to ``limit`` at most; a dearer row stands alone."""
    start, total = 0, 0
    for i, c in enumerate(costs.tolist()):
        if i > start and total + c > limit:
            yield start, i
            start, total = i, 0
        total += c
    if start < len(costs):
        yield start, len(costs)


def keyword_scorer(shared, k: int, k1: float, b: float, mean: float):
    """Task function over (doc_id, len, terms) batches.

    ``shared`` broadcasts (query ids, vocabulary, and per term the places in two arrays of query numbers and
    weights). Only (document, term) pairs that occur are scored; terms are added in the order of the vocabulary.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vocabulary, starts, queries, weights = shared.value
        best = Best(ids, k)
        fan = np.diff(starts)
        for batch in (part for whole in batches for part in word_blocks(whole)):
            rows, slots, tf = term_entries(batch.column("terms"), vocabulary)
            hit, rows = np.unique(rows, return_inverse=True)
            doc_ids = batch.column("doc_id").to_numpy()[hit]
            length = batch.column("len").to_numpy()[hit][rows]
            saturated = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))
            costs = np.bincount(rows, fan[slots], len(hit)) + len(ids) if len(hit) else np.empty(0)
            for lo, hi in row_blocks(costs, BLOCK_VALUES):
                e = slice(*np.searchsorted(rows, [lo, hi]))
                n = fan[slots[e]]
                at = np.arange(n.sum()) + np.repeat(starts[slots[e]] - (np.cumsum(n) - n), n)
                cell = queries[at] * (hi - lo) + np.repeat(rows[e] - lo, n)
                size = len(ids) * (hi - lo)
                total = np.bincount(cell, weights[at] * np.repeat(saturated[e], n), size).reshape(len(ids), -1)
                best.update(total, doc_ids[lo:hi], np.bincount(cell, minlength=size).reshape(len(ids), -1) > 0)
        yield best.batch()

    return score
