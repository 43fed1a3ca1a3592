"""Runs of repeated words by block convolution.

A run is a longest stretch of words with smallest period q and at least max(6, 4 q) words. At the
scale B = 1, 2, 4, ... the periods from B to 2 B - 1 are searched. The words are cut into blocks of B; a run of
such a period holds a whole block, and that block again q words later. For every block the sum of squared
differences to each place of the window that follows it comes from one cyclic convolution by
number-theoretic transforms, in integers modulo a prime: it is zero where the block occurs again. Only
blocks whose words all occur again within 2 B words can, so others are left out before. Every distance found is
a seed: if a run of a shorter period explains it, it goes; else the words are compared to both sides, which
also confirms the occurrence (a sum may be a multiple of the prime), and the stretch is a run if it is long enough.

Words are runs of characters other than space and U+0009 to U+000D, compared as they are. Null and empty texts
have no words and no runs. Texts are taken whole; each row is searched by itself, so rows may repeat. Blocks of many texts
are transformed together; a text longer than 2**26 words fails rather than being cut.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import map_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 15 * 2**27 + 1: residues have 31 bits, products fit into 64, and it has roots of unity of every power of two up to 2**27.
PRIME, ROOT, ROOT_BITS = 2_013_265_921, 31, 27
LEAST, TIMES = 6, 4
# Elements transformed at once in a task.
ELEMENTS = 1 << 19
WORD = re.compile(r"[^\x20\x09-\x0D]+")

_twiddles: dict[tuple[int, bool], np.ndarray] = {}


def powers(n: int, inverse: bool) -> np.ndarray:
    """The powers below n / 2 of a root of unity of order n, by doubling."""
    if (n, inverse) not in _twiddles:
        root = pow(ROOT, (PRIME - 1) // n, PRIME)
        root = pow(root, PRIME - 2, PRIME) if inverse else root
        out = np.ones(1, np.int64)
        while len(out) < n // 2:
            out = np.concatenate([out, out * pow(root, len(out), PRIME) % PRIME])
        _twiddles[n, inverse] = out[: max(1, n // 2)]
    return _twiddles[n, inverse]


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row (a power of two long); the inverse is not divided by the length."""
    count, n = rows.shape
    size, stride = n, 1
    while size > 1:
        half = size // 2
        pairs = rows.reshape(count, 2, half, stride)
        first, second = pairs[:, 0], pairs[:, 1]
        out = np.empty((count, half, 2, stride), np.int64)
        out[:, :, 0] = (first + second) % PRIME
        out[:, :, 1] = (first - second) * powers(size, inverse)[:, None] % PRIME
        rows = out.reshape(count, n)
        size, stride = half, 2 * stride
    return rows


def occurrences(words: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks and the distances in [block, 2 block) at which their squared differences vanish."""
    n, size = len(words), 2 * block
    place = np.arange(block)
    squares = np.concatenate([[0], np.cumsum(words * words % PRIME)])
    found = []
    for i in range(0, len(starts), max(1, ELEMENTS // size)):
        at = starts[i : i + max(1, ELEMENTS // size)]
        own = words[at[:, None] + place]
        reach = at[:, None] + block + np.arange(size)
        # The window has 2 B - 1 words; words behind the end are -1 and no word equals them.
        window = np.where((reach < n) & (np.arange(size) < size - 1), words[np.minimum(reach, n - 1)], 0)
        padded = np.zeros((len(at), size), np.int64)
        padded[:, :block] = own[:, ::-1]
        product = transform(transform(padded) * transform(window) % PRIME, inverse=True)[:, block - 1 : size - 1]
        product = product * pow(size, PRIME - 2, PRIME) % PRIME
        ends = np.minimum(at[:, None] + 2 * block + place, n)
        theirs = squares[ends] - squares[np.minimum(at[:, None] + block + place, n)]
        mine = (squares[at + block] - squares[at])[:, None]
        zero = (mine + theirs - 2 * product) % PRIME == 0
        zero &= at[:, None] + 2 * block + place <= n
        row, shift = np.nonzero(zero)
        found.append((at[row], block + shift))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def reach_right(words: np.ndarray, at: int, q: int) -> int:
    """The first place from ``at`` whose word differs from the one q words later, or has none."""
    step, last = 32, len(words) - q
    while at < last:
        end = min(at + step, last)
        bad = words[at:end] != words[at + q : end + q]
        if bad.any():
            return at + int(bad.argmax())
        at, step = end, 2 * step
    return at


def reach_left(words: np.ndarray, at: int, q: int) -> int:
    """The first place of the stretch up to ``at`` in which every word equals the one q words later."""
    step = 32
    while at > 0:
        start = max(0, at - step)
        bad = words[start:at] != words[start + q : at + q]
        if bad.any():
            return at - int(bad[::-1].argmax())
        at, step = start, 2 * step
    return at


def flat_runs(words: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs of several texts laid end to end; texts share no word number."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    gap = np.full(n, n + 1, np.int64)  # words to the next occurrence
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    runs: list[tuple[int, int, int]] = []
    block = 1
    while sizes.size and TIMES * block <= sizes.max():
        starts = np.arange(0, n - block + 1, block)
        near = (gap[: len(starts) * block] < 2 * block).reshape(-1, block).all(axis=1)
        starts = starts[near & (sizes[owner[starts]] >= TIMES * block)]
        at, distance = occurrences(words, starts, block)
        if len(at) and runs:
            # Of the known runs that begin before a seed the one that reaches furthest; a shorter period that divides the distance explains it.
            known = np.array(sorted(runs), np.int64)
            ends = known[:, 0] + known[:, 1]
            furthest = np.maximum.accumulate(ends)
            best = np.maximum.accumulate(np.where(ends == furthest, np.arange(len(ends)), 0))
            k = np.searchsorted(known[:, 0], at, "right") - 1
            r = best[np.maximum(k, 0)]
            explained = (k >= 0) & (ends[r] >= at + distance + block) & (distance % known[r, 2] == 0)
            at, distance = at[~explained], distance[~explained]
        order = np.lexsort((at, distance))
        period, until = 0, 0
        for x, q in zip(at[order].tolist(), distance[order].tolist()):
            if q == period and x < until:
                continue
            end = reach_right(words, x, q)
            if end < x + block:
                continue
            start = reach_left(words, x, q)
            period, until = q, end
            if end + q - start >= max(LEAST, TIMES * q):
                runs.append((start, end + q - start, q))
        block *= 2
    return np.array(sorted(runs), np.int64).reshape(-1, 3)


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words) its runs as (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.size and sizes.max() > 1 << (ROOT_BITS - 1):
        raise ValueError("a text has more words than the transform can hold")
    numbers, first = [], 1
    for t in texts:
        known: dict = {}
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in t), np.int64, len(t)) + first)
        first += len(known)
    owner = np.repeat(np.arange(len(texts)), sizes)
    found = flat_runs(np.concatenate([*numbers, np.empty(0, np.int64)]), owner, sizes)
    offsets = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in found.tolist():
        i = int(owner[start])
        out[i].append((start - int(offsets[i]), length, period))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats: all of a run but its first period goes."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist()) if not g] if runs else words


Rewrite = Callable[[Any, list[str]], list[str]]


def per_document(docs: DataFrame, key: str, text: str, fields: str, row: Callable[[list[str], list], tuple], rewrite: Rewrite | None) -> DataFrame:
    """key and the fields that ``row`` makes of a document's words and runs, in one pass without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def block(keys, texts):
        words = [WORD.findall(t or "") for t in texts]
        if rewrite:
            words = [rewrite(k, w) for k, w in zip(keys, words)]
        made = [row(w, r) for w, r in zip(words, runs_of(words))]
        return [keys, *map(list, zip(*made))]

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return map_columns(rows, ["__key", "__text"], f"__key {kind}, {fields}", lambda: block).withColumnRenamed("__key", key)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """key, runs array<struct<start, length, period>> (words from 0) and the text without repeats, its words joined by one space.

    ``rewrite`` changes a document's words by its key before they are searched.
    """
    fields = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def row(words, runs):
        return [{"start": s, "length": n, "period": p} for s, n, p in runs], " ".join(collapse(words, runs))

    return per_document(docs, key, text, fields, row, rewrite)


def repeat_tail(key: Any, words: list[str]) -> list[str]:
    """The contract's change: by crc32 of its key, a tenth of the documents gets a tail of one repeated stretch. A null key counts as empty text."""
    h = zlib.crc32(str("" if key is None else key).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """key, n_runs, the longest run (smallest start, then period, of equally long ones), and digests of runs and collapsed text."""
    fields = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"

    def sha(parts: Iterator[str]) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def row(words, runs):
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        return len(runs), *best, milli, sha(f"{s},{n},{p}\n" for s, n, p in runs), sha([" ".join(collapse(words, runs))])

    return per_document(docs, key, text, fields, row, rewrite)
