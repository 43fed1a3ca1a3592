"""Benchmark decontamination by Wu-Manber search over words.

A window is ``width`` consecutive words of an item, or the whole of a shorter item. All windows of
one length are searched together: the block of the last two words under the search position gives,
by the shift table, how far the position may move without missing a window. Only a block that ends
some window (shift 0) leads to its bucket, where the other words are looked up and compared.

Windows are searched in blocks whose tables have a limited size, one pass over the documents each; what a pass
has found is written to the shared folder before the next block is read.

Texts are cut into words of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Null
and empty texts have no words and no hits; null and empty items have no windows. Items that repeat
count once per item_id, a null item_id as the text "null". Rows of documents may repeat; each is
searched by itself, whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import filter_rows, map_columns, plain_words
from issuerlake.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 10
# Bytes that the tables of a pass may take in a worker, and about what a window's entries take.
BLOCK_BYTES, WINDOW_BYTES = 200_000_000, 2_000


class Searcher:
    """Shift tables and buckets of all windows, by window length."""

    def __init__(self, items: list[tuple[str, list[bytes], int]]):
        windows: dict[int, dict[tuple, set[str]]] = {}
        for name, words, n in items:
            for i in range(len(words) - n + 1):
                windows.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(name)
        self.tables = []
        for n, own in sorted(windows.items()):
            block = min(2, n)
            shift: dict = {}
            buckets: dict = {}  # last block -> the words before it -> names of items
            for w, names in own.items():
                for end in range(block, n + 1):
                    key = w[end - block : end]
                    shift[key] = min(shift.get(key, n), n - end)
                buckets.setdefault(w[n - block :], {})[w[: n - block]] = names
            if block == 1:
                shift, buckets = ({k[0]: v for k, v in t.items()} for t in (shift, buckets))
            self.tables.append((n, block, shift, buckets))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(merged word spans of all occurrences, names of the items found)."""
        spans, names = [], set()
        for n, block, shift, buckets in self.tables:
            at, last, far, get = n - 1, len(words), n - block + 1, shift.get
            while at < last:
                key = (words[at - 1], words[at]) if block == 2 else words[at]
                move = get(key, far)
                if move:
                    at += move
                    continue
                found = buckets[key].get(tuple(words[at - n + 1 : at - block + 1]))
                if found:
                    spans.append((at - n + 1, at + 1))
                    names |= found
                at += 1
        return merged(spans), names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def item_blocks(items: DataFrame, item: str, text: str, width: int, limit: int) -> Iterator[list[tuple[str, list[bytes], int]]]:
    """(item, words, window length) in lists whose windows take about ``limit`` bytes, streamed through the driver one at a time.

    A long item is cut where a list is full; its parts share the words that windows over the cut need. The last list
    may be empty.
    """
    room = max(1, limit // WINDOW_BYTES)
    block: list[tuple[str, list[bytes], int]] = []
    left = room
    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    for name, value in rows.toLocalIterator():
        words = plain_words(value)
        n = min(width, len(words))
        at = 0
        while n and at <= len(words) - n:
            if not left:
                yield block
                block, left = [], room
            taken = min(left, len(words) - n + 1 - at)
            block.append((name, words[at : at + taken + n - 1], n))
            at, left = at + taken, left - taken
    yield block


def passes(docs: DataFrame, items: DataFrame, item: str, text: str, width: int, limit: int, step) -> DataFrame:
    """``step`` (documents, broadcast block, whether more blocks follow) for every block, the documents written between two of them."""
    context, session = docs.sparkSession.sparkContext, docs.sparkSession
    blocks = item_blocks(items, item, text, width, limit)
    block = next(blocks)
    while True:
        following = next(blocks, None)
        shared = context.broadcast(block)
        docs = step(docs, shared, following is not None)
        if following is None:
            return docs
        path = shared_dir(session, "contamination")
        docs.write.parquet(path)
        docs = session.read.parquet(path)
        shared.unpersist()
        block = following


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """key, n_words, spans array<struct<start, end>> (words, merged), items array<string> (sorted).

    Nothing is shuffled. An empty item table gives no spans.
    """
    kind = docs.schema[key].dataType.simpleString()
    state = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"

    def step(rows: DataFrame, block, more: bool) -> DataFrame:
        def make():
            searcher = Searcher(block.value)

            def run(keys, texts, _=None, spans=None, names=None):
                counts, found, ids = [], [], []
                for j, t in enumerate(texts):
                    words = plain_words(t)
                    s, n = searcher.find(words)
                    if spans is not None:
                        s = merged(s + [(x["start"], x["end"]) for x in spans[j]])
                        n = n.union(names[j])
                    counts.append(len(words))
                    found.append([{"start": a, "end": b} for a, b in s])
                    ids.append(sorted(n))
                return [keys, *([texts] if more else []), counts, found, ids]

            return run

        return map_columns(rows, rows.columns, f"__key {kind}, {'__text string, ' if more else ''}{state}", make)

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return passes(rows, items, item, item_text, width, block_bytes, step).withColumnRenamed("__key", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        key, "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", width: int = WIDTH,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window of the items occurs, all columns unchanged."""

    def step(rows: DataFrame, block, more: bool) -> DataFrame:
        def make():
            searcher = Searcher(block.value)
            return lambda texts: [not searcher.find(plain_words(t))[0] for t in texts]

        return filter_rows(rows, text, make)

    return passes(docs, items, "item_id", "text", width, block_bytes, step)
