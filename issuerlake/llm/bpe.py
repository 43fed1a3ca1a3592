"""BPE encoding and decoding by batched merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of every adjacent pair by
binary search over sorted pair keys, takes the lowest per word and merges all its occurrences from
the left. Words are finished when no pair of theirs is in the table; only unseen words are merged,
the rest come from a bounded cache of the worker.

Null and empty texts have no tokens. Texts are taken whole; rows of any number may repeat.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata

import numpy as np
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from issuerlake.llm.common import map_columns, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.int64(1 << 40)
# White-space separated chunks cached per worker before the cache starts afresh.
CACHED_CHUNKS = 150_000
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The vocabulary's own pre-tokenizer pattern, white space spelled out: a fixed value.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"


def byte_alphabet() -> list[str]:
    """Byte -> printable character: printable Latin-1 stays, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Merges:
    """Tables of a vocabulary file and the merge rounds over them."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        vocab: dict[str, int] = data["model"]["vocab"]
        self.end = data["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        letters = byte_alphabet()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.by_rank = made
        self.words = regex.compile(PATTERN)
        self.spaces = regex.compile(f"[{WHITE}]+")
        self.controls = regex.compile(r"[\x1c-\x1f]")
        self.marks = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.names = {i: str(i).encode() for i in self.tokens}
        # Decimal id -> token.
        self.spelled = {self.names[i]: t.encode() for i, t in self.tokens.items()}
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, bytes] = {}

    def decode(self, ids: list[bytes]) -> bytes:
        """The tokens of decimal ids, joined by spaces; ids that the vocabulary does not have are skipped."""
        return b" ".join([t for t in map(self.spelled.get, ids) if t is not None])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens per word) of non-empty words."""
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        sym = self.inner[flat]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[flat[ends]]
        rank = np.full(len(sym), NONE)
        inside = word[:-1] == word[1:]
        i = np.flatnonzero(inside)
        rank[i] = self.rank(sym[i], sym[i + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(sym)])
            spread = np.repeat(best, lengths)
            live = spread < NONE
            if not live.all():
                done.append((word[~live], sym[~live]))
                word, sym, rank, spread = word[live], sym[live], rank[live], spread[live]
                if not len(sym):
                    break
            chosen = rank == spread
            # Of overlapping occurrences (aaa) every second one from the left is merged.
            after = np.r_[False, chosen[:-1]]
            if (chosen & after).any():
                n = np.arange(len(chosen))
                run = np.maximum.accumulate(np.where(chosen & ~after, n, 0))
                chosen &= (n - run) % 2 == 0
            at = np.flatnonzero(chosen)
            sym[at] = self.by_rank[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            word, sym, rank = word[keep], sym[keep], rank[keep]
            touched = np.zeros(len(sym), bool)
            touched[moved] = True
            touched[np.maximum(moved - 1, 0)] = True
            near = np.flatnonzero(touched)
            rank[near] = NONE
            near = near[near + 1 < len(sym)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.rank(sym[near], sym[near + 1])
        if not done:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        word, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def learn(self, chunks: list[str]) -> None:
        """Merge the words of chunks not seen before; each distinct word of the call once."""
        split = [self.words.findall(c.lower() if c.isascii() else normal(c)) for c in chunks]
        fresh = list(set().union(*split))
        ids, sizes = self.merge([w.encode() for w in fresh])
        names = [self.names[i] for i in ids.tolist()]
        of, at = {}, 0
        for w, n in zip(fresh, sizes.tolist()):
            of[w] = names[at : at + n]
            at += n
        for c, words in zip(chunks, split):
            self.add(c, of[words[0]] if len(words) == 1 else [t for w in words for t in of[w]])

    def add(self, chunk: str, names: list[bytes]) -> None:
        self.ids[chunk] = b" ".join(names)

    def split(self, text: str) -> list[str]:
        """White-space separated chunks, which no word crosses; special tokens stand behind a NUL and a space."""
        if self.marks is not None and any(s in text for s in self.special):
            parts = self.marks.split(text)
            return [w for i, p in enumerate(parts) for w in (["\0 " + p] if i % 2 else self.split(p))]
        # U+001C to U+001F are white space to Python only.
        return [c for c in self.spaces.split(text) if c] if self.controls.search(text) else text.split()

    def block(self, texts: list[str | None]) -> list[list[str]]:
        """Every text's chunks, all of them in the cache afterwards."""
        if len(self.ids) > CACHED_CHUNKS:
            self.clear()
        split = [self.split(t) if t else [] for t in texts]
        fresh = set().union(*split).difference(self.ids)
        for mark in [c for c in fresh if c[:2] == "\0 "]:
            fresh.remove(mark)
            self.add(mark, [self.names[self.special[mark[2:]]]])
        if fresh:
            self.learn(list(fresh))
        return split


def normal(chunk: str) -> str:
    """NFC, then every character in lower case by itself (Python would make a final sigma)."""
    return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()


def tables(spec: str) -> Merges:
    return worker_cache("bpe-" + hashlib.sha256(spec.encode()).hexdigest(), lambda: Merges(spec))


def slices(texts: list[str | None], chars: int = 1_000_000):
    """Consecutive runs of texts of limited total length; a longer text stands alone."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and total + n > chars:
            yield start, i
            start, total = i, 0
        total += n
    if texts:
        yield start, len(texts)


def read_vocabulary(path: str) -> str:
    """The vocabulary file's content; its size is bounded by the vocabulary, so tasks get it whole."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids array<int>: the token ids of every text."""
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        m = tables(spec.value)

        def block(keys, texts):
            out = []
            for a, b in slices(texts):
                for chunks in m.block(texts[a:b]):
                    out.append(list(map(int, b" ".join(map(m.ids.__getitem__, chunks)).split())))
            return [keys, out]

        return block

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"{key} {kind}, ids array<int>", make)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, decoded string: the tokens of the ids joined by spaces, as the vocabulary file (which names
    no decoder) has it. Unknown and null ids are skipped; a null array decodes to the empty text."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        m = tables(spec.value)

        def block(keys, arrays):
            return [keys, [m.decode([b"%d" % i for i in a or [] if i is not None]).decode() for a in arrays]]

        return block

    kind = encoded.schema[key].dataType.simpleString()
    return map_columns(encoded, [key, ids], f"{key} {kind}, decoded string", make)


DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, token count and digests of the ids and of the text that is decoded from them, without moving the ids to the JVM."""
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        m = tables(spec.value)

        def block(keys, texts):
            counts, ids, decoded = [], [], []
            for a, b in slices(texts):
                for chunks in m.block(texts[a:b]):
                    joined = b" ".join(map(m.ids.__getitem__, chunks))
                    own = joined.split()
                    counts.append(len(own))
                    ids.append(hashlib.sha256(joined).hexdigest())
                    decoded.append(hashlib.sha256(m.decode(own)).hexdigest())
            return [keys, counts, ids, decoded]

        return block

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"{key} {kind}, {DIGEST}", make)
