"""Line-first cleaning: rules per line, failing lines go, then documents that lose too much go.

A line is what lies between two U+000A; its words are runs of characters other than space and U+0009 to
U+000D. Lines without a word pass. A line with n words fails

* by punctuation, if no word ends a sentence, or if marks out of place (runs of ``#*$%&|<>`` and doubled ``!?``)
  are two or more and at least half as many as words;
* by navigation, if two or more words and at least a quarter are separators (``|``, ``>`` and the like), or if it
  has at most eight words and all of them are menu words;
* as boilerplate, if it has at most twenty words and one of the fixed phrases, or if at least half of its words,
  and three or more, repeat the word before.

A document is rejected if it has under ``MIN_WORDS`` words, if over 30 % of its words lie in eight-word windows
that it has twice, or if over half of its words stand in failing lines.

Null and empty texts have no words and are rejected. Texts of any length are read whole, each row by
itself: rows may repeat, keys may be null. Results do not depend on letters' case but for repeated windows and lines,
which compare words as they are.
"""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import LOWER, map_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 20
WINDOW = 8
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Patterns are written so that Python's and SQL's engines agree on them; they meet lines in lower case.
SENTENCE = r"""[.!?\x{2026}]["'\x{201D}\x{2019}\x{BB})\]]*(?:[\x20\x09-\x0D]|$)|[\x{3002}\x{FF01}\x{FF1F}]"""
ODD = r"[#*$%&|<>]+|[!?][!?]+"
SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|>/\\\x{BB}\x{203A}\x{2022}\x{B7}\x{2192}-]+(?:$|[\x20\x09-\x0D])"
MENU = (
    "home", "menu", "login", "logout", "register", "search", "contact", "about", "us", "help", "faq", "sitemap", "next",
    "previous", "back", "top", "share", "print", "subscribe", "sign", "in", "up", "skip", "to", "content", "more", "read",
)
PHRASES = (
    "cookie policy", "use cookies", "uses cookies", "accept cookies", "privacy policy", "terms of use", "terms of service",
    "terms and conditions", "all rights reserved", "powered by", "enable javascript", "skip to content", "click here",
    "read more", "sign up for our newsletter", "subscribe to our newsletter", "follow us on", "share this", "back to top",
    "log in to comment", "leave a comment", "lorem ipsum",
)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LOST = ["lost_punctuation", "lost_navigation", "lost_boilerplate"]


def python_pattern(pattern: str) -> re.Pattern:
    return re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), pattern))


_SENTENCE, _ODD, _SEPARATOR = (python_pattern(p) for p in (SENTENCE, ODD, SEPARATOR))
_MENU, _PHRASE = frozenset(w.encode() for w in MENU), re.compile("|".join(map(re.escape, PHRASES)))


def verdict(line: str, words: list[bytes]) -> int | None:
    """Which of the rules in LOST the line fails first; ``line`` and its words are in lower case."""
    n = len(words)
    if not _SENTENCE.search(line):
        return 0
    odd = len(_ODD.findall(line))
    if odd >= 2 and 2 * odd >= n:
        return 0
    if n >= 2 and 4 * (marks := sum(1 for _ in _SEPARATOR.finditer(line))) >= n and marks >= 2:
        return 1
    if n <= 8 and all(w.rstrip(b".!?") in _MENU for w in words):
        return 1
    if n <= 20 and _PHRASE.search(line):
        return 2
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return 2 if repeats >= 3 and 2 * repeats >= n else None


def window_words(texts: list[list[bytes]], width: int = WINDOW) -> np.ndarray:
    """Per text, how many words lie in windows of ``width`` (a power of two) words that the text has twice or more.

    Windows of all texts are named at once: names of twice the width are pairs of names.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    known: dict[bytes, int] = {}
    names = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, sizes.sum())
    owner, w = np.repeat(np.arange(len(texts)), sizes), 1
    while w < width and len(names) > w:
        names = np.unique(names[:-w] * (names.max() + 1) + names[w:], return_inverse=True)[1]
        w *= 2
    ends = np.cumsum(sizes)[owner]
    at = np.flatnonzero(np.arange(len(owner)) + width <= ends) if w == width else np.empty(0, np.int64)
    _, back, n = np.unique(names[at] * len(texts) + owner[at], return_inverse=True, return_counts=True)
    at = at[n[back] > 1]
    edges = np.bincount(at, minlength=len(owner) + 1) - np.bincount(at + width, minlength=len(owner) + 1)
    return np.bincount(owner[np.cumsum(edges)[:-1] > 0], minlength=len(texts))


def count_block(texts: list[str | None], with_text: bool) -> list[list]:
    """Counts of a block of texts, words lost per rule, and the text of the lines that pass."""
    texts = [t or "" for t in texts]
    found = [t.encode().split() for t in texts]
    repeated = window_words(found).tolist()
    out: list[list] = [[] for _ in range(len(COUNTS) + len(LOST) + 1)]
    for text, words, again in zip(texts, found, repeated):
        lost, kept, seen, full = [0] * len(LOST), [], set(), 0
        lower_lines = text.encode().translate(LOWER).split(b"\n")
        for line, lower in zip(text.split("\n"), lower_lines):
            own = lower.split()
            failed = None
            if own:
                full += 1
                seen.add(line)
                failed = verdict(lower.decode(), own)
            if failed is not None:
                lost[failed] += len(own)
            elif with_text:
                kept.append(line)
        chars = len(text) - sum(map(text.count, BLANKS))
        row = [len(words), chars, sum(map(text.count, SYMBOLS)), full - len(seen), again, *lost, "\n".join(kept)]
        for column, value in zip(out, row):
            column.append(value)
    return out if with_text else out[:-1]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", clean: bool = False) -> DataFrame:
    """key, the counts of ``COUNTS``, the words lost per rule of ``LOST``, and with ``clean`` the passing lines as ``clean``.

    One pass without a shuffle; of the documents only key and text reach the tasks' Python.
    """
    kind = docs.schema[key].dataType.simpleString()
    fields = [f"__key {kind}", *[f"{c} bigint" for c in [*COUNTS, *LOST]], *(["clean string"] if clean else [])]
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    found = map_columns(rows, ["__key", "__text"], ", ".join(fields), lambda: lambda keys, texts: [keys, *count_block(texts, clean)])
    return found.withColumnRenamed("__key", key)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def kept() -> Column:
    lost = sum((F.col(c) for c in LOST), F.lit(0))
    return ~base_failed() & (2 * lost <= F.col("n_words"))


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text of the documents that are kept, without their failing lines."""
    found = measure(docs, key, text, clean=True)
    return found.where(kept()).select(key, F.col("clean").alias(text))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, *COUNTS, base_failed().alias("base_failed"), kept().alias("kept"), *LOST)
