"""License scans: exact phrases, and short notices with a bounded number of errors.

A notice of n characters may hold n // ``per_error`` errors (insertions, deletions, substitutions): one in 11, so
that a notice of 45 characters is found with four errors and not with five. It is cut into two pieces more than
that, so at least two pieces of any such occurrence are free of errors, and as far apart as in the notice but for the
errors: finding the pieces exactly locates all candidates. Around each candidate the regex library's
bounded-error matching confirms the notice and gives its span and errors. Of notices that overlap the one with the
higher score stays, then the longer, then the first.

Texts are taken whole, as lower-cased words joined by one space. Null and empty texts have no words,
no labels and score 0. Rows may repeat; each is scanned by itself.
"""

from __future__ import annotations

import sys
from bisect import bisect_left

import numpy as np
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import map_columns, plain_words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Exact phrases of the contract: fixed values.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Notices searched with errors, as users of the labels would quote them.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("www apache org licenses license 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("licensed under the gnu general public license version", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("dedicated to the public domain", "public-domain"),
    ("copyright all rights reserved", "reserved"),
)
PER_ERROR = 11


class Notice:
    def __init__(self, text: str, label: str, per_error: int):
        self.text, self.label = text, label
        self.errors = len(text) // per_error
        n = self.errors + 2
        cuts = [len(text) * i // n for i in range(n + 1)]
        self.pieces = [(text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={self.errors}}}")

    def find(self, joined: str) -> list[tuple[int, int, int]]:
        """(start, end, errors) of occurrences in the joined words, from the left, without overlap."""
        # Where the notice would begin, by every place of every piece.
        places: list[tuple[int, int]] = []
        for number, (piece, offset) in enumerate(self.pieces):
            at = joined.find(piece)
            while at >= 0:
                places.append((at - offset, number))
                at = joined.find(piece, at + 1)
        places.sort()
        starts = set()
        for i, (start, number) in enumerate(places):
            j = i + 1
            while j < len(places) and places[j][0] - start <= self.errors:
                if places[j][1] != number:
                    starts |= {start, places[j][0]}
                    break
                j += 1
        out: list[tuple[int, int, int]] = []
        e = self.errors
        clusters: list[list[int]] = []
        for s in sorted(starts):
            if clusters and s - clusters[-1][1] <= 2 * e + 1:
                clusters[-1][1] = s
            else:
                clusters.append([s, s])
        for lo, hi in clusters:
            at, end = max(0, lo - e, out[-1][1] if out else 0), hi + len(self.text) + 2 * e
            while m := self.pattern.search(joined, at, end):
                out.append((*m.span(), sum(m.fuzzy_counts)))
                at = max(m.end(), at + 1)
        return out


def best(found: list[dict]) -> list[dict]:
    """The notices that no better one overlaps, taken by score, then length, then place; in order of place."""
    starts: list[int] = []
    kept: list[dict] = []
    for x in sorted(found, key=lambda x: (-x["score"], x["start"] - x["end"], x["start"], x["label"])):
        i = bisect_left(starts, x["start"])
        if (i == 0 or kept[i - 1]["end"] <= x["start"]) and (i == len(kept) or x["end"] <= kept[i]["start"]):
            starts.insert(i, x["start"])
            kept.insert(i, x)
    return kept


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES, per_error: int = PER_ERROR
) -> DataFrame:
    """key, n_words, base array<struct<word, label>> and fuzzy array<struct<start, end, errors, score, label>>.

    ``word`` is the number of the phrase's first word; start and end are words, end exclusive. The
    score of a notice is 1 - errors / length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        seekers = [Notice(t, label, per_error) for t, label in notices]

        def block(keys, texts):
            counts, base, fuzzy = [], [], []
            for t in texts:
                words = plain_words(t)
                joined = (b" " + b" ".join(words) + b" ").decode()
                exact = []
                for phrase, label in phrases:
                    sought = f" {phrase} "
                    at, word, seen = joined.find(sought), 0, 0
                    while at >= 0:
                        word += joined.count(" ", seen, at)
                        seen = at
                        exact.append({"word": word, "label": label})
                        at = joined.find(sought, at + 1)
                near = []
                hits = [(s, *hit) for s in seekers for hit in s.find(joined)]
                if hits:
                    spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
                    before = lambda at: int(np.searchsorted(spaces, at))  # noqa: B023,E731
                    for s, a, b, errors in hits:
                        near.append({
                            "start": max(0, before(a + 1) - 1), "end": before(b),
                            "errors": errors, "score": 1.0 - errors / len(s.text), "label": s.label,
                        })
                counts.append(len(words))
                base.append(exact)
                fuzzy.append(best(near))
            return [keys, counts, base, fuzzy]

        return block

    schema = (
        f"{key} {kind}, n_words bigint, base array<struct<word: bigint, label: string>>, "
        "fuzzy array<struct<start: bigint, end: bigint, errors: int, score: double, label: string>>"
    )
    return map_columns(docs, [key, text], schema, make)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    labels = lambda *c: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*c))))
    base = F.transform("base", lambda x: x["label"])
    fuzzy = F.transform("fuzzy", lambda x: x["label"])
    places = F.transform("base", lambda x: x["word"])
    return found.select(
        key, "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"), labels(base, fuzzy).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("fuzzy", lambda x: x["score"])), F.lit(0.0))
        ).alias("score"),
    )
