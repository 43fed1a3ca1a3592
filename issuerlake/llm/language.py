"""Language identification with string kernels.

The kernel of two texts is the number of n-grams (n from 1 to ``n_max``, blended) present in both,
divided by the root of the product of their numbers. Landmarks are texts of the learned languages;
only n-grams that occur in a landmark are counted, and all of these. The landmarks' presence matrix is sparse: by
n-gram, the numbers of the landmarks that have it. A text is mapped by its kernel values with the
landmarks and the inverse root of the landmarks' own kernel matrix (Nyström), and one-versus-rest
kernel ridge regression is then a linear map. Blocks of texts are scored by two matrix products.

Letters are lower-cased, everything between them is one space. Texts count whole. A text that is null
or has no letter is ``und`` with score 0. Without any learnable row every text is ``und``. Ties go to
the language that sorts first.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm.common import SHARES, map_columns, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

N_MAX = 3
# Bounds of the fitting sample, all parameters of ``sample`` and ``fit``: languages (those with most texts), rows a language,
# rows in all, and bytes of n-gram hashes in all, shared evenly between the languages (the last row of each is taken
# whole); landmarks a language, and in all.
LANGUAGES, ROWS_PER_LANGUAGE, SAMPLE_ROWS, SAMPLE_BYTES = 500, 200, 10_000, 128_000_000
LANDMARKS_PER_LANGUAGE, LANDMARKS = 24, 2_400
RIDGE = 0.003
SHARPNESS = 6.0
# Texts scored at once, and entries of the presence matrix taken at once.
BLOCK, ENTRIES = 64, 4_000_000


def letters() -> np.ndarray:
    """Code point -> lower-case letter, or a space where it is no letter."""

    def make():
        out = np.full(sys.maxunicode + 1, 32, np.uint32)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        return out

    return worker_cache("letters", make)


def grams(text: str, n_max: int = N_MAX) -> np.ndarray:
    """Hashes of all n-grams of a text, repeated as they occur; empty if there is no letter."""
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate([np.array([32], np.uint32), codes, np.array([32], np.uint32)])
    space = codes == 32
    codes = codes[np.r_[True, ~(space[1:] & space[:-1])]]
    if len(codes) < 3:
        return np.empty(0, np.uint32)
    out, h = [], None
    for n in range(1, n_max + 1):
        tail = codes[n - 1 :]
        if h is None:
            h = tail * np.uint32(0x9E3779B1)
        else:
            h = h[: len(tail)]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + tail * np.uint32(0xC2B2AE35)
        out.append(h ^ (h >> np.uint32(13)) ^ np.uint32(n))
    return np.concatenate(out) * np.uint32(0x27D4EB2F)


@dataclass
class Model:
    languages: list[str]
    hashes: np.ndarray  # n-grams of the landmarks, ascending
    first: np.ndarray  # where the n-grams of every slot (the hash's high bits) begin
    starts: np.ndarray  # where the landmarks of every n-gram begin
    landmarks: np.ndarray  # numbers of landmarks, by n-gram
    sizes: np.ndarray  # n-grams of every landmark
    weights: np.ndarray  # landmark x language: inverse root times ridge solution

    def present(self, text: str | np.ndarray) -> np.ndarray:
        """Numbers of the known n-grams present in a text, or among its n-gram hashes."""
        h = np.unique(grams(text)) if isinstance(text, str) else text
        slot = h >> np.uint32(33 - len(self.first).bit_length())
        at, end = self.first[slot], self.first[slot + np.uint32(1)]
        out = []
        while len(at):  # as often as a slot has n-grams
            inside = at < end
            at, end, h = at[inside], end[inside], h[inside]
            same = self.hashes[at] == h
            out.append(at[same])
            at, end, h = at[~same] + 1, end[~same], h[~same]
        return np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)

    def common(self, known: list[np.ndarray]) -> np.ndarray:
        """text x landmark: how many n-grams are in both."""
        out = np.zeros((len(known), len(self.sizes)), np.float32)
        for i, p in enumerate(known):
            n = np.diff(self.starts)[p]
            for a, b in cuts(n, ENTRIES):
                at = np.repeat(self.starts[p[a:b]] - (np.cumsum(n[a:b]) - n[a:b]), n[a:b]) + np.arange(n[a:b].sum())
                out[i] += np.bincount(self.landmarks[at], minlength=len(self.sizes))
        return out

    def kernel(self, texts: list[str] | list[np.ndarray]) -> np.ndarray:
        known = [self.present(t) for t in texts]
        root = np.sqrt(np.maximum(1, np.array([len(p) for p in known], np.float32)))
        return self.common(known) / root[:, None] / np.sqrt(np.maximum(1, self.sizes)).astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        """text x language, each row positive with sum 1."""
        s = np.concatenate([self.kernel(texts[i : i + BLOCK]) @ self.weights for i in range(0, len(texts), BLOCK)])
        e = np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)


def cuts(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to about ``limit``, one element at least."""
    out, start, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()) if sizes.sum() > limit else ():
        if i > start and total + n > limit:
            out.append((start, i))
            start, total = i, 0
        total += n
    return [*out, (start, len(sizes))]


def fit(
    rows: list[tuple[str, str | np.ndarray]], landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE,
    landmarks: int = LANDMARKS,
) -> Model | None:
    """Model of (language, text or its distinct n-gram hashes) rows; None if no row has a letter."""
    # Hashes stay in the order given.
    rows = sorted(rows, key=lambda r: (r[0], r[1] if isinstance(r[1], str) else ""))
    rows = [(lang, np.unique(grams(t)) if isinstance(t, str) else t) for lang, t in rows]
    by_language: dict[str, list[np.ndarray]] = {}
    for lang, h in rows:
        if len(h):
            by_language.setdefault(lang, []).append(h)
    if not by_language:
        return None
    languages = sorted(by_language)
    wanted = max(1, min(landmarks_per_language, landmarks // len(languages)))
    chosen: list[np.ndarray] = []
    for lang in languages:
        own = by_language[lang]
        step = max(1, len(own) // wanted)
        chosen += own[::step][:wanted]
    flat = np.concatenate(chosen)
    owner = np.repeat(np.arange(len(chosen)), [len(t) for t in chosen])
    order = np.lexsort((owner, flat))
    hashes, starts = np.unique(flat[order], return_index=True)
    bits = min(22, max(8, 2 + len(hashes).bit_length()))
    first = np.searchsorted(hashes >> np.uint32(32 - bits), np.arange((1 << bits) + 1))
    sizes = np.array([len(t) for t in chosen])
    model = Model(languages, hashes, first, np.append(starts, len(flat)), owner[order].astype(np.int32), sizes, np.zeros((len(chosen), 1), np.float32))
    own = model.kernel(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    known = [(number, h) for number, lang in enumerate(languages) for h in by_language[lang]]
    x = np.concatenate([model.kernel([h for _, h in known[i : i + BLOCK]]) for i in range(0, len(known), BLOCK)]) @ root
    numbers = np.array([number for number, _ in known])
    y = np.where(numbers[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    n = (1 / np.bincount(numbers))[numbers][:, None]
    solved = np.linalg.solve(x.T @ (n * x) + ridge * np.eye(x.shape[1]), x.T @ (n * y))
    model.weights = (root @ solved).astype(np.float32)
    return model


def reduced(near: DataFrame) -> DataFrame:
    """lang, h, grams: the distinct n-gram hashes of every text, as bytes; no row without letters."""

    def make():
        return lambda langs, hashes, texts: [langs, hashes, [np.unique(grams(t)).tobytes() for t in texts]]

    return map_columns(near, ["lang", "h", "text"], "lang string, h bigint, grams binary", make).where(F.length("grams") > 0)


def sample(
    docs: DataFrame, text: str = "text", lang: str = "lang", languages: int = LANGUAGES, rows_per_language: int = ROWS_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS, sample_bytes: int | None = None,
) -> list[tuple[str, np.ndarray]]:
    """A bounded sample of the learnable rows: per language about ``rows_per_language`` different texts, by hash.

    Texts of any length are chosen where they are scanned, and reduced there to their distinct n-gram hashes;
    only these move. A language gets fewer rows where they would exceed its share of ``sample_bytes``, but one at
    least. Languages beyond ``languages``, those with fewest texts, are not learned. ``sample_bytes`` is SAMPLE_BYTES if not given.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("known")).orderBy(F.desc("known"), "lang").limit(languages)
    sizes = [tuple(r) for r in sizes.collect()]  # a row per language
    share = (SAMPLE_BYTES if sample_bytes is None else sample_bytes) // max(1, len(sizes))
    sizes = docs.sparkSession.createDataFrame(sizes, "lang string, known bigint")
    near = known.join(F.broadcast(sizes), "lang")
    part = F.least(F.lit(1.0), 1.5 * rows_per_language / F.col("known"))
    near = near.where(F.pmod("h", F.lit(SHARES)) < F.ceil(part * SHARES))
    near = reduced(near).groupBy("lang", "h").agg(F.min("grams").alias("grams"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    first = near.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= rows_per_language)
    total = F.sum(F.length("grams")).over(by_hash.rowsBetween(Window.unboundedPreceding, 0))
    first = first.withColumn("before", total - F.length("grams")).where(F.col("before") < share)
    rows = first.orderBy("n", "lang").limit(sample_rows)
    return [(r["lang"], np.frombuffer(bytes(r["grams"]), np.uint32)) for r in rows.select("lang", "grams").collect()]


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score (0 to 1) and the margin over the second language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def block(keys, texts):
            table = letters()
            some = [i for i, t in enumerate(texts) if t and m is not None and has_letter(t, table)]
            lang, score, margin = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if some:
                p = m.scores([texts[i] for i in some])
                best = p.argmax(axis=1)
                second = np.partition(p, -2, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
                for i, b, row, s in zip(some, best.tolist(), p, second.tolist()):
                    lang[i], score[i], margin[i] = m.languages[b], float(row[b]), float(row[b]) - s
            return [keys, lang, score, margin]

        return block

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"{key} {kind}, lang_pred string, score double, margin double", make)


def has_letter(text: str, table: np.ndarray) -> bool:
    return any(c.isalpha() for c in text[:64]) or bool((table[np.frombuffer(text.encode("utf-32-le"), np.uint32)] != 32).any())
