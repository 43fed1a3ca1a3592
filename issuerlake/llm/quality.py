"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins at quantiles of the fitting sample. Boosting goes round the
features again and again; each step fits a shallow tree to the gradient on the bins of one feature
and adds a little of it to the feature's lookup table. Then the pairs of features that explain most
of what is left get tables of two dimensions the same way. A score is the logistic function of the
sum of looked-up values, so a block of texts is scored by adding columns.

Null counts as empty text, which has features and a score like any other. Texts count whole. Rows
without a label are not learned from; labels that contradict each other both count. Without any
labelled row every score is 0.5.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import filter_rows, map_columns, sample_labels

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bound of the fitting sample: labelled rows taken by hash.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, PRIOR = 32, 12, 250, 60, 6, 0.1, 4.0
THRESHOLD = 0.3
FEATURES = [
    "log_words", "word_length", "distinct_words", "top_word", "repeats", "longest_repeat", "distinct_lines", "line_length",
    "letters", "upper", "digits", "spaces", "symbols", "pipes", "shouts", "beyond_ascii", "wordless", "sentence_length",
    "ended_lines", "bigram_variety", "all_upper_words", "symbol_words",
]
_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 symbol, 6 pipe, 7 shout, 8 beyond ASCII, 9 stop
for _kind, _bytes in enumerate([b"", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\r\v\f",
                                b"#$%&*<>=@^_~{}[]\\/+", b"|", b"!", bytes(range(128, 256)), b".?:;,"]):
    _KIND[list(_bytes)] = _kind
_MARKS = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def features(text: str | None) -> list[float]:
    """Numbers of one text in the order of FEATURES; ratios of nothing are 0."""
    raw = (text or "").encode()
    n = len(raw) or 1
    words = raw.split()
    w = len(words) or 1
    hist = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=10).tolist()
    counts: dict[bytes, int] = {}
    repeats = longest = run = upper = symbol = bare = 0
    before = None
    for x in words:
        counts[x] = counts.get(x, 0) + 1
        if x == before:
            repeats += 1
            run += 1
            if run > longest:
                longest = run
        else:
            run = 0
        before = x
    for x, c in counts.items():
        if x.isupper() and len(x) > 1:
            upper += c
        core = x.translate(_MARKS)
        if core.isspace():
            bare += c
        elif core[-2:] == b"  ":
            symbol += c
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(raw.count(c) for c in (b".", b"?")) or 1
    pairs = len(set(zip(words, words[1:])))
    m = len(lines) or 1
    letters = hist[1] + hist[2] + hist[8]
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / w, len(counts) / w, max(counts.values(), default=0) / w,
        repeats / w, min(longest, 50), len(set(lines)) / m, float(np.log1p(n / m)),
        letters / n, hist[2] / (letters or 1), hist[3] / n, hist[4] / n, hist[5] / n, hist[6] / w, hist[7] / w, hist[8] / n,
        bare / w, float(np.log1p(len(words) / ends)), sum(x.rstrip()[-1:] in (b".", b"?", b"!") for x in lines) / m,
        pairs / max(1, len(words) - 1), upper / w, symbol / w,
    ]


@dataclass
class Model:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)  # per feature, bin edges
    tables: list[np.ndarray] = field(default_factory=list)  # per feature, a value per bin
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"), np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def quantiles(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PRIOR)


def split_at(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, position) of the best cut of a row of bins in two."""
    if len(g) < 2:
        return 0.0, 0
    lg, lh = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rise = gain(lg, lh) + gain(g.sum() - lg, h.sum() - lh) - gain(g.sum(), h.sum())
    at = int(rise.argmax())
    return float(rise[at]), at + 1


def step(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree of few leaves over one feature's bins, fitted to gradients g and weights h."""
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        rise, at, i = max((*split_at(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts))
        if rise <= 1e-9:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + PRIOR)
    return out


def step_pair(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, table) of a tree that cuts one feature and each half by the other."""
    best, table = 0.0, np.zeros(g.shape)
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        total = gain(gg.sum(), hh.sum())
        for cut in range(1, gg.shape[0]):
            rise, made = -total, np.zeros(gg.shape)
            for a, b in ((0, cut), (cut, gg.shape[0])):
                cg, ch = gg[a:b].sum(axis=0), hh[a:b].sum(axis=0)
                _, at = split_at(cg, ch)
                for c, d in ((0, at), (at, len(cg))):
                    if d > c:
                        rise += float(gain(cg[c:d].sum(), ch[c:d].sum()))
                        made[a:b, c:d] = cg[c:d].sum() / (ch[c:d].sum() + PRIOR)
            if rise > best:
                best, table = rise, made.T if turn else made
    return best, table


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y):
        return Model()
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(base=float(np.log(share / (1 - share))))
    width = x.shape[1]
    model.cuts = [quantiles(x[:, j], BINS) for j in range(width)]
    model.pair_cuts = [quantiles(x[:, j], PAIR_BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)

    def slope():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slope()
            n = len(model.tables[j])
            made = RATE * step(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            model.tables[j] += made
            total += made[bins[j]]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    size = [len(c) + 1 for c in model.pair_cuts]

    def grid(a, b):
        g, h = slope()
        at = coarse[a] * size[b] + coarse[b]
        n = size[a] * size[b]
        return at, np.bincount(at, g, n).reshape(size[a], size[b]), np.bincount(at, h, n).reshape(size[a], size[b])

    ranked = sorted(((step_pair(*grid(a, b)[1:])[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    pairs = [(a, b, np.zeros((size[a], size[b]))) for _, a, b in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in pairs:
            at, g, h = grid(a, b)
            made = RATE * step_pair(g, h)[1]
            table += made
            total += made.ravel()[at]
    model.pairs = pairs
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` labelled rows, taken by hash of their key.

    The sample's keys and labels are bounded by that number, so they go to the documents; only the
    features of matching documents come back.
    """
    chosen = sample_labels(labels, key, label, sample_rows)
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("__key")).select("__key", "__label", F.col(text).alias("__text"))

    def make():
        return lambda keys, marks, texts: [keys, marks, [features(t) for t in texts]]

    kind = docs.schema[key].dataType.simpleString()
    got = map_columns(rows, ["__key", "__label", "__text"], f"key {kind}, label int, x array<double>", make)
    # A key may repeat in the documents; the bound holds for the rows that reach the driver, too.
    table = got.orderBy(F.xxhash64("key"), "key", "label", "x").limit(2 * sample_rows).toPandas()
    x = np.array(table["x"].tolist(), float).reshape(len(table), len(FEATURES))
    return fit(x, table["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (0 to 1, higher: better) and the features of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def block(keys, texts):
            x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
            return [keys, shared.value.scores(x).tolist(), x.tolist()]

        return block

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"{key} {kind}, score double, features array<double>", make)


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of ``threshold`` or more, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def block(texts):
            x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
            return shared.value.scores(x) >= threshold

        return block

    return filter_rows(docs, text, make)
