"""Trained classifiers against plain loops: tables and trees of the additive model, folds and stages of the chain."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from issuerlake.llm import quality, toxicity
from issuerlake.llm.common import plain_words

# --- additive model ----------------------------------------------------------------------------


def worth(rows, g, h):
    return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + quality.PRIOR)


def value(rows, g, h):
    return sum(g[i] for i in rows) / (sum(h[i] for i in rows) + quality.PRIOR)


def best_cut(bins, rows, low, high, g, h):
    """(gain, cut) of the best cut of the rows whose bins are low to high - 1; of equal gains the first cut."""
    best = (0.0, 0)
    for cut in range(low + 1, high):
        left, right = [i for i in rows if bins[i] < cut], [i for i in rows if bins[i] >= cut]
        rise = worth(left, g, h) + worth(right, g, h) - worth(rows, g, h)
        if cut == low + 1 or rise > best[0] + 1e-12:
            best = (rise, cut)
    return best


def tree(bins, n, g, h):
    """A value per bin of the tree with three leaves, cut where the gain is greatest."""
    leaves = [(0, n)]
    for _ in range(2):
        cuts = [(*best_cut(bins, [i for i in range(len(g)) if a <= bins[i] < b], a, b, g, h), k) for k, (a, b) in enumerate(leaves)]
        rise, cut, k = max(cuts, key=lambda c: (c[0], c[1] - leaves[c[2]][0], c[2]))
        if rise <= 1e-9:
            break
        a, b = leaves[k]
        leaves[k : k + 1] = [(a, cut), (cut, b)]
    out = [0.0] * n
    for a, b in leaves:
        own = [i for i in range(len(g)) if a <= bins[i] < b]
        for x in range(a, b):
            out[x] = value(own, g, h)
    return out


def bins_of(column, edges):
    return [sum(1 for e in edges if e <= x) for x in column]


def pair_tree(p, q, np_, nq, g, h):
    """(gain, table) of the best tree that cuts one feature, and either half by the other."""
    best, table = 0.0, [[0.0] * nq for _ in range(np_)]
    rows = range(len(g))
    for turn in (False, True):
        (u, nu), (v, nv) = ((q, nq), (p, np_)) if turn else ((p, np_), (q, nq))
        for cut in range(1, nu):
            rise, made = -worth(rows, g, h), {}
            for a, b in ((0, cut), (cut, nu)):
                half = [i for i in rows if a <= u[i] < b]
                _, at = best_cut(v, half, 0, nv, g, h)
                for c, d in ((0, at), (at, nv)):
                    if d > c:
                        leaf = [i for i in half if c <= v[i] < d]
                        rise += worth(leaf, g, h)
                        for x in range(a, b):
                            for y in range(c, d):
                                made[x, y] = value(leaf, g, h)
            if rise > best + 1e-12:
                best, table = rise, [[made[(y, x) if turn else (x, y)] for y in range(nq)] for x in range(np_)]
    return best, table


def plain_fit(x, y):
    share = (sum(y) + 1) / (len(y) + 2)
    total = [math.log(share / (1 - share))] * len(y)
    edges = [quality.quantiles(x[:, j], quality.BINS).tolist() for j in range(x.shape[1])]
    coarse = [quality.quantiles(x[:, j], quality.PAIR_BINS).tolist() for j in range(x.shape[1])]
    fine = [bins_of(x[:, j], e) for j, e in enumerate(edges)]
    rough = [bins_of(x[:, j], e) for j, e in enumerate(coarse)]

    def slopes():
        p = [1 / (1 + math.exp(-t)) for t in total]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    for _ in range(quality.ROUNDS):
        for j, bins in enumerate(fine):
            made = tree(bins, len(edges[j]) + 1, *slopes())
            total = [t + quality.RATE * made[b] for t, b in zip(total, bins)]
    grid = lambda a, b: pair_tree(rough[a], rough[b], len(coarse[a]) + 1, len(coarse[b]) + 1, *slopes())
    pairs = sorted(((grid(a, b)[0], a, b) for a in range(x.shape[1]) for b in range(a)), reverse=True)[: quality.PAIRS]
    for _ in range(quality.PAIR_ROUNDS):
        for _, a, b in pairs:
            made = grid(a, b)[1]
            total = [t + quality.RATE * made[u][v] for t, u, v in zip(total, rough[a], rough[b])]
    return [(a, b) for _, a, b in pairs], [1 / (1 + math.exp(-t)) for t in total]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_additive_model_equals_plain_loops(monkeypatch, seed):
    for name, small in (("BINS", 6), ("PAIR_BINS", 4), ("ROUNDS", 6), ("PAIR_ROUNDS", 4), ("PAIRS", 2)):
        monkeypatch.setattr(quality, name, small)
    rng = np.random.default_rng(seed)
    x = np.c_[rng.random(70), rng.integers(0, 4, 70), rng.normal(size=70), np.full(70, 2.0)]
    y = ((x[:, 0] > 0.4) ^ (x[:, 2] > 0) | (x[:, 1] == 3)).astype(float)
    pairs, scores = plain_fit(x, y.tolist())
    model = quality.fit(x, y)
    assert [(a, b) for a, b, _ in model.pairs] == pairs
    assert np.allclose(model.scores(x), scores, atol=1e-9)


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    model = quality.fit(x[:200], (x[:200, 0] * x[:200, 1] > 0).astype(float))
    for row, s in zip(x, model.scores(x)):
        total = model.base
        for j, v in enumerate(row):
            total += model.tables[j][sum(1 for e in model.cuts[j] if e <= v)]
        for a, b, table in model.pairs:
            total += table[sum(1 for e in model.pair_cuts[a] if e <= row[a])][sum(1 for e in model.pair_cuts[b] if e <= row[b])]
        assert s == pytest.approx(1 / (1 + math.exp(-total)))


# --- classifier chain --------------------------------------------------------------------------


def plain_regression(rows, y):
    """Ridge logistic regression by many small steps of gradient descent with a growing step."""
    n, width = len(rows), len(rows[0]) + 1
    x = np.array([[*r, 1.0] for r in rows])
    hold = np.array([toxicity.RIDGE] * (width - 1) + [1e-6]) * max(1.0, n / 1000)
    w = np.zeros(width)
    reach = np.linalg.eigvalsh(x.T @ x / 4).max() + hold.max()
    moved = w.copy()
    for step in range(1, 20_001):  # Nesterov's method
        p = 1 / (1 + np.exp(-(x @ moved)))
        fresh = moved + (x.T @ (y - p) - hold * moved) / reach
        moved = fresh + (step - 1) / (step + 2) * (fresh - w)
        w = fresh
    return w


def plain_chain(x, labels):
    """Weights per category; every category sees the earlier ones as predicted by models that never saw the row."""
    before: list[list[float]] = [[] for _ in x]
    out = []
    for c in range(labels.shape[1]):
        rows = [[*a, *b] for a, b in zip(x, before)]
        out.append(plain_regression(rows, labels[:, c]))
        for k in range(toxicity.FOLDS):
            rest = [i for i in range(len(rows)) if i % toxicity.FOLDS != k]
            w = plain_regression([rows[i] for i in rest], labels[rest, c])
            for i in range(k, len(rows), toxicity.FOLDS):
                before[i] = [*before[i], 1 / (1 + math.exp(-(np.dot(rows[i], w[:-1]) + w[-1])))]
    return out


def test_chain_equals_explicit_folds():
    rng = np.random.default_rng(6)
    traits = [11, 22, 33, 44]
    rows, y = [], []
    for _ in range(60):
        own = sorted(rng.choice(4, int(rng.integers(0, 4)), replace=False).tolist())
        counts = rng.integers(1, 5, len(own)).tolist()
        rows.append((own, counts, int(rng.integers(5, 200))))
        y.append(float((0 in own) ^ (rng.random() < 0.15)))
    y = np.array(y)
    model = toxicity.fit(traits, [0, 1], rows, y)
    x = np.zeros((60, 4))
    for i, (own, counts, _) in enumerate(rows):
        for t, c in zip(own, counts):
            x[i, t] = 1 + 0.3 * math.log(c)
    marked = np.array([max([c for t, c in zip(own, counts) if t in (0, 1)], default=0) for own, counts, _ in rows])
    labels = np.c_[y * (marked / [n for *_, n in rows] > 0.01), y * (marked > 1), y]
    assert labels[:, 0].sum() > 3 and labels[:, 1].sum() > 3
    weights = plain_chain(x.tolist(), labels)
    probabilities = np.zeros((60, 3))
    for c, w in enumerate(weights):
        probabilities[:, c] = 1 / (1 + np.exp(-(np.c_[x, probabilities[:, :c]] @ w[:-1] + w[-1])))
    assert np.allclose(model.probabilities(x), probabilities, atol=2e-3)


def test_traits_are_those_that_tell_labels_apart(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAITS", 6)
    monkeypatch.setattr(toxicity, "MARKERS", 2)
    rng = np.random.default_rng(7)
    texts = [(int(rng.random() < 0.4), " ".join(rng.choice(["alpha", "alphabet", "Beta", "gam", "délta", "x"], 6))) for _ in range(40)]
    texts = [(mark, t + (" vilest word" if mark else " kindly")) for mark, t in texts] + [(0, None), (1, "")]
    rows = spark.createDataFrame([(i, m, t) for i, (m, t) in enumerate(texts)], "__key int, __label int, __text string").repartition(3)
    traits, markers = toxicity.choose_traits(rows)
    n, bad = len(texts), sum(m for m, _ in texts)
    seen = defaultdict(lambda: [0, 0])
    for m, t in texts:
        own = set()
        for w in plain_words(t):
            own |= {b"=" + w, *(w.decode()[:k].encode() for k in toxicity.STEMS if k <= len(w.decode()))}
        for h in {xxhash.xxh32_intdigest(p) for p in own}:
            seen[h][m] += 1
    odds = {h: math.log(((b + 0.5) / (bad + 1)) / ((g + 0.5) / (n - bad + 1))) for h, (g, b) in seen.items()}
    best = sorted((h for h, (g, b) in seen.items() if g + b > 1), key=lambda h: (-abs(odds[h]) * math.sqrt(min(sum(seen[h]), 200)), h))[:6]
    assert traits == sorted(best)
    assert markers == sorted(sorted(best).index(h) for h in best[:2] if odds[h] > 2)
