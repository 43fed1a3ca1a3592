"""Line rules, runs of words and hard negatives against brute force, on small fixtures with every awkward case."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from issuerlake.llm import lines, negatives, periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, words string, n_words bigint, start bigint, __key string, id string, label int"


def documents(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 7, 1, "k", "y", 1) for i, t in zip(ids, texts)], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- line rules --------------------------------------------------------------------------------

PROSE = "The quarterly report of the group was read by all members of the board, and nobody had a question."
RULED = [
    None, "", " \n\t\r\n", "word", PROSE, PROSE + "\n" + PROSE, PROSE + "\nHome | About | Contact | Login\n" + PROSE[::-1] + " end.",
    "home\nAbout us\nContact\nlog in to comment.\n" + PROSE + " " + PROSE[4:], "a b c d e f g h " * 5, "a b c d e f g h i j " * 2 + "x y z",
    "### buy $$$ now %%% here &&& and *** there <<< or >>> " * 4, "Wow!! Such!! deal!! " * 9, "one two three four " * 8,
    "same same same same same same same same other. " * 3, PROSE + "\r\n\r\n" + PROSE + "\r\n", "é ü ñ 中文。 " * 9, "We use cookies. Accept cookies.\n" + PROSE + " It ended.",
    " ".join(f"w{i}" for i in range(30_000)) + ".", "tic tac " * 20_000, "Read more\n" * 5 + PROSE, "a\x0bb\x0cc d e " * 6 + ".",
    " ".join(f"v{i}" for i in range(19)) + ".", " ".join(f"v{i}" for i in range(20)) + ".", PROSE + "\n" + PROSE + "\n" + " ".join(f"k{i}" for i in range(60)),
]


def base_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered)


def test_line_rules_equal_brute_force(spark):
    docs = documents(spark, RULED + RULED[4:6]).repartition(3)
    got = {r["doc_id"]: r for r in lines.digest(lines.measure(docs)).collect()}
    for i, t in enumerate(RULED + RULED[4:6]):
        r, base = got[i], base_counts(t)
        assert tuple(r[c] for c in lines.COUNTS) == base, t
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        lost = Counter()
        for line in (t or "").split("\n"):
            own = WORD.findall(line.lower())
            if own and (rule := lines.verdict(line.lower(), [w.encode() for w in own])) is not None:
                lost[lines.LOST[rule]] += len(own)
        assert {c: r[c] for c in lines.LOST if r[c]} == dict(lost)
        assert r["kept"] == (not failed and 2 * sum(lost.values()) <= base[0])


def test_each_rule_names_its_lines():
    def rule(line):
        found = lines.verdict(line, [w.encode() for w in WORD.findall(line)])
        return None if found is None else lines.LOST[found]

    assert rule("a sentence that ends.") is rule('he said "yes."') is rule("no 5.3 is here. and more text") is rule("終わり。") is None
    assert rule("no end in sight 5.3 and on") == rule("## x ## y. ## z") == rule("wow!! yes!! no!!") == "lost_punctuation"
    assert rule("one | two | three four five. six") == rule("home. about us. login.") == "lost_navigation"
    assert rule("all rights reserved by us.") == rule("no no no no yes.") == "lost_boilerplate"
    assert rule("all rights reserved " + "by some people who wrote a long line about the law " * 2 + "today.") is None


def test_clean_keeps_passing_lines_only(spark):
    last = "Some weeks later a second meeting took place, with other people and the same result for everyone."
    text = f"Home | About | Login | Help\n{PROSE}\n\n{last}\nRead more"
    docs = documents(spark, [text, "junk", None, text], [1, 2, None, 1])
    kept = lines.clean(docs)
    assert kept.columns == ["doc_id", "text"]
    assert [tuple(r) for r in kept.collect()] == [(1, f"{PROSE}\n\n{last}")] * 2
    assert lines.digest(lines.measure(documents(spark, []))).count() == 0


# --- runs of words -----------------------------------------------------------------------------


def brute_runs(words):
    """Every longest stretch of every period, where no divisor of the period is one too."""
    found = []
    a = [hash(w) for w in words]
    for q in range(1, len(a) // 4 + 1):
        i = 0
        while i + q < len(a):
            j = i
            while j + q < len(a) and a[j] == a[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(q % p == 0 and all(a[k] == a[k + p] for k in range(i, i + n - p)) for p in range(1, q)):
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found)


def repetitive():
    rng = np.random.default_rng(4)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"], list("abcabcabcab"), list("abcabcabcabc"), ["x"] * 4000]
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a
    out.append(list(b))
    out.append([str(bin(i).count("1") % 2) for i in range(512)])
    for i in range(120):
        letters = list("abcd")[: 2 + i % 3]
        root = rng.choice(letters, int(rng.integers(1, 12))).tolist()
        noise = rng.choice(letters, int(rng.integers(0, 40))).tolist()
        out.append(noise + root * int(rng.integers(2, 9)) + root[: int(rng.integers(0, len(root) + 1))] + noise[::-1] + root * 4)
    for q in (37, 64, 129):
        root = [f"w{i}" for i in range(q)]
        out.append(["s"] + root * 5 + root[:7] + ["t"] + root * 3)
        out.append((root[: q // 2] * 4 + ["."]) * 4)
    return out


def test_runs_equal_brute_force():
    texts = repetitive()
    assert periodic.runs_of(texts) == [brute_runs(t) for t in texts]
    assert [periodic.runs_of([t])[0] for t in texts[:20]] == [brute_runs(t) for t in texts[:20]]
    assert periodic.runs_of([]) == []


def test_transform_is_a_convolution():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, periodic.PRIME, (2, 3, 16))
    product = periodic.transform(periodic.transform(a) * periodic.transform(b) % periodic.PRIME, inverse=True) * pow(16, periodic.PRIME - 2, periodic.PRIME) % periodic.PRIME
    want = [[sum(int(x[i]) * int(y[(k - i) % 16]) for i in range(16)) % periodic.PRIME for k in range(16)] for x, y in zip(a, b)]
    assert product.tolist() == want


def test_false_zeros_are_no_runs(monkeypatch):
    """With a tiny prime sums vanish by chance all the time; comparing the words finds the same runs."""
    texts = repetitive()
    want = periodic.runs_of(texts)
    monkeypatch.setattr(periodic, "PRIME", 97)  # 96 = 3 * 2**5
    monkeypatch.setattr(periodic, "ROOT", 5)
    monkeypatch.setattr(periodic, "_twiddles", {})
    short = [t for t in texts if len(t) < 64]
    assert periodic.runs_of(short) == [w for t, w in zip(texts, want) if len(t) < 64]


def test_periodic_digest_equals_brute_force(spark):
    texts = [None, "", " \n ", *(" ".join(t) for t in repetitive()[:60]), "Ab ab " * 3, "é\x0bü\x0c " * 5, "go " * 30_000]
    ids = [*range(0, 2 * len(texts), 2)]
    ids[-1], ids[5] = None, ids[6]
    got = periodic.digest(documents(spark, texts, ids).repartition(3), rewrite=periodic.repeat_tail).collect()
    want, changed = [], 0
    for i, t in zip(ids, texts):
        w = WORD.findall(t or "")
        h = zlib.crc32(("" if i is None else str(i)).encode())
        if h % 10 == 0 and w:
            changed += 1
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(w) if len(w) < 20_000 else [(0, len(w), 1)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                     sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    assert changed > 3
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    found = {r["doc_id"]: r for r in periodic.find(documents(spark, ["x y x y x y x y z"])).collect()}
    assert [tuple(r) for r in found[0]["runs"]] == [(0, 8, 2)] and found[0]["collapsed"] == "x y z"
    assert periodic.digest(documents(spark, [])).count() == 0


# --- hard negatives ----------------------------------------------------------------------------


def brute_negatives(rows, anchors, n_positives=5, n_negatives=10):
    out = []
    for a, la, va in anchors:
        scored = sorted((-int(va @ v), i, label == la) for i, label, v in rows if i != a and len(v) == len(va))
        for p, pid, _ in [s for s in scored if s[2]][:n_positives]:
            band = [s for s in scored if not s[2] and -30 * p <= -100 * s[0] <= -90 * p][:n_negatives]
            out += [(a, pid, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(band)]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):  # one label holds a third of the rows, some directions are common
        center = np.eye(6)[i % 3] * 2
        rows.append((i, (center + rng.normal(size=6) * 0.4).tolist(), 0 if i % 3 == 0 else int(rng.integers(0, 5))))
    rows += [(500 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], i % 2) for i in range(60)]  # ties
    rows += [(800, [0.0] * 6, 1), (900, [-1.0] * 6, 2), (20, rows[21][1], 3), (40, rows[40][1], rows[40][2]), (1000, [1.0, 2.0], 0), (1020, [2.0, 1.0], 0),
             (1040, [2.5, 1.5], 1), (1100, None, 1), (1200, [1.0] * 6, None), (None, [1.0] * 6, 1), (1300, [float("nan")] * 6, 1), (1400, [None] * 6, 1),
             (1500, [float("inf")] * 6, 1), (1600, [], 1), (1700, [], 1), (1720, [], 2)]
    return rows


@pytest.mark.parametrize("block_bytes,list_rows,members", [(16_000_000, 32_768, 4), (700, 37, 2)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_bytes, list_rows, members):
    monkeypatch.setattr(negatives, "LIST_ROWS", list_rows)
    monkeypatch.setattr(negatives, "STEP", 3)
    rows = vector_rows()
    schema = "vec_id bigint, embedding array<double>, label int, id string, v string, score double, cluster int"
    df = spark.createDataFrame([(*r, "x", "y", 0.5, 1) for r in rows], schema).repartition(4)
    prepared = negatives.prepare(df, "vec_id", "embedding", "label")
    got = negatives.mine(prepared.where("id % 20 = 0"), prepared, block_bytes=block_bytes)
    good = [(i, lab, np.floor(256 * np.array(v, float)).astype(int)) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = list({(i, lab, tuple(v)): (i, lab, v) for i, lab, v in good if i % 20 == 0}.values())
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(good, anchors)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_hard_negatives_of_empty_tables(spark):
    empty = negatives.prepare(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int"), "vec_id", "embedding", "label")
    assert negatives.mine(empty, empty).count() == 0
    one = negatives.prepare(spark.createDataFrame([(0, [1.0], 1)], "vec_id bigint, embedding array<float>, label int"), "vec_id", "embedding", "label")
    assert negatives.mine(one, one).count() == 0 and negatives.mine(one, empty).count() == 0


def test_walks_end_at_the_bound(monkeypatch):
    """Where directions differ, members leave most of a list unread, and find what a full reading finds."""
    rng = np.random.default_rng(3)
    centers = np.eye(8)[rng.integers(0, 8, 4000)] * 300
    m = np.floor(centers + rng.normal(size=(4000, 8)) * 9)
    labels = rng.integers(0, 3, 4000)
    rows = sorted(({"id": i, "label": int(labels[i]), "v": m[i].tolist(), "cluster": int(centers[i].argmax())} for i in range(0, 4000, 100)),
                  key=lambda r: (r["cluster"], r["id"]))
    block = negatives.Block(rows)
    read, found = [], {}
    monkeypatch.setattr(negatives.np, "rint", lambda s, f=np.rint: read.append(s.size) or f(s))
    norms, units = negatives.directions(m)
    for c in block.clusters:
        best = negatives.Best(c[3] - c[2], 5)
        negatives.walk(block, best, *c, np.arange(4000), labels, m, norms, units)
        for p, i, s in zip(*(x.tolist() for x in best.hits)):
            found.setdefault(p + c[2], []).append((-s, i))
    assert sum(read) < 0.3 * len(rows) * len(m)
    for p, r in enumerate(rows):
        want = sorted((-int(m[i] @ m[r["id"]]), i) for i in range(4000) if i != r["id"] and labels[i] == r["label"])[:5]
        assert found[p] == want


def test_search_spans_batches(spark):
    """Rows of a task are sorted in lists of limited size; hits of earlier lists bound the later ones."""
    df = spark.createDataFrame([(i, 0, [i % 7, 1]) for i in range(50)], "id bigint, label bigint, v array<bigint>").coalesce(1)
    block = negatives.Block([{"id": 3, "label": 0, "v": [1, 0], "cluster": 0}])
    got = negatives.search(df, block, 4).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in got] == [(6, 6), (13, 6), (20, 6), (27, 6)]
