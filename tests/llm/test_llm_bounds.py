"""Many languages, long benchmarks, chains of notices, repeated queries: what bounded memory must not lose."""

from __future__ import annotations

import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from issuerlake.llm import bpe, contamination, language, licenses, topk

NAMES = "doc_id bigint, text string, __text string, __key bigint, n_words int, spans string, items string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, "s", "i") for i, t in enumerate(texts)], NAMES)


# --- language ----------------------------------------------------------------------------------


def made_up_languages(n, per, seed=1):
    """Texts of n languages, each with syllables of its own."""
    rng = np.random.default_rng(seed)
    letters = [chr(c) for c in [*range(97, 123), *range(0x3B1, 0x3C9), *range(0x430, 0x450), *range(0x561, 0x587)]]
    syllables = [["".join(rng.choice(letters, 3)) for _ in range(40)] for _ in range(n)]
    return [(f"l{i:03}", " ".join("".join(rng.choice(syllables[i], 2)) for _ in range(60))) for i in range(n) for _ in range(per)]


def test_three_hundred_languages_are_told_apart():
    rows = made_up_languages(300, 10)
    learn, held = [r for i, r in enumerate(rows) if i % 10 > 1], [r for i, r in enumerate(rows) if i % 10 <= 1]
    model = language.fit(learn)
    assert len(model.languages) == 300 and len(model.sizes) <= language.LANDMARKS
    # No n-gram of a landmark is lost, and what is sent to the tasks is as large as the landmarks' n-grams.
    assert len(model.hashes) == len(np.unique(model.hashes)) and len(model.landmarks) == model.sizes.sum()
    for t in [t for _, t in learn[:50]]:
        h = np.unique(language.grams(t))
        assert model.present(t).tolist() == np.flatnonzero(np.isin(model.hashes, h)).tolist()
    assert model.landmarks.nbytes + model.hashes.nbytes + model.starts.nbytes + model.first.nbytes < 64_000_000
    found = model.scores([t for _, t in held]).argmax(axis=1)
    assert np.mean([model.languages[i] == lang for i, (lang, _) in zip(found, held)]) > 0.98


def test_kernel_equals_sets(monkeypatch):
    rows = sorted(made_up_languages(5, 8))
    model = language.fit(rows, landmarks_per_language=3)
    sets = [set(np.unique(language.grams(t)).tolist()) for _, t in rows]
    known = set(model.hashes.tolist())
    chosen = [s for n, s in enumerate(sets) if n % 8 in (0, 2, 4)]
    want = [[len(a & b) / np.sqrt(len(a & known) * len(b)) for b in chosen] for a in sets]
    assert np.allclose(model.kernel([t for _, t in rows]), want, atol=1e-5)
    whole = model.kernel([t for _, t in rows])
    monkeypatch.setattr(language, "ENTRIES", 7)
    assert np.array_equal(model.kernel([t for _, t in rows]), whole)


# --- decontamination ---------------------------------------------------------------------------


def test_blocks_bound_the_windows(spark):
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "lone"), (3, None), (4, " ".join(words[:12]))], "item_id bigint, text string")
    blocks = list(contamination.item_blocks(items, "item_id", "text", 10, 7 * contamination.WINDOW_BYTES))
    sizes = [sum(len(w) - n + 1 for _, w, n in b) for b in blocks]
    assert max(sizes) == 7 and sum(sizes) == 51 + 1 + 3
    docs = documents(spark, [" ".join(words), "x " + " ".join(words[20:32]), "lone wolf", None, "", " ".join(words[:9]), " ".join(words[3:13] * 2)])
    small = contamination.digest(contamination.search(docs, items, block_bytes=20 * contamination.WINDOW_BYTES))
    whole = contamination.digest(contamination.search(docs, items))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, whole.collect()))
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in whole.collect()} == {0: (60, 2), 1: (12, 1), 2: (1, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (20, 1)}
    assert sorted(r["doc_id"] for r in contamination.drop_contaminated(docs, items, block_bytes=20 * contamination.WINDOW_BYTES).collect()) == [3, 4, 5]


def test_windows_with_a_common_end_are_found_at_once():
    items = [(str(i), [*(f"a{i}x{j}".encode() for j in range(8)), b"common", b"end"], 10) for i in range(30_000)]
    searcher = contamination.Searcher(items)
    words = [w for i in range(0, 30_000, 10) for w in items[i][1]]
    start = time.perf_counter()
    spans, names = searcher.find(words)
    assert spans == [(0, len(words))] and len(names) == 3_000
    assert time.perf_counter() - start < 2


# --- licenses ----------------------------------------------------------------------------------


def test_errors_allowed_and_one_more(spark):
    texts = ["Licenced under the Apach License, Versoin 2.0", "Licenced undr the Apach License, Versoin 2.0"]
    got = {r["doc_id"]: r["labels"] for r in licenses.digest(licenses.scan(documents(spark, texts))).collect()}
    assert len(licenses.NOTICES[0][0]) // licenses.PER_ERROR == 4
    assert got == {0: "apache-2.0", 1: ""}


def test_a_chain_of_notices_keeps_both_ends():
    a, b, c = ({"start": s, "end": e, "score": x, "label": n, "errors": 0} for s, e, x, n in ((0, 6, 0.8, "a"), (4, 10, 0.9, "b"), (9, 14, 1.0, "c")))
    assert [x["label"] for x in licenses.best([a, b, c])] == ["a", "c"]
    assert [x["label"] for x in licenses.best([b, a])] == ["b"]
    rng = np.random.default_rng(3)
    for _ in range(200):
        found = [{"start": int(s), "end": int(s + rng.integers(1, 9)), "score": float(rng.integers(5)), "label": str(i)} for i, s in enumerate(rng.integers(0, 40, 12))]
        want = []
        for x in sorted(found, key=lambda x: (-x["score"], x["start"] - x["end"], x["start"], x["label"])):
            if all(x["end"] <= y["start"] or y["end"] <= x["start"] for y in want):
                want.append(x)
        assert licenses.best(found) == sorted(want, key=lambda x: x["start"])


def edit_distance_below(a, b, limit):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] <= limit


def test_fuzzy_spans_equal_brute_force():
    """Every occurrence within the errors is found, and every span found is one."""
    rng = np.random.default_rng(9)
    notice = licenses.Notice("released under the mit license", "mit", licenses.PER_ERROR)
    for _ in range(60):
        letters = list(notice.text)
        for _ in range(int(rng.integers(0, 5))):
            at = int(rng.integers(len(letters)))
            letters[at : at + 1] = rng.choice(["", "q", "qz"], 1).tolist()
        text = " some words " + "".join(letters) + " and more "
        spans = notice.find(text)
        possible = any(edit_distance_below(text[i:j], notice.text, notice.errors) for i in range(8, 16) for j in range(len(text) - 14, len(text) - 6))
        assert bool(spans) == possible
        assert all(edit_distance_below(text[a:b], notice.text, e) and e <= notice.errors for a, b, e in spans)


@pytest.mark.parametrize("piece", ["license version ", "licensed under the ", "general public license ", "cc by 4 0 "])
def test_texts_full_of_seeds_take_linear_time(piece):
    def seconds(size):
        text = " " + piece * (size // len(piece))
        start = time.perf_counter()
        for t, label in licenses.NOTICES:
            licenses.Notice(t, label, licenses.PER_ERROR).find(text)
        return time.perf_counter() - start

    small = seconds(30_000)
    assert seconds(240_000) < max(4, 20 * small)


# --- top-k and BPE -----------------------------------------------------------------------------


def test_queries_of_one_id_are_asked_each_for_itself(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 60)] + [(50, [0.0, 5.0]), (50, [0.0, 5.0]), (50, [3.0, -2.0])]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3), "vec_id", "embedding")
    got = topk.search(vectors.where("id = 50"), vectors, k=3, block_queries=2)
    ints = [(i, [int(256 * x) for x in v]) for i, v in rows]
    want = []
    for q in {tuple(v) for i, v in ints if i == 50}:
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ints if i != 50)[:3]
        want += [(50, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_digest_decodes_ids(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    m = bpe.Merges(bpe.read_vocabulary(path))
    t = Tokenizer.from_file(path)
    text = "Some text, <|endoftext|> with special tokens and 中文"
    ids = t.encode(text, add_special_tokens=False).ids
    assert m.decode([b"%d" % i for i in ids]).decode() == t.decode(ids, skip_special_tokens=False)
    assert m.decode([b"99999999", b"518"]) == b"the</w>" and m.decode([]) == b""
