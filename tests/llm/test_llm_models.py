"""HTML extraction against hand-made truth; classifiers by accuracy on labels held out."""

from __future__ import annotations

import os
import time
import zlib

import numpy as np
import pytest

from issuerlake.llm import html, language, quality, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.path.join(os.path.dirname(SF), "sf0.01")
needs_data = pytest.mark.skipif(not os.path.isdir(LARGER), reason="test tables not present")


# --- HTML --------------------------------------------------------------------------------------

SIDE = '<div id="header">Site</div><ul class="menu"><li><a href=x>Home</a><li>About</ul>'
PAGES = {
    1: (f"<body>{SIDE}<div class='content'><h2>Title</h2><p>A &eacute;&nbsp;b <a href=q>link</a> c.<p>Two<br>lines.<div class=advert>Buy now</div>"
        "<p>End.</div><div class=comments><p>nice post</div><form>Sign <input>up</form><div class=cookie-notice>cookies</div></body>",
        "Title\n\nA é b link c.\n\nTwo lines.\n\nEnd."),
    2: ("<html><head><title>T</title></head><body><nav>n</nav><article><header>by me</header><h1>H &amp;amp; x</h1><p>one\n\t two</p><aside>see also</aside>"
        "<ul><li>a<li>b</ul><script>var a='</p>';</script><p>.</p></article><article class='comment'>c</article><footer>f</footer></body></html>",
        "H &amp; x\n\none two\n\na\n\nb\n\n."),
    3: (None, ""), 4: ("", ""), 5: ("plain words", "plain words"), 6: ("<p></p><!-- c --> \n", ""), 7: ("<nav>only menus</nav>", ""),
    8: ("<main><p>x<!-- hidden -->y &#x41;&#66; &unknown; &amp</p><table><tr><td>1<td>2</table></main>", "xy AB &unknown; &\n\n1\n\n2"),
    9: ("<article><p>never closed <b>bold<p>next", "never closed bold\n\nnext"),
    10: ("<article>" + "<p>long text here</p>" * 20_000 + "</article>", "\n\n".join(["long text here"] * 20_000)),
    11: ("<b>" * 20_000 + "deep" + "</i>" * 20_000, "deep"),
    # Names alone cut no element that holds the article.
    12: ('<article class="post no-sidebar"><p>one two three</p></article><div class=sidebar>s</div>', "one two three"),
    13: ('<div class="site has-banner"><main><p>one two three</p></main><div class="banner">b</div></div>', "one two three"),
    14: ('<section id="ad-hoc-networks"><p>one two three</p><p>four</p></section>', "one two three\n\nfour"),
    15: ('<div id="sharing-economy"><p>one two three</p></div><footer>f</footer>', "one two three"),
    16: ("<body><form>" + SIDE + "<p>" + "words of a whole page in a form " * 5 + "</p></form></body>", ("words of a whole page in a form " * 5).strip()),
    17: ("<form><article>one two</article><div class=comments>" + "<p>nice</p>" * 9 + "</div></form>", "one two"),
    18: ("<div class=wrap><p>" + "main text " * 30 + "</p><div class='article-comments'>" + "<p>I think so too.</p>" * 20 + "</div></div>", ("main text " * 30).strip()),
    # Quotes that are not closed end with their tag.
    19: ('<p title="abc>one two</p><p class="x">three</p>', "one two\n\nthree"), 20: ("<p title='a < b > c'>kept</p>", "kept"),
    21: ('<p title="abc' + " x" * 5000, ""), 22: ("a < b and c <3 d", "a < b and c <3 d"), 23: ("<p>x<![CDATA[<b>]]>y</p", "x<b>y"),
}


def test_main_text_of_pages(spark):
    rows = [(i, f"u{i}", h, "clash") for i, (h, _) in PAGES.items()] + [(1, "u1", PAGES[1][0], "again"), (None, None, "<p>x</p>", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(3)
    got = html.extract(pages, html.train(pages), ["page_id", "url"])
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in got.collect()]
    want = [(i, t, len(t)) for i, (_, t) in PAGES.items()] + [(1, PAGES[1][1], len(PAGES[1][1])), (None, "x", 1)]
    assert sorted(found, key=str) == sorted(want, key=str)
    # Without any labelled page the prior weights serve.
    plain = {r["page_id"]: r["text"] for r in html.extract(pages, html.train(pages.limit(0)), ["page_id"]).collect()}
    assert all(plain[i] == t for i, (_, t) in PAGES.items())


def test_weights_are_learned():
    """Names that no list has, and listed names of an element that holds articles, are told apart by labelled pages only."""
    junk, body = "<div class='zzteaser'>" + "read this too now " * 6 + "</div>", "<p>" + "words of the article itself " * 6 + "</p>"
    found: dict = {}
    for _ in range(30):
        for page in (f"{junk}<article>{body}</article>{junk}", f"<div class=promo><article>{body}</article></div><div>{'x ' * 30}</div>"):
            for name, a, b in html.counts(page):
                x = found.setdefault(name, [0, 0])
                x[0], x[1] = x[0] + a, x[1] + b
    weights = {k: html.log_odds(k, *v) for k, v in found.items()}
    text = ("words of the article itself " * 6).strip()
    pages = {f"{junk}{body}{junk}": text, f"<div class=promo>{body}</div><p>some other line of words at the end of it all</p>": None}
    first, second = pages
    assert html.Page(first).text(weights) == text and html.Page(first).text({}) != text
    assert html.Page(second).text(weights).startswith(text) and text not in html.Page(second).text({})


@pytest.mark.parametrize("piece", [
    '<p title="ab ', '<a href="x>y ', "<a ", "<!--", "<![CDATA[", "</", "<p '\"", "<article>x", '<div class="ad">x', "<p a=\"b\" c='d' e>t", "<title>", "<p <", '"<p a="',
])
def test_malformed_pages_take_linear_time(piece):
    def seconds(size):
        source = piece * (size // len(piece))
        start = time.perf_counter()
        html.Page(source).text({})
        html.counts(source)
        return time.perf_counter() - start

    small = seconds(125_000)
    assert seconds(1_000_000) < max(1.0, 20 * small)


def test_pages_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html.train(pages) == {} and html.extract(pages, {}, ["page_id"]).count() == 0


@needs_data
def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{LARGER}/pages.parquet")
    texts = {" ".join(r["text"].split()) for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    got = html.extract(pages, html.train(pages), ["page_id"]).collect()
    assert len(got) == pages.count()
    assert all(" ".join(r["text"].split("\n\n", 1)[1].split()) in texts for r in got)


def test_region_is_the_best_scoring_one():
    rng = np.random.default_rng(8)
    for _ in range(30):
        parts = [str(rng.choice(["<p>w w w</p>", "<ul><li><a>x</a></li></ul>", "<hr>", "<td>", "w", "<a>l</a>"])) for _ in range(12)]
        page = html.Page("".join(parts))
        weights = {"words": 10.0, "links": -20.0, "tag:p": -1.0, "tag:li": -9.0, "tag:hr": -3.0}
        scores = np.zeros(page.length)
        for position, tag in page.tags:
            scores[position] = html.bounded(weights.get("tag:" + tag, 0.0), html.TAG_RANGE)
        for text, _, _, position in page.segments:
            link = position in page.links
            scores[position] = len(text.split()) * html.bounded(weights["links" if link else "words"], html.LINK_RANGE if link else html.WORD_RANGE)
        best = max([0.0, *(scores[a:b].sum() for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])
        a, b = page.region(weights)
        assert scores[a:b].sum() == pytest.approx(best)


# --- quality -----------------------------------------------------------------------------------


@needs_data
def test_quality_of_held_out_labels(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    learn = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    model = quality.train(docs, learn)
    assert len(model.pairs) == quality.PAIRS
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[i] >= quality.THRESHOLD) == bool(m) for i, m in marks.items() if fold(i) == 0 and m is not None]
    assert np.mean(held) > 0.97
    kept = {r["doc_id"] for r in quality.keep_good(docs, model).collect()}
    assert kept == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    # Labels of the other rows have no influence, nor does the order of rows.
    assert {r["doc_id"]: r["score"] for r in quality.score(docs, quality.train(docs.repartition(5), learn)).collect()} == scores


def test_quality_learns_interactions():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert {model.pairs[0][:2]} == {(1, 0)}
    assert ((model.scores(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.95


def test_quality_of_awkward_rows(spark):
    texts = [None, "", " ", "a", "word " * 200_000, "é" * 1000, "a", "|" * 50]
    docs = spark.createDataFrame([(i, t, 9.9, "q") for i, t in enumerate(texts)] + [(None, "x", 0.0, "q")], "doc_id bigint, text string, score double, features string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1), (3, 0), (7, 0), (99, 1), (None, 1), (4, None), (5, 7)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    scores = quality.score(docs, model).collect()
    assert len(scores) == 9 and all(0 <= r["score"] <= 1 for r in scores)
    by = {r["doc_id"]: r["score"] for r in scores}
    assert by[0] == by[1] and by[3] == by[6]
    assert quality.keep_good(docs, model, threshold=0.0).columns == docs.columns
    nothing = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


# --- language ----------------------------------------------------------------------------------


@needs_data
def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    learn = docs.where("crc32(cast(doc_id as string)) % 3 <> 1")
    model = language.fit(language.sample(learn))
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    again = language.predict(docs.repartition(7), language.fit(language.sample(learn.repartition(3)))).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in again} == {i: r["lang_pred"] for i, r in got.items()}


def test_language_of_awkward_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"), (5, "123 !!", "en"), (6, "the dog", None),
            (7, "THE CAT", "xx"), (None, "le chien", "fr"), (8, "the cat " * 50_000, "en"), (1, "the cat and the dog", "en"), (9, "中文", "en"), (10, "1" * 100 + "a", None)]
    docs = spark.createDataFrame([(*r, 0.1, "zz") for r in rows], "doc_id bigint, text string, lang string, score double, lang_pred string")
    model = language.fit(language.sample(docs))
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()]
    assert len(got) == len(rows)
    by = {i: p for i, p, _ in got}
    assert (by[3], by[4], by[5]) == ("und", "und", "und") and by[6] in ("en", "xx") and by[None] == "fr" and by[10] != "und"
    assert {p for _, p, _ in got} <= {"en", "fr", "xx", "und"}
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(language.sample(docs.limit(0)))).collect()} == {"und"}


def test_language_of_long_texts_only(spark):
    rows = [(i, f"the cat and the dog number {i} " * 800, "en") for i in range(3)] + [(9, "le chat et le chien", "fr"), (10, "der hund und die katze", "de")]
    docs = spark.createDataFrame(rows + [(11, "the dog and the cat", None)], "doc_id bigint, text string, lang string")
    model = language.fit(language.sample(docs))
    assert model.languages == ["de", "en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert got == {0: "en", 1: "en", 2: "en", 9: "fr", 10: "de", 11: "en"}


def test_language_sample_is_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_BYTES", 10)
    docs = spark.createDataFrame([(f"some text {i}", lang) for i in range(5) for lang in ("en", "fr")], "text string, lang string")
    assert sorted(lang for lang, _ in language.sample(docs)) == ["en", "fr"]


def test_kernel_counts_shared_grams():
    texts = ["the cat sat", "the hat", "un chat noir", "cat", "zzz"]
    model = language.fit([("en", texts[0]), ("en", texts[1]), ("fr", texts[2])])
    known = set(np.concatenate([language.grams(t) for t in texts[:3]]).tolist())
    sets = [set(language.grams(t).tolist()) & known for t in texts]
    want = [[len(a & b) / max(1e-9, np.sqrt(len(a) * len(b))) for b in (sets[0], sets[1], sets[2])] for a in sets]
    assert np.allclose(model.kernel(texts), want, atol=1e-6)


# --- toxicity ----------------------------------------------------------------------------------


@needs_data
def test_toxicity_of_held_out_labels(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    learn = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    model = toxicity.train(docs, learn)
    assert len(model.weights) == 3 and [len(w) for w in model.weights] == [len(model.traits) + i + 1 for i in range(3)]
    scores = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()}
    held = [(scores[i] >= 0.5, m) for i, m in marks.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([p == bool(m) for p, m in held]) > 0.9 and not any(p and not m for p, m in held)
    kept = {r["doc_id"] for r in toxicity.keep_civil(docs, model).collect()}
    assert kept == {i for i, s in scores.items() if s < 0.5}
    again = toxicity.score(docs, toxicity.train(docs.repartition(5), learn.repartition(3))).collect()
    assert {r["doc_id"]: r["toxic"] for r in again} == scores


def test_toxicity_of_awkward_rows(spark):
    texts = [None, "", " ", "you moron", "a kind word", "moronic morons", "word " * 100_000, "moron"] + ["plain text here"] * 20 + ["such a moron"] * 20
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate(texts)] + [(None, "moron", "x", 0.5)], "doc_id bigint, text string, dense string, toxic double")
    rows = [(i, int(i in (3, 7) or i >= 28)) for i in range(len(texts)) if i != 5] + [(99, 1), (None, 1), (4, None), (5, 7), (2, 0)]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    found = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    by = {r["doc_id"]: r["toxic"] for r in found}
    assert len(found) == len(texts) + 1 and all(0 <= r[c] <= 1 for r in found for c in toxicity.CATEGORIES)
    assert by[0] == by[1] == by[2] and by[3] > 0.5 > by[4] and by[5] > 0.5 and by[6] < 0.5 and by[None] > 0.5
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r["toxic"] for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), nothing).count() == 0
