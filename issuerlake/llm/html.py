"""Main text of HTML pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive (less in links), tags negative by their name;
words of an element that is cut cost little, as they are left out anyway. A linear scan finds the contiguous region
with the highest sum. Where the region lies in an article or main element, it is brought to that
element's borders.

What is cut is decided on evidence. Elements that cannot hold an article (menus, footers, scripts, ...) are
always cut. Words of class and id, roles and form-like tags are features whose log odds are learned from labelled
pages, starting from prior counts for words that usually name adverts, notices, comments and the like. An element
with negative odds is cut unless its text, discounted by the odds, still outweighs everything else in the element
around it: so an element that holds the article is never cut for its name. A name tells by its last word
("article-comments", and "comments-area", as "area" only names a place); elsewhere, or after "no", "has" and the
like, a word counts little.

Labelled pages are pages with an article or main element: what is inside is content. Without any the prior
counts serve.

Text: character references decoded, white space inside a block one space, blocks joined by two line
feeds. Null and empty pages give the empty text, and so does a page without any word worth keeping.
Pages count whole and may repeat. Unclosed and crossing tags are closed at the enclosing element's end. A quoted
attribute that is not closed ends with its tag, at the next ``>``. Pages are read forward only, in linear time.
"""

from __future__ import annotations

import html as entities
import math
import re
import sys
from itertools import accumulate

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import map_columns, share_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bound of the fitting sample: pages taken by hash.
SAMPLE_PAGES = 2_000
# Ranges of the weights: per tag, per plain word, per word in a link outside of articles; the score of what is cut.
TAG_RANGE, WORD_RANGE, LINK_RANGE, SIDE_SCORE, LOG_ODDS_SCALE = (-0.3, -0.02), (0.5, 1.5), (-0.5, 1.0), -0.3, 0.1
# The inside of a tag: quoted values hold no angle brackets, or are short and end where an attribute may end.
INSIDE = re.compile(r"""(?:[^<>"']|"[^"<>]*"|'[^'<>]*'|"[^"]{0,2000}"(?=[\s/>])|'[^']{0,2000}'(?=[\s/>])|<)*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/><]*")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
# Tags that open only after these have been closed.
CLOSES = {
    **dict.fromkeys(BLOCKS - {"body", "head", "html", "option"}, {"p"}), "li": {"li", "p"}, "dd": {"dd", "dt", "p"},
    "dt": {"dd", "dt", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "menu", "dl", "table", "div", "section", "article", "main", "body", "aside", "nav", "footer", "header", "form"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "html", "body", "article", "main"}
# Elements that hold no article, and such as rarely do.
SIDE_TAGS = set(
    "nav header footer aside script style noscript template head title button select textarea iframe svg object "
    "canvas datalist audio video map".split()
)
SOFT_TAGS = {"form", "dialog", "menu"}
# Words of class and id that usually name what is no part of an article; words that name only a place; words that take a name back.
SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors promo promotion "
    "promoted banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs header masthead "
    "topbar footer comment comments disqus replies respond share sharing social related recommended recommendations trending "
    "login search toolbar pagination pager skip".split()
)
PLACES = set(
    "area bar block body bottom box btn button buttons container content count form group holder icon icons inner item items left "
    "link links list outer panel right section slot text title top unit wrap wrapper zone".split()
)
NEGATIONS = set("has no non not with without".split())
SIDE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
CONTENT = {"article", "main"}
# Counts inside and outside that features have before any page is read, by kind.
PRIOR_CONTENT, PRIOR_SIDE = (8.0, 1.0), (2.0, 80.0)
PRIORS = {"links": (1.0, 8.0), "soft": PRIOR_SIDE, "role": PRIOR_SIDE, "word": PRIOR_SIDE, "part": (2.0, 10.0), "other": (20.0, 20.0)}
# The most counted features that a model keeps.
FEATURES = 2_000
# Odds from which an element is in doubt; least odds of a listed and of another name; what articles in an element add; words that save it.
DOUBT, LEAST_LISTED, LEAST_OTHER, IS_ARTICLE, HOLDS_MAIN, HOLDS_ARTICLE, SAVING = -1.0, -6.0, -2.5, 2.0, 4.0, 1.0, 0.5


def names(value: str) -> list[str]:
    """Features of the class or id names: ``word:`` for what a name is about, ``part:`` for a listed word elsewhere, ``other:`` for the rest."""
    out = []
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        told = [w for w in words if w not in PLACES]
        listed = [w for w in told if w in SIDE_WORDS]
        if not listed:
            out += ["other:" + w for w in told[-1:]]
        elif told[-1] in SIDE_WORDS and not NEGATIONS.intersection(told):
            out.append("word:" + told[-1])
        else:
            out.append("part:" + listed[-1])
    return out


def rule(tag: str, attributes: str) -> tuple[list[str], bool]:
    """(features of the tag as evidence against its element, whether it opens an article)."""
    features = ["soft:" + tag] if tag in SOFT_TAGS else []
    content = tag in CONTENT
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name == "role":
                if value in SIDE_ROLES:
                    features.append("role:" + value)
                content = content or value in ("main", "article")
            elif name == "itemprop" and value == "articlebody":
                content = True
            elif name in ("class", "id") and tag not in HEADINGS - CONTENT:
                features += names(value)
    return features, content


def next_tag(source: str, at: int) -> tuple[int, str, str, str, int] | None:
    """(start, kind, name, inside, end) of the next tag, comment or CDATA section. Kinds: ``<``, ``</``, ``!`` and ``[``.

    What is not closed by the end of the page is taken to reach there.
    """
    n = len(source)
    while (i := source.find("<", at)) >= 0:
        second = source[i + 1 : i + 2]
        closing = second == "/"
        if name := NAME.match(source, i + 1 + closing):
            body = INSIDE.match(source, name.end())
            end = body.end() if body else source.find(">", name.end()) + 1 or n
            return i, "</" if closing else "<", name[0].lower(), source[name.end() : end].removesuffix(">"), end
        if source.startswith("<!--", i):
            close = source.find("-->", i + 4)
            return i, "!", "", "", close + 3 if close >= 0 else n
        if source.startswith("<![CDATA[", i):
            close = source.find("]]>", i + 9)
            return i, "[", "", source[i + 9 : close if close >= 0 else n], close + 3 if close >= 0 else n
        if second and second in "!?/":
            return i, "!", "", "", source.find(">", i) + 1 or n
        at = i + 1
    return None


class Element:
    """An element that may be cut: the one around it, features, whether it is always cut, and the articles that it is or holds."""

    __slots__ = ("parent", "features", "hard", "article", "holds_main", "holds_article", "span")

    def __init__(self, parent: int, features: list[str], hard: bool, article: bool):
        self.parent, self.features, self.hard, self.article = parent, features, hard, article
        self.holds_main = self.holds_article = False
        self.span = [0, 0]

    def named(self) -> bool:
        """Whether its name says that it is no part of an article."""
        return any(f.startswith(("word:", "role:")) for f in self.features)


class Page:
    """Segments (text, number of the element they lie in, block number, position) and tags of one page, in order."""

    def __init__(self, source: str):
        self.segments: list[tuple[str, int, int, int]] = []
        self.tags: list[tuple[int, str]] = []
        self.contents: list[list[int]] = []  # first and last position of article elements, and their element
        self.links: set[int] = set()  # positions of words in a link
        self.elements = [Element(-1, [], False, False)]
        stack: list[tuple[str, int, int]] = []  # tag, element, article number
        opened: dict[str, int] = {}  # elements in the stack, by tag
        block = position = 0

        def close(n: int) -> None:
            for name, number, content in stack[n:]:
                opened[name] -= 1
                self.elements[number].span[1] = position
                if content >= 0:
                    self.contents[content][1] = position
            del stack[n:]

        def around() -> int:
            return stack[-1][1] if stack else 0

        def add(text: str) -> None:
            nonlocal position
            self.segments.append((text, around(), block, position))
            if opened.get("a"):
                self.links.add(position)
            position += 1

        at = 0
        while True:
            found = next_tag(source, at)
            text = source[at : found[0] if found else len(source)]
            if text and not text.isspace():
                add(text)
            elif text and self.segments:
                self.segments.append((" ", around(), block, position))
            if not found:
                break
            _, kind, tag, inside, at = found
            if kind == "[":
                add(entities.escape(inside))
            if kind in "![":
                continue
            self.tags.append((position, ("/" if kind == "</" else "") + tag))
            position += 1
            if tag in BLOCKS:
                block += 1
            elif tag == "br" and self.segments:
                self.segments.append((" ", around(), block, position))
            if kind == "</":
                for n in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                    if stack[n][0] == tag:
                        close(n)
                        break
                continue
            if tag in VOID:
                continue
            ended = CLOSES.get(tag, ())
            for n in range(len(stack) - 1, -1, -1) if any(opened.get(x) for x in ended) else ():
                if stack[n][0] in ended:
                    close(n)
                elif stack[n][0] in SCOPES:
                    break
            stack.append((tag, *self.open(tag, inside, around(), position)))
            opened[tag] = opened.get(tag, 0) + 1
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                inner = source[at : end.start() if end else len(source)]
                at = end.end() if end else len(source)
                if inner.strip():
                    add(inner)
                block += tag in BLOCKS
                close(len(stack) - 1)
        close(0)
        self.length = position

    def open(self, tag: str, inside: str, around: int, position: int) -> tuple[int, int]:
        """(number of the element that rules the tag's text, number of its article or -1)."""
        hard = tag in SIDE_TAGS or self.elements[around].hard
        features, article = ([], False) if hard else rule(tag, inside)
        if not hard and not features and not article:
            return around, -1
        number = len(self.elements)
        self.elements.append(Element(around, features, hard, article))
        self.elements[number].span[0] = position
        if not article:
            return number, -1
        if not self.elements[number].named():
            up, main = around, tag == "main" or "main" in inside
            while up >= 0 and not (self.elements[up].holds_article and not main or self.elements[up].holds_main):
                self.elements[up].holds_article = True
                self.elements[up].holds_main |= main
                up = self.elements[up].parent
        self.contents.append([position, position, number])
        return number, len(self.contents) - 1

    def cut(self, weights: dict[str, float]) -> list[bool]:
        """Which elements are left out: see the module's text."""
        factor = []
        for e in self.elements:
            odds = min((doubt(f, weights) for f in e.features), default=0.0)
            odds += IS_ARTICLE * e.article + HOLDS_MAIN * e.holds_main + HOLDS_ARTICLE * (e.holds_article and not e.holds_main)
            factor.append(0.0 if e.hard else math.exp(odds) if odds < DOUBT else 1.0)
        worth = [0.0] * len(self.elements)
        for text, number, _, position in self.segments:
            if text != " ":
                worth[number] += len(text.split()) * (-0.5 if position in self.links else 1.0)
        for number in range(len(worth) - 1, 0, -1):
            worth[self.elements[number].parent] += factor[number] * max(0.0, worth[number])
        out, within = [False], [0]  # per element: whether it is cut, and the nearest element around it that is in doubt but kept
        for number, e in enumerate(self.elements[1:], 1):
            frame = within[e.parent]
            gone, kept = out[e.parent] or e.hard, frame
            if not gone and factor[number] < 1.0:
                own = factor[number] * worth[number]
                enough = own >= SAVING or own > 0 and (e.article or e.holds_main or e.holds_article)
                gone, kept = not (enough and own > worth[frame] - own), number
            out.append(gone)
            within.append(kept)
        return out

    def region(self, weights: dict[str, float], out: list[bool] | None = None) -> tuple[int, int]:
        """Positions of the maximum-scoring region, brought to the borders of articles it touches."""
        out = self.cut(weights) if out is None else out
        scores = [0.0] * self.length
        for position, tag in self.tags:
            scores[position] = bounded(weights.get("tag:" + tag, 0.0), TAG_RANGE)
        for text, number, _, position in self.segments:
            if text == " ":
                continue
            link = position in self.links
            odds = weights.get("links" if link else "words", -5.0 if link else 10.0)
            plain = len(text.split()) * bounded(odds, LINK_RANGE if link else WORD_RANGE)
            scores[position] = SIDE_SCORE if out[number] else plain
        best = total = 0.0
        start, region = 0, (0, 0)
        for i, s in enumerate(scores):
            if total <= 0:
                total, start = 0.0, i
            total += s
            if total > best:
                best, region = total, (start, i + 1)
        touched = [(a, b) for a, b, number in self.contents if not out[number] and a < region[1] and region[0] < b]
        return (min(a for a, _ in touched), max(b for _, b in touched)) if touched else region

    def text(self, weights: dict[str, float]) -> str:
        out = self.cut(weights)
        start, end = self.region(weights, out)
        blocks: dict[int, list[str]] = {}
        for text, number, block, position in self.segments:
            if not out[number] and start <= position < end:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join(entities.unescape("".join(b)).split()) for _, b in sorted(blocks.items()))
        return "\n\n".join(b for b in joined if b)


def doubt(feature: str, weights: dict[str, float]) -> float:
    """Log odds of an element's feature, learned or prior; without a count ``other`` names say nothing."""
    odds = weights.get(feature)
    if odds is None:
        odds = log_odds(feature, 0, 0)
    return max(odds, LEAST_OTHER if feature.startswith("other:") else LEAST_LISTED)


def bounded(odds: float, limits: tuple[float, float]) -> float:
    return max(limits[0], min(limits[1], odds * LOG_ODDS_SCALE))


def log_odds(feature: str, inside: float, outside: float) -> float:
    prior = PRIORS.get(feature.split(":")[0], PRIOR_CONTENT)
    return math.log((inside + prior[0]) / (outside + prior[1]))


def counts(source: str) -> list[tuple[str, int, int]]:
    """(feature, times inside, times outside an article) of a labelled page; nothing for other pages.

    The names of an element count with its words: as inside if it is or holds the page's largest article, as outside if it
    lies beside all articles. Within one the labels cannot tell what listed names stand for.
    """
    page = Page(source)
    articles = [(a, b) for a, b, number in page.contents if not page.elements[number].named()]
    if not articles:
        return []
    edges = [0] * (page.length + 1)
    for a, b in articles:
        edges[a] += 1
        edges[b] -= 1
    inside = list(accumulate(edges))
    sizes = [0] * (page.length + 1)
    out: dict[str, list[int]] = {}
    for text, number, _, position in page.segments:
        n = len(text.split())
        sizes[min(position + 1, page.length)] += n
        if not page.elements[number].hard:
            out.setdefault("links" if position in page.links else "words", [0, 0])[0 if inside[position] else 1] += n
    for position, tag in page.tags:
        out.setdefault("tag:" + tag, [0, 0])[0 if inside[position] else 1] += 1
    upto = list(accumulate(sizes))
    main = max(articles, key=lambda x: upto[x[1]] - upto[x[0]])
    for e in page.elements[1:]:
        a, b = e.span
        if a <= main[0] < b:
            told, at = e.features, 0
        elif inside[a]:
            told, at = [f for f in e.features if f.startswith("other:")], 0
        else:
            told, at = e.features, 1
        for f in set(told):
            out.setdefault(f, [0, 0])[at] += upto[b] - upto[a]
    return [(k, a, b) for k, (a, b) in out.items()]


def train(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES, features: int = FEATURES) -> dict[str, float]:
    """Weights of the ``features`` most counted words, tags and names of about ``sample_pages`` different labelled pages.

    Other features have their prior odds.
    """
    labelled = pages.where(F.lower(html).rlike("<(article|main)\\b")).select(F.col(html).alias("html"), F.xxhash64(html).alias("h"))
    known = labelled.agg(F.approx_count_distinct("h")).first()[0]
    # Pages are chosen where they are scanned; copies of a page count once.
    chosen = labelled.where(share_of(F.col("h"), sample_pages, known)).groupBy("h").agg(F.min("html").alias("html"))

    def make():
        def block(sources):
            found = [c for s in sources for c in counts(s)]
            return [[c[i] for c in found] for i in range(3)]

        return block

    found = map_columns(chosen, ["html"], "feature string, inside bigint, outside bigint", make)
    rows = found.groupBy("feature").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    rows = rows.orderBy((F.col("a") + F.col("b")).desc(), "feature").limit(features).collect()
    return {r["feature"]: log_odds(r["feature"], r["a"], r["b"]) for r in rows}


def extract(pages: DataFrame, weights: dict[str, float], key: list[str], html: str = "html") -> DataFrame:
    """The key columns, text, n_chars (code points) and blocks (number of text blocks)."""

    def make():
        def block(*columns):
            texts = [Page(s).text(weights) if s else "" for s in columns[-1]]
            return [*columns[:-1], texts, [len(t) for t in texts], [t.count("\n\n") + 1 if t else 0 for t in texts]]

        return block

    kinds = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in key)
    return map_columns(pages, [*key, html], f"{kinds}, text string, n_chars bigint, blocks bigint", make)
