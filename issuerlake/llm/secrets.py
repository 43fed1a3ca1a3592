"""Secret scans and linking of multipart credentials, in DataFrame functions only.

Strong parts (assigned secrets, access identifiers, long hex strings) are reported always. Weak parts,
which are common in harmless text (user names, short or oddly named secrets, addresses), are reported
only if a complementary part lies within ``scope`` characters: a name or an address needs a secret,
a weak secret a name or an address. Parts are cut to the bins of that scope they reach and joined on document
and bin, with the distance tested inside. Parts of a kind do not overlap, so a bin holds a bounded
number of them.

Positions are code points, ends exclusive. Null and empty texts have no spans. Documents are told apart
by key and text: rows that repeat both have equal results, and are joined once. Texts count whole, and other columns may
have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.session import shared_dir

SCOPE = 200
# Kinds in the order of their names in a result; patterns of the first three are the contract's fixed values.
_NAME = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
KINDS = {
    "assign": rf"(?i:{_NAME})[A-Za-z0-9+/_.=-]+",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "name": rf"\b(?i:access_?key_?id|client_?id|account_?id|user_?name|user_?id|login|user){_GIVEN}[A-Za-z0-9._@-]+",
    "weak": rf"\b(?i:pwd|passphrase|pass|credentials?|auth_?key|private_?key){_GIVEN}[A-Za-z0-9+/_.=-]+",
    "address": r"\b[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%:@/?&=+-]+",
}
STRONG = ["assign", "access", "hex"]
ROLE = {"assign": "secret", "access": "name", "hex": "secret", "name": "name", "weak": "secret", "address": "address"}
_STEP = 64
SPAN = "struct<kind: string, start: bigint, end: bigint>"


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("bigint"), lambda s, x: s + x["gap"] + x["hit"])


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _steps(xs: Column) -> Column:
    """An array (a column or a bound value) in consecutive parts, about as many as a part has elements; none of an empty one."""
    width = F.greatest(F.lit(_STEP), F.ceil(F.sqrt(F.size(xs)))).cast("int")
    last = F.floor((F.size(xs) - 1) / width).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), last)), lambda i: F.slice(xs, i * width + 1, width))
    return F.filter(parts, lambda x: F.size(x) > 0)


def with_spans(docs: DataFrame, text: str, kinds: list[str]) -> DataFrame:
    """Adds, per kind, an array of spans in order, named ``__span_`` and the kind.

    Split gives what lies between the matches, extraction the matches; a span's start is the sum of all
    lengths before it, taken in parts of about the square root of their number, so that the work stays near
    linear for texts full of matches.
    """
    nothing = F.array().cast("array<struct<gap: int, hit: int, ok: boolean>>")

    def pieces(k: str) -> Column:
        def piece(hit: Column, gap: Column) -> Column:
            # The last gap has no match after it; an assignment counts if what follows the name is long enough.
            good = F.length(F.regexp_replace(hit, f"^(?i:{_NAME})", "")) >= 8 if k == "assign" else hit.isNotNull()
            return F.struct(
                F.length(gap).alias("gap"), F.coalesce(F.length(hit), F.lit(0)).alias("hit"), F.coalesce(good, F.lit(False)).alias("ok")
            )

        found = F.zip_with(F.regexp_extract_all(text, F.lit(KINDS[k]), F.lit(0)), F.split(text, KINDS[k], -1), piece)
        return F.when(F.col(text).rlike(KINDS[k]), found).otherwise(nothing)

    def placed(k: str, part: Column, before: Column) -> Column:
        def of(x: Column, j: Column) -> Column:
            start = before + _sum(F.slice(part, 1, j)) + x["gap"]
            return _let(start, lambda s: F.struct(F.lit(k).alias("kind"), s.alias("start"), (s + x["hit"]).alias("end"), x["ok"].alias("ok")))

        return F.transform(part, of)

    def spans(k: str) -> Column:
        def summed(parts: Column, sums: Column) -> Column:
            def of(part: Column, i: Column) -> Column:
                before = F.aggregate(F.slice(sums, 1, i), F.lit(0).cast("bigint"), lambda s, x: s + x)
                return _let(before, lambda known: placed(k, part, known))

            good = F.filter(F.flatten(F.transform(parts, of)), lambda x: x["ok"])
            return F.transform(good, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

        made = _let(pieces(k), lambda xs: _let(_steps(xs), lambda parts: _let(F.transform(parts, _sum), lambda sums: summed(parts, sums))))
        return made.cast(f"array<{SPAN}>").alias(f"__span_{k}")

    return docs.select(*docs.columns, *[spans(k) for k in kinds])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def identity(key: str, text: str) -> list[Column]:
    """Two hashes that stand for the key and text of a document."""
    return [F.xxhash64(key, text), F.xxhash64(F.lit(1), text, key)]


def spans_once(docs: DataFrame, key: str, text: str) -> DataFrame:
    """__key, __a, __b and the spans of every kind, ``__span_`` and the kind, per row of the documents.

    All texts are scanned here, once; what follows reads the spans, which are written to the shared folder.
    """
    a, b = identity(key, text)
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(text, F.lit("")).alias("__text"), a.alias("__a"), b.alias("__b"))
    path = shared_dir(docs.sparkSession, "secret-spans")
    with_spans(rows, "__text", list(KINDS)).drop("__text").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """__a, __b, __weak: the weak spans of a document that have a complementary part in scope."""
    some = lambda *ks: F.greatest(*[F.size(f"__span_{k}") for k in ks]) > 0
    weak = [k for k in KINDS if k not in STRONG]
    # A document can have a linked part only if it has a secret, and a name or an address.
    spans = spans.where(some(*weak) & some("assign", "hex", "weak") & some("access", "name", "address"))
    parts = spans.select("__a", "__b", F.explode(F.concat(*[f"__span_{k}" for k in KINDS])).alias("p")).select("__a", "__b", "p.*").distinct()

    def binned(rows: DataFrame, reach: int) -> DataFrame:
        at = lambda x: F.floor(x / scope).cast("bigint")
        return rows.withColumn("bin", F.explode(F.sequence(at(F.col("start") - reach), at(F.col("end") + reach))))

    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    parts = parts.withColumn("role", role[F.col("kind")])
    left = binned(parts.where(F.col("kind").isin(weak)), scope).alias("l")
    right = binned(parts, 0).alias("r")
    near = (F.col("r.start") <= F.col("l.end") + scope) & (F.col("r.end") >= F.col("l.start") - scope)
    fits = F.when(F.col("l.role") == "secret", F.col("r.role") != "secret").otherwise(F.col("r.role") == "secret")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__a", "__b", "bin")]
    hits = left.join(right, [*same, near, fits], "left_semi").select("__a", "__b", "kind", "start", "end").distinct()
    span = F.struct("kind", "start", "end").cast(SPAN)
    return hits.groupBy("__a", "__b").agg(F.collect_list(span).alias("__weak"))


def _with_linked(spans: DataFrame, scope: int) -> DataFrame:
    found = F.coalesce("__weak", F.array().cast(f"array<{SPAN}>")).alias("__span_linked")
    return spans.join(linked(spans, scope), ["__a", "__b"], "left").select("__key", "__a", "__b", *[f"__span_{k}" for k in STRONG], found)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """key, and arrays of spans: one per strong kind, and ``linked`` weak ones."""
    found = _with_linked(spans_once(docs, key, text), scope)
    return found.select(F.col("__key").alias(key), *[F.col(f"__span_{k}").alias(k) for k in [*STRONG, "linked"]])


def ordered(*spans: str) -> Column:
    """The spans of all arrays by start, then kind as listed, then end."""
    rank = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    keyed = F.transform(F.concat(*spans), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    def joined(*spans: str) -> Column:
        return F.array_join(F.transform(ordered(*spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        key, *[F.size(k).cast("bigint").alias(f"n_{k}") for k in STRONG],
        F.sha2(joined(*STRONG), 256).alias("base_sha256"), joined(*STRONG, "linked").alias("spans"),
    )


def _end(spans: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(spans, lambda x: x["end"])), F.lit(0).cast("bigint"))


def cut_spans(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span (in order of start), or group of overlapping ones, replaced by a mark.

    A group begins where a span starts at or behind the furthest end before it, and that end is where the text
    kept before the group starts. Ends are taken, and the text is cut, in parts of about the square root of the
    number of spans, so that no span needs all spans or the whole text again.
    """

    def reached(parts: Column, ends: Column) -> Column:
        def of(part: Column, i: Column) -> Column:
            before = F.coalesce(F.array_max(F.slice(ends, 1, i)), F.lit(0).cast("bigint"))
            return _let(before, lambda known: F.transform(part, lambda x, j: F.struct(
                x["start"].alias("start"), F.greatest(known, _end(F.slice(part, 1, j))).alias("from"))))

        return F.filter(F.flatten(F.transform(parts, of)), lambda x: x["start"] >= x["from"])

    groups = _let(_steps(spans), lambda parts: _let(F.transform(parts, _end), lambda ends: reached(parts, ends)))

    def taken(part: Column) -> Column:
        first, last = F.get(part, F.lit(0))["from"], F.element_at(part, -1)["start"]
        piece = F.substr(text, first.cast("int") + 1, (last - first).cast("int"))
        return F.struct(part.alias("groups"), first.alias("first"), piece.alias("text"))

    def pieces(x: Column) -> Column:
        return F.array_join(F.transform(x["groups"], lambda g: F.concat(
            F.substr(x["text"], (g["from"] - x["first"]).cast("int") + 1, (g["start"] - g["from"]).cast("int")), F.lit(mark))), "")

    parts = _let(groups, lambda g: F.transform(_steps(g), taken))
    return F.concat(F.array_join(F.transform(parts, pieces), ""), F.substr(text, _end(spans).cast("int") + 1))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The documents with every reported span replaced by a mark, overlapping spans by one; ``n_chars``,
    where there is such a column, follows. Texts without a span, null texts and all other columns stay."""
    columns = docs.columns
    found = _with_linked(spans_once(docs, key, text), scope)
    a, b, spans, new = unused(docs, "__a", "__b", "__spans", "__new")
    every = ordered(*[f"__span_{k}" for k in [*STRONG, "linked"]])
    # Only documents with spans, one row for rows that repeat.
    cuts = found.select(F.col("__a").alias(a), F.col("__b").alias(b), every.alias(spans)).where(F.size(spans) > 0).distinct()
    named = docs.select("*", *[c.alias(n) for c, n in zip(identity(key, text), (a, b))]).join(cuts, [a, b], "left")
    hit = F.col(spans).isNotNull()
    out = named.withColumn(new, F.when(hit, cut_spans(F.col(text), F.col(spans), mark)).otherwise(F.col(text)))
    changed = {text: F.col(new)}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(hit, F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in columns])
