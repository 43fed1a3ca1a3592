"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A document's set holds its distinct shingles (``width`` consecutive words; fewer words make one
shingle). A signature has CHUNKS * CHUNK symbols of b = 16 bits. Two signatures that differ in fewer than
2 * CHUNKS symbols agree, by pigeonhole, in some chunk but for one symbol at most. The allowed error is
enumerated by leaving out each symbol of a chunk in turn: such pairs share one of CHUNKS * CHUNK keys, so
the join finds all of them. At a similarity of 0.8 a pair differs in 12 of 60 symbols on average, and
in 24 or more three times in ten thousand; most of those share a key all the same.

No bucket is expanded into its pairs. First every member is compared with its bucket's smallest member,
on full sets. Buckets that still hold documents not linked to one another are then searched in
blocks of limited size: a first pass finds, on signatures, which members have an open pair; a second
one gets these members' texts and tests their pairs on full sets, leaving out pairs the block has
already connected. Only links leave the tasks. Every pair that shares a key is thus linked, tested, or
connected by links already, and connected components need no more.

Documents of equal sets are one node, named by 64 bits of the set's digest. Rows without words (null,
empty, white space) have size 0 and are linked with nothing. A row with a null key is linked with
nothing and kept. Texts count whole. Where a key repeats with other texts, ``link`` gives nodes with
the same smallest key one component, and ``keep_first`` judges every text by its own node.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from issuerlake.llm.common import map_columns, pieces, small_batches, white_words, worker_cache
from issuerlake.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNKS, CHUNK = 12, 5
SYMBOLS = CHUNKS * CHUNK
# Candidates that differ in more symbols are not tested, unless a call says otherwise (SYMBOLS tests all): of pairs at
# a similarity of 0.8 about 8 in 10 million differ in more.
CUT = 28
# Members of a block, and rows of a list of keys that may go to every task; longer lists are joined by shuffle.
BLOCK, BROADCAST_ROWS = 1_024, 4_000_000
CACHED_WORDS = 200_000
_RNG = np.random.default_rng(20_261)
FLIP = _RNG.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)[:, None]
FACTOR = (_RNG.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32) | np.uint32(1))[:, None]
SALT = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = white_words(text)
    if not words:
        return np.empty(0, np.uint64)
    cache = worker_cache("word-hashes", Hashes)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, 0x9E3779B97F4A7C15 * n % (1 << 64), np.uint64)
    for i in range(n):
        out = (out ^ h[i : len(h) - n + 1 + i]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """SYMBOLS minima of a non-empty set under different orders, 16 mixed bits of each."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = None
    for i in range(0, len(x), 4096):
        part = ((x[None, i : i + 4096] ^ FLIP) * FACTOR).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    low = (low ^ (low >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (low >> np.uint32(16)).astype(np.uint16)


def bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """signature x key: for every chunk and left-out symbol the other symbols, mixed with their place."""
    s = signatures.astype(np.uint64).reshape(len(signatures), CHUNKS, CHUNK)
    out = np.zeros((len(signatures), CHUNKS, CHUNK), np.uint64)
    for gap in range(CHUNK):
        key = np.zeros((len(signatures), CHUNKS), np.uint64)
        for i in range(CHUNK):
            if i != gap:
                key = (key << np.uint64(16)) | s[:, :, i]
        out[:, :, gap] = key
    flat = (out.reshape(len(signatures), SYMBOLS) ^ SALT) * np.uint64(0x9E3779B97F4A7C15)
    flat ^= flat >> np.uint64(31)
    return (flat * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def similar_size(a, b, num: int, den: int):
    return (den * np.minimum(a, b)) >= num * np.maximum(a, b)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again: computed once, and no lineage behind it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def halves(hashes: np.ndarray) -> tuple[int, int]:
    """The two halves of a set's digest."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64).tolist())


def sketches(docs: DataFrame, width: int, carried: list[str] = ()) -> DataFrame:
    """doc, n, two halves of the set's digest, signature (null without words), and the carried columns of whole numbers."""

    def make():
        def block(keys, texts, *more):
            n, a, b, s = [], [], [], []
            for t in texts:
                u = shingles(t, width)
                n.append(len(u))
                if len(u):
                    x, y = halves(u)
                    a.append(x)
                    b.append(y)
                    s.append(signature(u).tobytes())
                else:
                    a.append(None)
                    b.append(None)
                    s.append(None)
            return [keys, n, a, b, s, *more]

        return block

    kind, own = docs.schema["doc"].dataType.simpleString(), "n bigint, a bigint, b bigint, sig binary"
    return map_columns(docs, ["doc", "text", *carried], ", ".join([f"doc {kind}, {own}", *[f"{c} bigint" for c in carried]]), make)


def keyed(nodes: DataFrame) -> DataFrame:
    """id, slot, key: the bucket keys of every node."""

    def make():
        def block(ids, sigs):
            keys = bucket_keys(np.frombuffer(b"".join(sigs), np.uint16).reshape(len(sigs), SYMBOLS))
            return [ids, keys.tolist()]

        return block

    kind = nodes.schema["id"].dataType.simpleString()
    arrays = map_columns(nodes, ["id", "sig"], f"id {kind}, keys array<bigint>", make)
    return arrays.select("id", F.posexplode("keys").alias("slot", "key"))


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def keep_near(pairs: DataFrame, num: int, den: int, cut: int = CUT) -> DataFrame:
    """Of pairs with both signatures and sizes, those that can be similar enough."""

    def make():
        def block(a, b, sa, sb, na, nb):
            x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), SYMBOLS) for s in (sa, sb))
            ok = ((x != y).sum(axis=1) <= cut) & similar_size(np.array(na), np.array(nb), num, den)
            return [[v for v, k in zip(c, ok) if k] for c in (a, b)]

        return block

    kind = pairs.schema["u"].dataType.simpleString()
    return map_columns(pairs, ["u", "v", "su", "sv", "nu", "nv"], f"u {kind}, v {kind}", make)


def texts_of(docs: DataFrame, ids: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """id, text of the named nodes, one row each. Ids go to the documents if they are few enough; texts move otherwise."""
    named = ids.join(nodes, "id").select("doc", F.col("id").alias("wanted"))
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)

    def make():
        def block(texts, wanted):
            out = [], []
            for t, a in zip(texts, wanted):
                # A key that repeats with another text is another node.
                if halves(shingles(t, width))[0] == a:
                    out[0].append(a)
                    out[1].append(t)
            return list(out)

        return block

    got = map_columns(docs.join(named, "doc"), ["text", "wanted"], "id bigint, text string", make)
    # Rows may repeat key and text; repeats are dropped before they move.
    return written(got.groupBy("id").agg(F.min("text").alias("text")), "neardup-texts")


def verified(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs that are similar on full sets."""
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("tu")), "u")
    both = both.join(texts.select(F.col("id").alias("v"), F.col("text").alias("tv")), "v")

    def make():
        last: list = [None, None]

        def block(u, v, tu, tv):
            out = [], []
            for a, b, x, y in zip(u, v, tu, tv):
                if last[0] != (b, y):
                    last[:] = [(b, y), shingles(y, width)]
                if linked(shingles(x, width), last[1], num, den):
                    out[0].append(a)
                    out[1].append(b)
            return list(out)

        return block

    kind = pairs.schema["u"].dataType.simpleString()
    return map_columns(both, ["u", "v", "tu", "tv"], f"u {kind}, v {kind}", make)


def per_group(df: DataFrame, keys: list[str], columns: list[str], schema: str, make) -> DataFrame:
    """Apply a function to the rows of each group, a stream of groups per task.

    Groups are small by construction (blocks of buckets), so one call per group through Spark would cost
    more than the work itself.
    """
    n = len(keys)

    def start():
        f = make()
        held: list[tuple] = []

        def groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
            nonlocal held
            for r in rows:
                if held and held[0][:n] != r[:n]:
                    yield held
                    held = []
                held.append(r)

        return f, groups, lambda: held

    from pyspark.sql.pandas.types import to_arrow_schema

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        f, groups, rest = start()

        def emit(rows):
            columns = zip(*rows) if rows else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, arrow)], schema=arrow)

        for batch in (p for b in batches for p in pieces(b)):
            out = [x for g in groups(zip(*(c.to_pylist() for c in batch.columns))) for x in f(g)]
            if out:
                yield emit(out)
        if rest():
            yield emit(list(f(rest())))

    dealt = df.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys, columns[0])
    return small_batches(dealt).mapInArrow(run, fields)


def open_pairs(slot: int, sig: np.ndarray, n: np.ndarray, lab: np.ndarray, side: np.ndarray, num: int, den: int, cut: int = CUT):
    """(i, numbers of later members whose pair with i is open here).

    A pair is open in the first bucket its documents share; members of one block pair meet across blocks
    only, unless it is a block with itself (all sides equal).
    """
    chunk, gap = divmod(slot, CHUNK)
    across = bool((side != side[0]).any())
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        j = j[(lab[j] != lab[i]) & similar_size(n[i], n[j], num, den)]
        if across:
            j = j[side[j] != side[i]]
        if not len(j):
            continue
        differ = (sig[j] != sig[i]).reshape(len(j), CHUNKS, CHUNK)
        errors = differ.sum(axis=2)
        first = (errors <= 1).argmax(axis=1)
        place = np.where(errors[:, chunk] == 1, differ[:, chunk].argmax(axis=1), 0)
        j = j[(errors.sum(axis=1) <= cut) & (first == chunk) & (place == gap)]
        if len(j):
            yield i, j


def find_open(rows: DataFrame, num: int, den: int, cut: int = CUT) -> DataFrame:
    """Members of block pairs that have an open pair there."""
    kind = rows.schema["id"].dataType.simpleString()

    def make():
        def group(members):
            if len(members) < 2 or len({m[6] for m in members}) < 2:
                return
            sig = np.frombuffer(b"".join(m[8] for m in members), np.uint16).reshape(len(members), SYMBOLS)
            n, lab, side = (np.array([m[i] for m in members]) for i in (7, 6, 5))
            open_ = np.zeros(len(members), bool)
            for i, j in open_pairs(members[0][4], sig, n, lab, side, num, den, cut):
                open_[i] = True
                open_[j] = True
            for m, o in zip(members, open_):
                if o:
                    yield m[0], m[1], m[2], m[3], m[4], m[5], m[6]

        return group

    schema = f"key bigint, left int, right int, id {kind}, slot int, side int, lab {kind}"
    return per_group(rows, ["key", "left", "right"], ["id", "slot", "side", "lab", "n", "sig"], schema, make)


def test_open(rows: DataFrame, width: int, num: int, den: int, cut: int = CUT) -> DataFrame:
    """Links between members of block pairs, tested on the sets of their texts; at most one per member."""
    kind = rows.schema["id"].dataType.simpleString()

    def make():
        def group(members):
            sets = [shingles(m[7], width) for m in members]
            sig = np.array([signature(s) for s in sets])
            n = np.array([len(s) for s in sets])
            lab, side = (np.array([m[i] for m in members]) for i in (6, 5))
            parent: dict = {}

            def root(x):
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            ends = np.cumsum(n)
            _, local = np.unique(np.concatenate(sets), return_inverse=True)
            seen = np.zeros(int(local.max()) + 1, bool)
            for i, js in open_pairs(members[0][4], sig, n, lab, side, num, den, cut):
                own = local[ends[i] - n[i] : ends[i]]
                seen[own] = True
                for j in js.tolist():
                    a, b = root(lab[i]), root(lab[j])
                    if a != b:
                        both = int(seen[local[ends[j] - n[j] : ends[j]]].sum())
                        if den * both >= num * (n[i] + n[j] - both):
                            parent[max(a, b)] = min(a, b)
                            yield members[i][3], members[j][3]
                seen[own] = False

        return group

    return per_group(rows, ["key", "left", "right"], ["id", "slot", "side", "lab", "text"], f"u {kind}, v {kind}", make)


def components(edges: DataFrame) -> DataFrame:
    """id, component: the smallest node each node of the edges can reach.

    Alternates two steps that tie nodes to the smallest neighbour, larger ones first, until nothing
    changes; the table holds one row per edge at most, is written after each round, and only its count
    and checksum reach the driver.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "neardup-edges")
    mark = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        tied = e.join(low, "u")
        e = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(e.union(tied.select("u", "m")).distinct(), "neardup-edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = now


def grouped(sketched: DataFrame, rows: DataFrame, width: int, similarity: tuple[int, int], by_key: bool, cut: int = CUT) -> DataFrame:
    """a, b, component_id of every set: the smallest key of the component of its node.

    With ``by_key`` nodes that have the same smallest key are in one component.
    """
    num, den = similarity
    known = sketched.where("n > 0 and doc is not null")
    nodes = known.groupBy("a", "b").agg(F.min("doc").alias("doc"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    nodes = written(nodes.withColumn("id", F.col("a")), "neardup-nodes")
    keys = keyed(nodes)
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("size")).where("size > 1")
    members = written(keys.join(heads, "key"), "neardup-members")

    # Every member against the smallest of its bucket.
    light = nodes.select("id", "n", "sig")
    pairs = members.where("id <> head").select(F.col("id").alias("u"), F.col("head").alias("v")).distinct()
    pairs = pairs.join(light.toDF("u", "nu", "su"), "u").join(light.toDF("v", "nv", "sv"), "v")
    near = written(keep_near(pairs, num, den, cut), "neardup-pairs")
    ids = near.select(F.col("u").alias("id")).union(near.select("v")).distinct()
    star = written(verified(near, texts_of(rows, ids, nodes, width), width, num, den), "neardup-links")

    # Buckets whose members are not all linked through one node yet.
    lab = star.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "id")
    labelled = members.join(lab, "id", "left").withColumn("lab", F.coalesce("low", "id"))
    mixed = labelled.groupBy("key").agg((F.min("lab") != F.max("lab")).alias("mixed")).where("mixed").select("key")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks.cast("bigint")).cast("int")
    rest = labelled.join(mixed, "key").withColumn("side", own).select(
        "key", "id", "slot", "side", "lab", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    rest = rest.withColumn("left", F.least("side", "other")).withColumn("right", F.greatest("side", "other"))
    rest = written(find_open(rest.join(light, "id"), num, den, cut), "neardup-open")
    texts = texts_of(rows, rest.select("id").distinct(), nodes, width)
    more = test_open(rest.join(texts, "id"), width, num, den, cut)

    edges = star.union(more)
    if by_key:
        shared = nodes.groupBy("doc").agg(F.min("id").alias("v"), F.count("*").alias("sets")).where("sets > 1")
        edges = edges.union(nodes.join(shared, "doc").select(F.col("id").alias("u"), "v"))
    found = components(edges)
    # Components of one node are left out: their smallest key is the node's own.
    found = found.union(found.select("component", "component").distinct())
    low = found.join(nodes.select("id", "doc"), "id").groupBy("component").agg(F.min("doc").alias("low"))
    found = found.join(low, "component").select("id", "low")
    return nodes.join(found, "id", "left").select("a", "b", F.coalesce("low", "doc").alias("component_id"))


def decided(
    docs: DataFrame, key: str, text: str, width: int, similarity: tuple[int, int], by_key: bool, cut: int, carried: list[Column] = (),
) -> DataFrame:
    """doc, n, a, b, component_id, kept and the carried columns of every row."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), *carried)
    extra = rows.columns[2:]
    sketched = written(sketches(rows, width, extra), "neardup-sketches")
    named = grouped(sketched, rows, width, similarity, by_key, cut)
    out = sketched.select("doc", "n", "a", "b", *extra).join(named, ["a", "b"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    component = F.when(F.col("doc").isNotNull(), component)
    out = out.withColumn("component_id", component)
    return out.withColumn("kept", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)))


def link(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, similarity: tuple[int, int] = (80, 100),
    cut: int = CUT,
) -> DataFrame:
    """key, n_shingles, component_id, kept for every document.

    Documents are linked if ``den * intersection >= num * union`` on full sets, with
    ``similarity = (num, den)``; components are those of the links. Of pairs that share a key those are tested
    that differ in ``cut`` symbols at most; ``cut=SYMBOLS`` tests all.
    """
    out = decided(docs, key, text, width, similarity, True, cut)
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id", "kept")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
               similarity: tuple[int, int] = (80, 100), cut: int = CUT) -> DataFrame:
    """One document of each component, the one with the smallest key; all columns unchanged, whatever their names.

    Rows go by key and text: of a key with several texts only those go of which another row stays.
    """
    x, y = "__x", "__y"
    while {x, y} & set(docs.columns):
        x, y = x + "_", y + "_"
    hashes = [F.xxhash64(text).alias(x), F.xxhash64(F.lit(1), text).alias(y)]
    gone = decided(docs, key, text, width, similarity, False, cut, hashes).where("not kept")
    gone = gone.select(F.col("doc").alias("doc"), x, y).distinct().alias("gone")
    # Rows that go have a key and words, so nulls need not match.
    rows = docs.select("*", *hashes).alias("rows")
    same = (F.col(f"rows.{key}") == F.col("gone.doc")) & (F.col(f"rows.{x}") == F.col(f"gone.{x}")) & (F.col(f"rows.{y}") == F.col(f"gone.{y}"))
    return rows.join(gone, same, "left_anti").select(*docs.columns)
