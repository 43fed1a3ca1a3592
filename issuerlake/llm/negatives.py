"""Hard-negative mining over shared lists of anchor clusters.

Anchors are grouped by direction: centroids are fitted on a bounded sample of anchors, then every anchor gets
the nearest. Anchors meet the rows in blocks, in order of cluster. In a task that holds some of the rows, each
cluster sorts them once by an upper bound on their score with any member: a row of norm r at the angle t
from the centroid scores at most r * cos(max(0, t - w)) with a member of norm 1, if w is the widest angle
of a member. All members walk this list from the top. A member has finished when its last wanted score
is above the bound of the next row (or the bound is below the least score that counts): nothing below can enter.
Bounds are widened for rounding, scores are exact integers.

A first walk finds each anchor's ``n_positives`` best rows of its label, a second one for each of these the
``n_negatives`` best rows of other labels whose score lies in the band ``low * positive <= 100 * negative <=
high * positive``. Ties go to the smaller id.

Rows with a null id or label, a null vector or null or non-finite components take no part. Vectors become
floor(scale * x). Only vectors of one dimension are compared, and no row with the anchor's own id. Rows that repeat an
id are rows of their own; rows that repeat id, label and vector are one anchor, and each a candidate. Fewer
rows than wanted give all of them; empty tables none. Scores must fit into 52 bits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm.common import share_of
from issuerlake.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Anchors of which centroids are fitted; anchors a cluster has on average; clusters at most.
SAMPLE, MEMBERS, CLUSTERS = 4_096, 32, 1_024
# Bytes of anchors sent to the tasks at once; rows that a task sorts into lists at once; scores held at once.
BLOCK_BYTES, LIST_ROWS, SCORES = 16_000_000, 32_768, 1_000_000
# Rows of a list that its members walk before they first look at the bound; the step doubles.
STEP = 64
SLACK = 1e-6
HITS = "member bigint, id bigint, score bigint"


def prepare(vectors: DataFrame, key: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """id, label, v array<bigint> of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v"))


def directions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and unit rows; a zero row keeps zeros."""
    norms = np.sqrt((m * m).sum(axis=1))
    return norms, m / np.where(norms > 0, norms, 1.0)[:, None]


def centroids(rows: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means, the same for the same rows in the same order."""
    _, units = directions(rows)
    centers = units[np.linspace(0, len(units) - 1, min(count, len(units))).astype(int)]
    for _ in range(rounds):
        near = (units @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, units)
        norms, moved = directions(sums)
        centers = np.where(norms[:, None] > 0, moved, centers)
    return centers


def clustered(anchors: DataFrame, members: int = MEMBERS) -> DataFrame:
    """The distinct anchors with the number ``cluster`` of their nearest centroid, per dimension."""
    known = anchors.select("id", "label", "v").distinct().withColumn("d", F.size("v"))
    counts = {r["d"]: r["n"] for r in known.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per dimension
    centers = {}
    for d, n in counts.items():
        share = share_of(F.xxhash64(F.lit(13), "id", "label"), SAMPLE, n)
        sample = known.where((F.col("d") == d) & share).orderBy("id", "label", "v").limit(2 * SAMPLE).collect()
        rows = [r["v"] for r in sample] or [[0] * d]
        centers[d] = centroids(np.array(rows, np.float64).reshape(len(rows), d), min(CLUSTERS, -(-n // members)))
    shared = anchors.sparkSession.sparkContext.broadcast(centers)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes).tolist():
                at = sizes == d
                m = batch.column("v").filter(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(int(at.sum()), d)
                out[at] = (m.astype(np.float64) @ shared.value[d].T).argmax(axis=1) if d else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "cluster"])

    return known.mapInArrow(assign, "id bigint, label bigint, v array<bigint>, d int, cluster int")


class Block:
    """Anchors of one dimension in order of cluster, and what each wants.

    Wants are pairs of an anchor and a range of scores; without pairs every anchor wants the best of its
    label. ``clusters`` holds centroid, cosine and sine of the widest member's angle, and the range of members.
    """

    def __init__(self, rows: list):
        self.ids, self.labels = (np.array([r[c] for r in rows], np.int64) for c in ("id", "label"))
        self.m = np.array([r["v"] for r in rows], np.float64).reshape(len(rows), len(rows[0]["v"]))
        self.norms, units = directions(self.m)
        numbers = np.array([r["cluster"] for r in rows])
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(rows)]
        self.clusters = []
        for a, b in zip(cuts, cuts[1:]):
            center = directions(units[a:b].sum(axis=0, keepdims=True))[1][0]
            # A zero vector scores zero with everything, within any bound.
            widest = np.arccos(np.clip((units[a:b] @ center)[self.norms[a:b] > 0].min(initial=1.0), -1.0, 1.0)) + SLACK
            self.clusters.append((center, widest, a, b))
        self.same = True
        self.want(np.arange(len(rows)), np.full(len(rows), -np.inf), np.full(len(rows), np.inf))

    def want(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Pairs by anchor; ``low`` and ``high`` are the least and the greatest score that count."""
        self.anchor, self.low, self.high = anchor, low, high
        self.first = np.searchsorted(anchor, np.arange(len(self.ids) + 1))


class Best:
    """The k best hits of every pair of a cluster (numbered from 0): score descending, then id."""

    def __init__(self, pairs: int, k: int):
        self.k, self.floor = k, np.full(pairs, -np.inf)
        self.hits = [np.empty(0, np.int64)] * 3

    def add(self, pair: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        pair, ids, scores = (np.concatenate(x) for x in zip(self.hits, (pair, ids, scores)))
        order = np.lexsort((ids, -scores, pair))
        pair, ids, scores = pair[order], ids[order], scores[order]
        place = np.arange(len(pair)) - np.searchsorted(pair, pair)
        self.hits = [x[place < self.k] for x in (pair, ids, scores)]
        last = place == self.k - 1
        self.floor[pair[last]] = scores[last]


def walk(block: Block, best: Best, center: np.ndarray, widest: float, a: int, b: int, ids, labels, m, norms, units) -> None:
    """The members a to b of a cluster walk the rows in order of the cluster's bound."""
    angle = np.arccos(np.clip(units @ center, -1.0, 1.0))
    bound = norms * np.cos(np.maximum(0.0, angle - widest)) * (1 + SLACK) + SLACK
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    begin = block.first[a]
    pairs = np.arange(begin, block.first[b])
    at, step = 0, STEP
    while at < len(order) and len(pairs):
        # A row below the bound of the next one cannot enter; an equal score still may, by its id.
        needed = np.maximum(best.floor[pairs - begin], block.low[pairs])
        reach = bound[at] * block.norms[block.anchor[pairs]]
        pairs = pairs[np.maximum(reach, SLACK) >= needed]
        if not len(pairs):
            break
        members, member = np.unique(block.anchor[pairs], return_inverse=True)
        rows = order[at : at + max(1, min(step, SCORES // len(pairs)))]
        scores = np.rint(m[rows] @ block.m[members].T)
        counts = labels[rows][:, None] == block.labels[members][None, :]
        counts = (counts if block.same else ~counts) & (ids[rows][:, None] != block.ids[members][None, :])
        low, high = np.maximum(best.floor[pairs - begin], block.low[pairs]), block.high[pairs]
        wanted = scores[:, member]
        row, col = np.nonzero(counts[:, member] & (wanted >= low) & (wanted <= high))
        if len(row):
            best.add(pairs[col] - begin, ids[rows[row]], wanted[row, col].astype(np.int64))
        at += len(rows)
        step *= 2


def search(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """member (number of the pair), id, score: every task's k best rows of every pair."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        width = b.m.shape[1]
        best = [Best(int(b.first[end] - b.first[start]), k) for _, _, start, end in b.clusters]
        held: list = []

        def flush() -> None:
            ids, labels, m = (np.concatenate(x) for x in zip(*held))
            held.clear()
            norms, units = directions(m)
            for own, cluster in zip(best, b.clusters):
                walk(b, own, *cluster, ids, labels, m, norms, units)

        for batch in batches:
            lists = batch.column("v")
            fits = np.array(lists.value_lengths()) == width
            m = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(int(fits.sum()), width)
            held.append(tuple(batch.column(c).to_numpy()[fits] for c in ("id", "label")) + (m.astype(np.float64),))
            if sum(len(h[0]) for h in held) >= LIST_ROWS:
                flush()
        if held:
            flush()
        for own, (_, _, start, _) in zip(best, b.clusters):
            hits = own.hits[0] + b.first[start], *own.hits[1:]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits], names=["member", "id", "score"])

    return top(rows.select("id", "label", "v").mapInArrow(run, HITS), "member", k)


def top(hits: DataFrame, group: str, k: int) -> DataFrame:
    """The k best hits of a group, ranked; each task sends k of a group at most."""
    order = Window.partitionBy(group).orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def blocks(anchors: DataFrame, limit: int) -> Iterator[Block]:
    """Anchors in order of dimension, cluster and id, in blocks of limited size that the driver holds one at a time."""
    rows: list = []
    size = 0
    for r in anchors.orderBy("d", "cluster", "id", "label", "v").toLocalIterator():
        cost = 8 * len(r["v"]) + 64
        if rows and (size + cost > limit or r["d"] != rows[0]["d"]):
            yield Block(rows)
            rows, size = [], 0
        rows.append(r)
        size += cost
    if rows:
        yield Block(rows)


def mine(
    anchors: DataFrame, rows: DataFrame, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both tables come from ``prepare``. Every block of anchors takes two passes over the rows; its positives (at
    most ``n_positives`` an anchor) return to the driver as the second pass's bands, its negatives are
    written to a shared folder, so no plan grows with the anchors. A task holds ``LIST_ROWS`` rows and the
    block; of each pair its best hits alone leave it.
    """
    session = rows.sparkSession
    path = shared_dir(session, "negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    session.createDataFrame([], schema).write.parquet(path)
    for block in blocks(clustered(anchors), block_bytes):
        found = search(rows, block, n_positives).toPandas().sort_values(["member", "rank"])
        if found.empty:
            continue
        anchor, positive, score = (found[c].to_numpy(np.int64) for c in ("member", "id", "score"))
        # 100 * s >= low * p and 100 * s <= high * p, in integers.
        block.same = False
        block.want(anchor, -((-low * score) // 100).astype(np.float64), ((high * score) // 100).astype(np.float64))
        pairs = session.createDataFrame(
            pa.table({
                "member": np.arange(len(anchor)), "anchor_id": block.ids[anchor], "positive_id": positive, "positive_score": score,
            }).to_pandas()
        )
        hits = search(rows, block, n_negatives).join(pairs, "member")
        named = {"id": "negative_id", "score": "negative_score"}
        hits.withColumnsRenamed(named).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
    return session.read.schema(schema).parquet(path)
