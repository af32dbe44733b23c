"""Hard negatives by a GNAT-style tree of generalised hyperplanes.

The vectors are integer, so inner products are exact. A node of the tree has up to ``FAN`` split
points; a vector belongs to the child whose split point is nearest. For every split point and
every sibling subtree the node keeps the least and greatest distance between them. An anchor that looks
for inner products between two bounds looks, as |a - x|^2 = |a|^2 + |x|^2 - 2<a, x>, for vectors in an
annulus around it; a subtree is left out if, by the triangle inequality over any split point, its
distance range doesn't meet the annulus. The leaves that stay are searched row by row.

The split points come from a bounded sample (``SAMPLE`` vectors), and the tree with its ranges is
broadcast; its size depends on ``SAMPLE`` alone. Every vector is indexed: a leaf is stored in blocks
of about ``BLOCK`` vectors, so a leaf may grow without bound. Anchors travel to blocks, never
all rows to all anchors. A search first takes the leaf that promises the highest scores; the
last of the k rows found there is the bar that other leaves must be able to pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, hash_share, materialize

#: Vectors that the tree is fitted on, at most; children of a node; least number of sampled vectors that are split.
SAMPLE = 1 << 14
FAN = 16
LEAF = 32
LEVELS = 3
#: Vectors in a block of a leaf, and anchors that go to a block together.
BLOCK = 1024
TOGETHER = 256
#: Bounds of scores: squared lengths stay below, and so (Cauchy-Schwarz) do all inner products.
FAR = 2**62
_EXACT = float(2**53)


# ------------------------------------------------------------------ kernels


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (int64) of the rows of two integer arrays.

    Doubles are exact while the product of lengths stays below 2**53; beyond, integers are used.
    Their sums may wrap around on the way, but come out right as the result fits.
    """
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    if np.sqrt((x * x).sum(1).max()) * np.sqrt((y * y).sum(1).max()) < _EXACT / 2:
        return (x @ y.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def squares(a: np.ndarray) -> np.ndarray:
    """Squared lengths of the rows (double)."""
    return (a.astype(np.float64) ** 2).sum(1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(squares(a)[:, None] + squares(b)[None, :] - 2.0 * inner(a, b).astype(np.float64), 0.0))


class Node:
    """Split points, and for each child a Node or the number of a leaf."""

    def __init__(self, points: np.ndarray, children: list):
        self.points, self.children = points, children
        #: By split point and child; empty children have a lower bound above the upper one.
        self.low = np.full((len(points), len(children)), np.inf)
        self.high = np.full((len(points), len(children)), -np.inf)
        #: By child: least and greatest squared length and label.
        self.short, self.long = np.full(len(children), np.inf), np.full(len(children), -np.inf)
        self.first, self.last = np.full(len(children), FAR), np.full(len(children), -FAR)


def spread(sample: np.ndarray, fan: int) -> np.ndarray:
    """Positions of up to ``fan`` split points: each next one is the candidate farthest from those taken.

    Candidates are the first three times as many vectors. Vectors equal to one taken are passed over.
    """
    pool = sample[: 3 * fan]
    taken = [0]
    away = distances(pool, pool[:1])[:, 0]
    while len(taken) < fan and away.max() > 0:
        taken.append(int(away.argmax()))
        away = np.minimum(away, distances(pool, pool[taken[-1:]])[:, 0])
    return np.array(taken)


class Tree:
    """The whole tree; ``root`` is a Node, ``paths[leaf]`` lists the (node, child) that lead to a leaf."""

    def __init__(self, sample: np.ndarray, fan: int = FAN, leaf: int = LEAF, levels: int = LEVELS):
        self.fan, self.levels = fan, levels
        self.paths: list[list[tuple[Node, int]]] = []
        self.root = self._grow(sample, [], fan, leaf, levels)

    def _grow(self, rows: np.ndarray, path: list, fan: int, leaf: int, levels: int):
        points = rows[spread(rows, fan)] if levels and (len(rows) > leaf or not path) and len(rows) else rows[:0]
        if len(points) < 2 and path:
            self.paths.append(path)
            return len(self.paths) - 1
        if not len(points):  # no sample at all: one leaf
            points = np.zeros((1, rows.shape[1]), rows.dtype)
        node = Node(points, [])
        near = distances(rows, points).argmin(axis=1)
        for k in range(len(points)):
            node.children.append(self._grow(rows[near == k], [*path, (node, k)], fan, leaf, levels - 1))
        Node.__init__(node, points, node.children)
        return node

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(rows), np.int32)
        work = [(self.root, np.arange(len(rows)))]
        while work:
            node, own = work.pop()
            near = distances(rows[own], node.points).argmin(axis=1)
            for k, child in enumerate(node.children):
                part = own[near == k]
                if isinstance(child, Node):
                    work.append((child, part)) if len(part) else None
                else:
                    out[part] = child
        return out

    def block_ranges(self, leaf: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of the rows to each split point on the leaf's path, padded to the longest path."""
        low, high = np.full(self.levels * self.fan, np.inf), np.full(self.levels * self.fan, -np.inf)
        for d, (node, _) in enumerate(self.paths[leaf]):
            away = distances(rows, node.points)
            at = slice(d * self.fan, d * self.fan + len(node.points))
            low[at], high[at] = away.min(axis=0), away.max(axis=0)
        return low, high

    def settle(self, leaf: int, low: np.ndarray, high: np.ndarray, short: float, long: float, first: int, last: int) -> None:
        """Widen the ranges of all subtrees on the leaf's path by those of the leaf."""
        for d, (node, k) in enumerate(self.paths[leaf]):
            at = slice(d * self.fan, d * self.fan + len(node.points))
            node.low[:, k] = np.minimum(node.low[:, k], low[at])
            node.high[:, k] = np.maximum(node.high[:, k], high[at])
            node.short[k], node.long[k] = min(node.short[k], short), max(node.long[k], long)
            node.first[k], node.last[k] = min(node.first[k], first), max(node.last[k], last)

    def bounds(self, queries: np.ndarray, label: np.ndarray, same: bool, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """By query and leaf: the highest score within [least, most] that the leaf may hold, or -inf if none.

        Never too low, so a leaf left out holds no such row.
        """
        out = np.full((len(queries), len(self.paths)), -np.inf)
        size = squares(queries)
        work = [(self.root, np.arange(len(queries)))]
        while work:
            node, own = work.pop()
            away, q2 = distances(queries[own], node.points), size[own][:, None]
            # Rounding of distances: far below this, even for the longest vectors.
            slack = 1e-6 * (np.sqrt(q2) + np.sqrt(np.maximum(node.long, 0))[None, :] + np.sqrt(squares(node.points).max()))
            with np.errstate(invalid="ignore"):
                lower = np.maximum(np.maximum(node.low[None] - away[:, :, None], away[:, :, None] - node.high[None]).max(axis=1) - slack, 0.0)
                upper = (away[:, :, None] + node.high[None]).min(axis=1) + slack
                inside = np.sqrt(np.maximum(q2 + node.short[None] - 2.0 * most[own][:, None], 0.0))
                outside = q2 + node.long[None] - 2.0 * least[own][:, None]
                alive = (node.long >= 0)[None] & (outside >= 0) & (lower <= np.sqrt(np.maximum(outside, 0.0)) + slack) & (upper >= inside - slack)
                top = np.minimum((q2 + node.long[None] - lower**2) / 2, np.sqrt(q2 * np.maximum(node.long, 0)[None]))
                top = np.minimum(top * (1 + 1e-9 * np.sign(top)) + 1e-6 * (1 + q2 + node.long[None]), most[own][:, None])
            mine = label[own][:, None]
            alive &= (node.first[None] <= mine) & (mine <= node.last[None]) if same else (node.first[None] != mine) | (node.last[None] != mine)
            for k, child in enumerate(node.children):
                part = own[alive[:, k]]
                if isinstance(child, Node):
                    work.append((child, part)) if len(part) else None
                else:
                    out[part, child] = top[alive[:, k], k]
        return out


# ------------------------------------------------------------------ the index


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """An array<int> column as rows of ``width`` numbers; shorter vectors are filled up with zeros."""
    at = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    if (at == width).all():
        return flat.reshape(len(at), width)
    out = np.zeros((len(at), width), np.int32)
    out[np.repeat(np.arange(len(at)), at), np.arange(len(flat)) - np.repeat(np.cumsum(at) - at, at)] = flat
    return out


class Index:
    """The fitted tree and the stored blocks (leaf, block, n, ids, labels, vectors); ``width`` is the longest vector."""

    def __init__(self, tree: Tree, blocks: DataFrame, parts: list[int], width: int):
        self.tree, self.blocks, self.parts, self.width = tree, blocks, parts, width


def build(rows: DataFrame) -> Index:
    """Index every row of (vec_id, label, v)."""
    spark = rows.sparkSession
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    # So few vectors (by their hash) that sorting them costs little at any size.
    few = rows.select("v", F.xxhash64("v").alias("k")).where(hash_share(F.col("k"), 2.0 * SAMPLE / max(n, 1))).orderBy("k", "v").limit(SAMPLE)
    sample = _vectors(few.select("v").toArrow().column(0).combine_chunks(), width)
    order = np.sort(np.unique(sample, axis=0, return_index=True)[1])  # equal vectors once, in the order of their hash
    # While the sample allows it, a leaf holds about a block.
    tree = Tree(sample[order], leaf=max(LEAF, len(order) * BLOCK // max(n, 1)))
    shared = spark.sparkContext.broadcast(tree)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_vectors(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec_id", "label", "v"])

    placed = materialize(rows.select("vec_id", "label", "v").mapInArrow(leaves, "leaf int, vec_id long, label long, v array<int>"), "vectors-placed")
    count = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row for each leaf of the tree
    parts = [-(-count.get(k, 0) // BLOCK) for k in range(len(tree.paths))]
    dealt = F.array(*map(F.lit, [max(1, p) for p in parts]))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        leaf, block = key[0].as_py(), key[1].as_py()
        table = table.sort_by("vec_id").combine_chunks()
        v = _vectors(table.column("v").combine_chunks(), width)
        low, high = shared.value.block_ranges(leaf, v)
        ids, labels, size = table.column("vec_id").to_numpy(), table.column("label").to_numpy(), squares(v)
        out = [leaf, block, len(v), _packed(ids), _packed(labels), _packed(v), low.tolist(), high.tolist(), float(size.min()), float(size.max()), int(labels.min()), int(labels.max())]
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(out, kinds, strict=True)], names)

    names = ["leaf", "block", "n", "ids", "labels", "vectors", "low", "high", "short", "long", "first", "last"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    schema = "leaf int, block int, n int, ids binary, labels binary, vectors binary, low array<double>, high array<double>, short double, long double, first long, last long"
    keyed = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.get(dealt, "leaf")).cast("int"))
    blocks = materialize(keyed.groupBy("leaf", "block").applyInArrow(pack, schema), "vector-blocks")
    discard(placed)
    ends = [f(F.get(c, F.lit(i))) for c, f in (("low", F.min), ("high", F.max)) for i in range(tree.levels * tree.fan)]
    for r in blocks.groupBy("leaf").agg(*ends, F.min("short"), F.max("long"), F.min("first"), F.max("last")).collect():  # a row for each leaf
        low, high = np.array(r[1:-4]).reshape(2, -1)
        tree.settle(r[0], low, high, *r[-4:])
    return Index(tree, blocks.select("leaf", "block", "n", "ids", "labels", "vectors"), parts, width)


# ------------------------------------------------------------------ the search

_ASK = "leaf int, block int, m int, anchors binary, tags binary, marks binary, least binary, most binary, bar binary, bar_id binary, sought binary"


def _send(queries: DataFrame, index: Index, same: bool, rest: bool) -> DataFrame:
    """Packs of anchors for the leaves to search: the best one of each anchor, or (``rest``) all others that may pass its bar."""
    shared = queries.sparkSession.sparkContext.broadcast(index.tree)
    parts, width = index.parts, index.width

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4 * TOGETHER):
                batch = whole.slice(at, 4 * TOGETHER)
                anchors, tags, marks, least, most, bar, bar_id = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4, 5, 6, 7))
                v = _vectors(batch.column(3), width)
                top = shared.value.bounds(v, marks, same, least.astype(float), most.astype(float))
                best = top.argmax(axis=1)
                row = np.arange(len(v))
                go = np.zeros(top.shape, bool)
                if rest:
                    go = (top > -np.inf) & (top >= bar.astype(float)[:, None])
                    go[row, best] = False
                else:
                    go[row, best] = top[row, best] > -np.inf
                for leaf in np.flatnonzero(go.any(axis=0)):
                    own = np.flatnonzero(go[:, leaf])
                    for lo in range(0, len(own), TOGETHER):
                        p = own[lo : lo + TOGETHER]
                        values = [x[p] for x in (anchors, tags, marks, least, most, bar, bar_id)] + [v[p]]
                        for block in range(parts[leaf]):
                            out = [int(leaf), block, len(p), *map(_packed, values)]
                            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, [pa.int32()] * 3 + [pa.binary()] * 8, strict=True)], names)

    names = [x.split()[0] for x in _ASK.split(", ")]
    return queries.select("anchor_id", "tag", "label", "v", "least", "most", "bar", "bar_id").mapInArrow(send, _ASK)


def _search(sent: DataFrame, index: Index, same: bool, k: int) -> DataFrame:
    """The first k rows of each block for each anchor sent to it, no worse than its bar: anchor_id, tag, found_id, score."""
    width = index.width

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                v = np.frombuffer(r["vectors"], np.int32).reshape(len(ids), width)
                anchors, tags, marks, least, most, bar, bar_id = (np.frombuffer(r[c], np.int64) for c in ("anchors", "tags", "marks", "least", "most", "bar", "bar_id"))
                sought = np.frombuffer(r["sought"], np.int32).reshape(len(anchors), width)
                once, at = np.unique(anchors, return_index=True)  # an anchor may ask for several windows
                scores = inner(sought[at], v)[np.searchsorted(once, anchors)]
                fits = (scores >= least[:, None]) & (scores <= most[:, None]) & ((scores > bar[:, None]) | (scores == bar[:, None]) & (ids[None] <= bar_id[:, None]))
                fits &= ((labels[None] == marks[:, None]) & (ids[None] != anchors[:, None])) if same else (labels[None] != marks[:, None])
                found = []
                for q in np.flatnonzero(fits.any(axis=1)):
                    own = np.flatnonzero(fits[q])
                    own = own[np.argsort(-scores[q, own], kind="stable")[:k]]  # rows of a block lie by id
                    found.append((np.full(len(own), anchors[q]), np.full(len(own), tags[q]), ids[own], scores[q, own]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["anchor_id", "tag", "found_id", "score"])

    # A fixed number of tasks: what they read is small for the work it makes, so it shouldn't be coalesced.
    tasks = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = sent.repartition(tasks, "leaf", "block").join(index.blocks, ["leaf", "block"])
    return pairs.mapInArrow(search, "anchor_id long, tag long, found_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, index: Index, same: bool, k: int) -> DataFrame:
    """For each (anchor_id, tag) of ``queries`` its first k rows by score, then id: found_id, score, rank.

    ``queries`` has anchor_id, tag (long, tells several windows of an anchor apart), label, v, least
    and most (the window of scores). With ``same`` rows of the anchor's label count, without the
    anchor; else those of other labels.
    """
    open_ = queries.withColumns({"bar": F.lit(-FAR), "bar_id": F.lit(2**63 - 1)})
    early = materialize(_first(_search(_send(open_, index, same, False), index, same, k), k), "vectors-found")
    bars = early.where(F.col("rank") == k).select("anchor_id", "tag", F.col("score").alias("bar"), F.col("found_id").alias("bar_id"))
    closed = queries.join(bars, ["anchor_id", "tag"], "left").withColumns({"bar": F.coalesce("bar", F.lit(-FAR)), "bar_id": F.coalesce("bar_id", F.lit(2**63 - 1))})
    late = _search(_send(closed, index, same, True), index, same, k)
    out = materialize(_first(early.drop("rank").unionByName(late), k), "vectors-nearest")
    discard(early)
    return out


def clean(rows: DataFrame) -> DataFrame:
    """(vec_id long, label long, v array<int>) of the rows of (vec_id, label, v array<double>) that take part.

    Left out are rows without vec_id, label or vector, with a null or non-finite component, and
    those whose squared length is 2**62 or more, as their scores might not fit a long. Of rows that
    share a vec_id the one with the least (label, v) counts, once; so repeated rows change nothing.
    """
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    whole = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is greater than all
    good = rows.where("vec_id is not null and label is not null and v is not null").where(whole).where(length < float(FAR))
    ints = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), F.transform("v", lambda x: x.cast("int")).alias("v")).alias("r"))
    return ints.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v")


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Negatives that score between ``low`` and ``high`` per cent of a positive.

    ``rows`` has vec_id, label and v, whose components are whole numbers. Anchors are the rows whose vec_id
    ``every`` divides. A row's score is its inner product with the anchor; higher scores come first, ties by
    smaller vec_id. An anchor's positives are its first ``positives`` other rows of its label; for each,
    the first ``negatives`` rows of other labels come back for which low * positive_score <=
    100 * negative_score <= high * positive_score. So a positive of negative score has none, and one
    of score 0 those of score 0. Vectors of other lengths count as filled up with zeros. ``clean`` says
    which rows take part; an empty table gives no rows. Columns besides the three are ignored.

    Of rows equal in label and vector only the smallest ids can be among the first of anything, so
    more of them than that are not indexed; a group of copies of any size costs no more.
    """
    table = materialize(clean(rows), "vectors")
    copies = Window.partitionBy(F.xxhash64("v"), "label", "v").orderBy("vec_id")
    useful = table.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= max(positives + 1, negatives)).drop("nth")
    index = build(useful)
    anchors = table.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    whole = anchors.withColumns({"tag": F.lit(0).cast("long"), "least": F.lit(-FAR), "most": F.lit(FAR)})
    near = nearest(whole, index, True, positives)
    pairs = near.select("anchor_id", F.col("found_id").alias("tag"), F.col("score").alias("positive_score"))
    # low * s <= 100 * t <= high * s, for whole t; decimals so that no product overflows.
    s = F.col("positive_score").cast("decimal(20,0)")
    least, most = F.ceil(s * low / 100).cast("long"), F.floor(s * high / 100).cast("long")
    windows = pairs.join(anchors, "anchor_id").withColumns({"least": least, "most": most}).where("least <= most").drop("positive_score")
    hard = nearest(windows, index, False, negatives)
    return hard.join(pairs, ["anchor_id", "tag"]).select("anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def noisy_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and whole-number vector of ``embeddings``: labels of ids divisible by 7 move on by one, components become floor(256 x)."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A component that isn't finite stays as it is (floor would turn it into a number).
    whole = lambda x: F.when(F.abs(x) < F.lit(float("inf")), F.floor(F.lit(256.0) * x.cast("double")).cast("double")).otherwise(x.cast("double"))
    return embeddings.select("vec_id", label.alias("label"), F.transform("embedding", whole).alias("v"))
