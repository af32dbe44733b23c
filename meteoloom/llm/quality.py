"""Quality scores by histogram gradient-boosted trees over statistics of a document.

A text is described by ``STATISTICS`` numbers of its bytes, words and lines. Each statistic is cut
into at most ``BINS`` bins at quantiles of the training rows. Trees are grown level by level: the
gradients of the logistic loss are summed by (node, statistic, bin), and a node is split where
the sums promise the largest gain. Every tree is a full binary tree of ``DEPTH`` levels held in
flat arrays, so that all rows walk all trees by ``DEPTH`` steps of array indexing.

It is fitted on the driver from a bounded sample: at most ``LABELLED`` labelled documents, those
first by a hash of doc_id. Scoring reads whole texts in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rolling, as_bytes, hash_share, word_spans

#: Labelled documents that the model is fitted on, at most.
LABELLED = 20000
BINS = 64
DEPTH = 4
TREES = 120
RATE = 0.1
#: Least sum of second derivatives in a leaf, and what is added to it when its value is set.
LEAST = 1.0
SHRINK = 1.0
THRESHOLD = 0.7

_LOWER, _UPPER, _DIGIT, _MARK, _WIDE, _BLANK = range(6)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[0x80:] = _WIDE
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BLANK
_STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?"])

NAMES = (
    "bytes", "words", "lines", "lower", "upper", "digits", "marks", "wide", "blanks", "commonest_mark", "entropy", "word_mean", "word_deviation",
    "word_longest", "words_of_marks", "words_with_mark", "words_ending", "words_capital", "words_shouted", "words_distinct", "words_commonest", "words_repeated", "pairs_distinct", "lines_repeated", "line_mean", "run_longest",
)
STATISTICS = len(NAMES)


def text_statistics(text: str | None) -> np.ndarray:
    """The statistics of one text in the order of ``NAMES``; an empty or null one has only zeros.

    bytes, words and lines are logarithms; word_mean, word_deviation, word_longest, line_mean and
    run_longest are logarithms of lengths in bytes; the rest are shares of bytes, words or lines.
    """
    data = as_bytes(text)
    out = np.zeros(STATISTICS)
    if not len(data):
        return out
    at = dict.fromkeys(NAMES, 0.0)
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, counts, minlength=6) / len(data)
    at |= dict(zip(("lower", "upper", "digits", "marks", "wide", "blanks"), kinds, strict=True))
    at["commonest_mark"] = counts[_KIND == _MARK].max() / len(data)
    p = counts[counts > 0] / len(data)
    at["entropy"] = float(-(p * np.log2(p)).sum() / 8)
    at["bytes"] = np.log1p(len(data))
    edges = np.flatnonzero(np.diff(data))
    at["run_longest"] = np.log1p(np.diff(np.concatenate([[-1], edges, [len(data) - 1]])).max())

    roll = Rolling(data)
    cut = np.flatnonzero(data == 0x0A)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(data)]])
    full = last > first
    lines = roll.slices(first[full], last[full])
    if len(lines):
        at["lines"] = np.log1p(len(lines))
        at["lines_repeated"] = 1 - len(np.unique(lines)) / len(lines)
        at["line_mean"] = np.log1p((last - first)[full].mean())

    start, end = word_spans(data)
    n = len(start)
    if n:
        length = end - start
        # Running numbers of bytes of a kind give the kinds in each word.
        kind = _KIND[data]
        marks, upper, lower = (np.concatenate([[0], np.cumsum(kind == k)]) for k in (_MARK, _UPPER, _LOWER))
        own_marks, own_upper, own_lower = marks[end] - marks[start], upper[end] - upper[start], lower[end] - lower[start]
        words = roll.slices(start, end)
        _, seen = np.unique(words, return_counts=True)
        at |= {"words": np.log1p(n), "word_mean": np.log1p(length.mean()), "word_deviation": np.log1p(length.std()), "word_longest": np.log1p(length.max())}
        at |= {"words_of_marks": (own_marks == length).mean(), "words_with_mark": (own_marks > 0).mean(), "words_ending": _STOPS[data[end - 1]].mean(), "words_capital": (kind[start] == _UPPER).mean()}
        at |= {"words_shouted": ((own_upper > 1) & (own_lower == 0)).mean(), "words_distinct": len(seen) / n, "words_commonest": seen.max() / n}
        if n > 1:
            at["words_repeated"] = (words[1:] == words[:-1]).mean()
            at["pairs_distinct"] = len(np.unique(roll.slices(start[:-1], end[1:]))) / (n - 1)
    out[:] = [at[k] for k in NAMES]
    return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the doc_id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Forest:
    """Full binary trees in flat arrays.

    ``feature`` and ``cut`` have a row for each tree and a column for each inner node, in level
    order: the children of node k are 2k+1 and 2k+2, and a row goes to the second if its number is
    greater than the cut. ``value`` has a column for each leaf. ``base`` is the score of no tree.
    """

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.cut, self.value = base, feature, cut, value

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches, over all trees, and the base."""
        if not len(self.feature) or not len(rows):
            return np.full(len(rows), self.base)
        tree = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(rows), len(self.feature)), np.int64)
        for _ in range(int(np.log2(self.value.shape[1]))):
            x = np.take_along_axis(rows, self.feature[tree, node], axis=1)
            node = 2 * node + 1 + (x > self.cut[tree, node])
        return self.base + self.value[tree, node - self.feature.shape[1]].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -50, 50)))


def quantile_cuts(rows: np.ndarray) -> list[np.ndarray]:
    """For each statistic at most ``BINS`` - 1 rising cuts between values that occur."""
    out = []
    for x in rows.T:
        seen = np.unique(x)
        if len(seen) > BINS:
            seen = np.unique(np.quantile(x, np.linspace(0, 1, BINS), method="nearest"))
        out.append((seen[:-1] + seen[1:]) / 2)
    return out


def best_splits(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best statistic, last bin of the left part, and gain for each node.

    ``g`` and ``h`` hold sums of first and second derivatives by node, statistic and bin. The
    gain is what the split takes off the loss; it is -inf where either part would be below ``LEAST``.
    The first statistic and bin win ties.
    """
    gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
    gt, ht = g.sum(axis=2)[:, :, None], h.sum(axis=2)[:, :, None]
    gr, hr = gt - gl, ht - hl
    gain = gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK) - gt**2 / (ht + SHRINK)
    gain = np.where((hl >= LEAST) & (hr >= LEAST), gain, -np.inf)
    flat = gain.reshape(len(g), -1)
    at = flat.argmax(axis=1)
    return at // gain.shape[2], at % gain.shape[2], flat[np.arange(len(g)), at]


def fit(rows: np.ndarray, good: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boost trees on the logistic loss. With no rows, or all of one label, only the base is left:
    the logit of the share of good rows, counted with one good and one bad row more."""
    share = (good.sum() + 1) / (len(good) + 2)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if not len(rows) or good.all() or not good.any():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = quantile_cuts(rows)
    bins = np.stack([np.searchsorted(c, x) for c, x in zip(cuts, rows.T, strict=True)], axis=1)
    width, columns = BINS + 1, rows.shape[1]
    cell = bins + width * np.arange(columns)
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    margin = np.full(len(rows), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - good, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            nodes = 2**level
            key = (node[:, None] * (width * columns) + cell).ravel()
            shape = (nodes, columns, width)
            sums = (np.bincount(key, np.repeat(x, columns), minlength=nodes * columns * width).reshape(shape) for x in (g, h))
            best, last, gain = best_splits(*sums)
            for k in np.flatnonzero(gain > 1e-9):
                feature[t, nodes - 1 + k], cut[t, nodes - 1 + k] = best[k], cuts[best[k]][last[k]]
            own = nodes - 1 + node
            node = 2 * node + (np.take_along_axis(rows, feature[t, own][:, None], axis=1)[:, 0] > cut[t, own])
        down, curve = (np.bincount(node, x, minlength=leaves) for x in (g, h))
        value[t] = -RATE * down / (curve + SHRINK)
        margin += value[t, node]
    return Forest(base, feature, cut, value)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_statistics(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["_id", "good", "statistics"])


def train(docs: DataFrame, labels: DataFrame) -> Forest:
    """Fit from the training rows; labels of held-out rows are not read.

    Labels with a null id or value are ignored; a document with several labels is good only if
    all say so. Of rows that share a doc_id the one with the least statistics counts, once.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") > 0).alias("good"))
    order = F.xxhash64("_id")
    # So few ids (by their hash) that sorting them costs little at any size, and still more than enough.
    n = known.count()
    chosen = known.where(hash_share(order, 2.0 * LABELLED / max(n, 1))).orderBy(order, "_id").limit(LABELLED)
    text = docs.select(F.col("doc_id").alias("_doc"), "text")
    sample = text.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "good", "text")
    sample = sample.mapInArrow(_describe, "_id long, good boolean, statistics array<double>")
    got = sample.groupBy("_id").agg(F.first("good").alias("good"), F.min("statistics").alias("statistics")).toArrow().sort_by("_id")
    rows = np.array(got.column("statistics").to_pylist(), float).reshape(-1, STATISTICS)
    return fit(rows, np.array(got.column("good").to_pylist(), float))


def quality(docs: DataFrame, model: Forest) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; null texts count as empty.

    Only the text enters a score, so repeated rows and copies score alike. A null doc_id is
    not held out. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.base, model.feature, model.cut, model.value))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Forest(*shared.value)
        for batch in batches:
            rows = np.array([text_statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, STATISTICS)
            scores = np.concatenate([own.scores(rows[i : i + 1000]) for i in range(0, max(len(rows), 1), 1000)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
