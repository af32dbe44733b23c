"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other training text is unlabelled, whatever
its label says. With class prior p, logistic loss l and scores g, the risk to minimise is
p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]); where the second part would fall
below zero it counts as zero, which keeps the model from fitting the unlabelled positives as
negatives. The bias is then set so that a score of 0.7 is the cut with
the best F1 that positives, unlabelled texts and prior let one estimate.

The classifier is linear in the words of a text and their prefixes (present or not, and how
often), of those that are clearly commoner in the positives than in the unlabelled texts.
It is fitted on the driver from a bounded sample: at most ``POSITIVES`` confirmed documents and
``UNLABELLED`` others, those first by a hash of doc_id. Scoring reads whole texts in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rolling, as_bytes, hash_share

POSITIVES = 4000
UNLABELLED = 12000
#: Features kept at most, and positives that one must occur in.
FEATURES = 1 << 16
LEAST = 3
#: Standard errors by which a feature must be commoner in the positives than in the rest.
LIFT = 4.0
PRIOR = 0.1
THRESHOLD = 0.7
LOGIT = float(np.log(THRESHOLD / (1 - THRESHOLD)))

# Letters of ASCII in lower case, bytes of longer characters as they are, all else 0.
_LETTER = np.zeros(256, np.uint8)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_HEADS = (4, 6)
_SALTS = (np.uint64(0x5BD1E995_5BD1E995), np.uint64(0x1B873593_1B873593))


def text_features(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit features: each word, its first four and six bytes, and for these six
    that two or four words of the text start with them."""
    data = _LETTER[as_bytes(text)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data > 0
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint32)
    roll = Rolling(data)
    found = [roll.slices(start, end)]
    for n, salt in zip(_HEADS, _SALTS, strict=True):
        own = start[end - start >= n]
        heads, counts = np.unique(roll.slices(own, own + n), return_counts=True)
        found.append(heads ^ salt)
    found += [heads[counts >= least] ^ np.uint64(int(_SALTS[-1]) * (least + 1) % 2**64) for least in (2, 4)]
    return np.unique((np.concatenate(found) >> np.uint64(32)).astype(np.uint32))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the doc_id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Linear classifier over sorted features; small enough to broadcast (``FEATURES`` at most)."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def sum(self, features: np.ndarray) -> float:
        """Weights of those features (sorted) that the model has."""
        if not len(features) or not len(self.features):
            return 0.0
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        return float(self.weights[at[self.features[at] == features]].sum())

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.sum(text_features(text)), -50, 50))))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, folds: int = 3) -> Model:
    """The model of all texts, with its cut set on texts that each fold's model hasn't seen.

    Without positives or unlabelled texts the model gives the prior to every text.
    """
    whole = minimise(positive, unlabelled, prior)
    if len(positive) < 2 * folds or len(unlabelled) < 2 * folds:
        return whole
    p, u = [], []
    for k in range(folds):
        part = minimise([d for i, d in enumerate(positive) if i % folds != k], [d for i, d in enumerate(unlabelled) if i % folds != k], prior)
        p += [part.sum(d) for d in positive[k::folds]]
        u += [part.sum(d) for d in unlabelled[k::folds]]
    return Model(whole.features, whole.weights, LOGIT - threshold(np.array(p), np.array(u), prior))


def risk(unlabelled: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk of the scores of some unlabelled and positive texts, and its slope by each score.

    Where the second part would be below zero it is held there and has no slope.
    """
    su, sp = 1 / (1 + np.exp(-np.clip(unlabelled, -50, 50))), 1 / (1 + np.exp(-np.clip(positive, -50, 50)))
    own = prior * np.logaddexp(0, -positive).mean()
    rest = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
    # The slope of l(g) is s - 1, that of l(-g) is s; their difference for a positive is -1.
    if rest >= 0:
        return own + rest, su / len(su), np.full(len(sp), -prior / len(sp))
    return own, np.zeros(len(su)), prior * (sp - 1) / len(sp)


def minimise(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 40, seed: int = 7) -> Model:
    """Minimise the non-negative risk by Adam over mini-batches."""
    flat = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.uint32), np.zeros(0), flat)
    seen, df = np.unique(np.concatenate([*positive, *unlabelled]), return_counts=True)
    pos_seen, pos_df = np.unique(np.concatenate(positive), return_counts=True)
    own = np.zeros(len(seen))
    own[np.searchsorted(seen, pos_seen)] = pos_df
    share = np.minimum(df, len(unlabelled)) / len(unlabelled)
    lift = (own / len(positive) - share) * np.sqrt(len(positive) / (share * (1 - share) + 1e-4))
    keep = np.flatnonzero((own >= min(LEAST, len(positive))) & (lift >= LIFT))
    keep = np.sort(keep[np.argsort(-lift[keep], kind="stable")[:FEATURES]])
    features = seen[keep]

    def rows(docs):
        out = []
        for d in docs:
            at = np.minimum(np.searchsorted(features, d), max(len(features) - 1, 0))
            out.append(at[features[at] == d] if len(features) else at[:0])
        return out

    pos, unl = rows(positive), rows(unlabelled)
    rng = np.random.default_rng(seed)
    n = len(features)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = flat
    step, size = 0, 1024

    def batch(docs, pick):
        ix = np.concatenate([docs[i] for i in pick]) if len(pick) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(pick)), [len(docs[i]) for i in pick])
        return ix, row, np.bincount(row, w[ix], minlength=len(pick)) + w[n]

    for _ in range(rounds):
        order = rng.permutation(len(unl))
        for lo in range(0, len(order), size):
            pick_u = order[lo : lo + size]
            pick_p = rng.choice(len(pos), min(len(pos), size // 2), replace=False)
            (iu, ru, zu), (ip, rp, zp) = batch(unl, pick_u), batch(pos, pick_p)
            _, gu, gp = risk(zu, zp, prior)
            g = np.bincount(iu, gu[ru], minlength=n + 1).astype(float) + np.bincount(ip, gp[rp], minlength=n + 1)
            g[n] += gu.sum() + gp.sum()
            g[:n] += 1e-4 * w[:n] / max(1, n) ** 0.5
            step += 1
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            np.maximum(w[:n], 0, out=w[:n])  # every feature kept speaks for toxicity
    return Model(features, w[:n].copy(), float(w[n]))


def threshold(positive: np.ndarray, unlabelled: np.ndarray, prior: float, beta: float = 1.0) -> float:
    """The cut with the best F-beta as positives and unlabelled texts show it.

    With the share r of positives and u of unlabelled texts above a cut, recall is r and
    precision is prior * r / u. Half way to the next lower score, so that ties fall together.
    A text without any feature of the model is never above the cut.
    """
    cuts = np.unique(np.concatenate([positive, unlabelled, [0.0]]))
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts) / len(x)
    r, u = above(positive), np.maximum(above(unlabelled), prior * above(positive))
    f = (1 + beta**2) * prior * r / (u + beta**2 * prior)
    if len(cuts) == 1:
        return 1.0
    best = 1 + int(np.argmax(f[1:]))
    return float((cuts[best] + cuts[best - 1]) / 2)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_features(t).view(np.int32).tolist() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["_id", "positive", "features"])


def _first_ids(ids: DataFrame, n: int, most: int) -> DataFrame:
    """The ``most`` distinct ids of least hash, of about ``n``; few enough are sorted at any size."""
    order = F.xxhash64("_id")
    return ids.where(hash_share(order, 2.0 * most / max(n, 1))).distinct().orderBy(order, "_id").limit(most)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], float | None]:
    """Features of the positives and of the unlabelled texts, and the toxic share of the labels learnt from.

    At most ``POSITIVES`` and ``UNLABELLED`` texts, one for each doc_id: of rows that share an id
    the one with the least features. So repeated rows change nothing. Both lists are sorted by all
    their features, whatever the order in which tasks end.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).alias("toxic"))
    n, k = known.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0))).first()
    text = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    rest = text.select(F.col("_doc").alias("_id")).where("_id is not null").where(~held_out(F.col("_id")))
    rest = _first_ids(rest, rest.agg(F.approx_count_distinct("_id")).first()[0], UNLABELLED)
    # Two lists of ids, bounded by the parameters, so they may be broadcast.
    chosen = _first_ids(known.where("toxic").select("_id"), k, POSITIVES).withColumn("positive", F.lit(True)).unionByName(rest.withColumn("positive", F.lit(False)))
    rows = text.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "positive", "text")
    got = rows.mapInArrow(_featurize, "_id long, positive boolean, features array<int>").groupBy("_id", "positive").agg(F.min("features").alias("features")).toArrow()
    flags = got.column("positive").to_numpy()
    lists = got.column("features").combine_chunks()
    values, offsets = lists.flatten().to_numpy().view(np.uint32), np.asarray(lists.offsets)
    offsets = offsets - offsets[0]
    each = [values[offsets[i] : offsets[i + 1]] for i in range(len(flags))]
    part = lambda flag: sorted((d for d, f in zip(each, flags, strict=True) if f == flag), key=lambda d: d.tobytes())
    return part(True), part(False), k / n if n else None


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Fit from the training rows; labels of held-out rows are not read.

    The prior is the toxic share of the labels learnt from (``PRIOR`` if there are none).
    Labels with a null id or value are ignored; a document with several labels is toxic if any is.
    """
    positive, unlabelled, share = sample(docs, labels)
    if prior is None:
        prior = PRIOR if share is None else min(0.9, max(0.01, share))
    return fit(positive, unlabelled, prior)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; null texts count as empty.

    Only the text enters a score, so repeated rows and copies score alike. A null doc_id is
    not held out. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, scored with all their columns at hand."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py()) < THRESHOLD for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
