"""Document scores by masked pseudo-likelihood under a bidirectional window network.

Each token is predicted from two words to its left and two to its right: their embeddings go
through one hidden layer to a softmax over word classes, and a class gives its words by their
corpus frequency, so log P(word | window) = log P(class | window) + log P(word | class). The
token itself is never among its inputs. A document's score is the sum over all its tokens.

Every distinct word of the corpus is counted, by its 64-bit hash, in a table that grows with the
corpus. The ``LISTED`` most frequent words are broadcast; a text becomes the list of its words'
ranks. The ``OWN`` most frequent words are classes of their own. Other listed words are put
into classes by the words beside them: each class is a distribution over which of the
``FEATURES`` most frequent words stand to the left and right, fitted by hard expectation
maximisation over all of them (started on the most frequent ``FIRST``). The last class holds
the unlisted words and those never seen beside a frequent one; unlisted words get their counts
by a join with the table.

Documents are dealt to blocks of about ``BLOCK`` tokens by a hash of doc_id and text, so that
blocks don't depend on files, tasks or executors. Training covers every token of the corpus
once. It goes in waves, the first ``FIRST_WAVE`` blocks, then as many again, then twice as many
and so on: the blocks of a wave train side by side from the same state (parameters and their
Adagrad sums), and the token-weighted mean of what they reach is the state of the next wave.
So the sequence of steps grows with the logarithm of the corpus, and no token is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, discard, materialize, word_hashes, words_of

LISTED = 1 << 20
OWN = 64
CLASSES = 128
#: Classes found from contexts; the last class holds the words that have none.
FOUND = CLASSES - OWN - 1
FEATURES = 64
FIRST = 8192
INPUTS = 4096
DIM = 16
HIDDEN = 32
WINDOW = (-2, -1, 1, 2)
REACH = 2
BLOCK = 1 << 18
FIRST_WAVE = 8
BATCH = 2048
_SCORED = 1024
_COUNTED = 1 << 22
_PIECE = 2048
_SHAPES = ((INPUTS, DIM), (len(WINDOW) * DIM, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))
_SIZE = sum(int(np.prod(s)) for s in _SHAPES)


def tokens(text: str | None) -> np.ndarray:
    """The words' hashes."""
    return word_hashes(as_bytes(text))[0].view(np.int64)


# ------------------------------------------------------------------ the network


def _split(flat: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _SHAPES:
        n = int(np.prod(shape))
        out.append(flat[at : at + n].reshape(shape))
        at += n
    return out


def start(prior: np.ndarray | None = None, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Parameters and Adagrad sums before training; ``prior``: log shares of the classes."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(_SIZE, np.float32)
    e, w1, _, w2, b2 = _split(flat)
    for part, scale in ((e, 0.3), (w1, (len(WINDOW) * DIM) ** -0.5), (w2, HIDDEN**-0.5)):
        part[:] = rng.normal(0, scale, part.shape)
    if prior is not None:
        b2[:] = prior
    return flat, np.full(_SIZE, 1e-3, np.float32)


class Vocabulary:
    """Class, input row and log P(word | class) of the listed words, from counts and classes.

    ``counts`` is in descending order. Entry len(counts) stands for any unlisted word: its class
    is the last one, and log(count + 0.5) has to be added to its ``base``. ``mass`` is the sum of
    count + 0.5 over all words of each class.
    """

    def __init__(self, counts: np.ndarray, cls: np.ndarray, mass: np.ndarray):
        rank, mass, by_class = np.arange(len(counts)), np.maximum(mass, 0.5), INPUTS - CLASSES
        self.prior = np.log(mass / mass.sum()).astype(np.float32)
        self.target = np.append(cls, CLASSES - 1).astype(np.int64)
        self.base = np.append(np.log(counts + 0.5), 0.0) - np.log(mass)[self.target]
        # Row 0 stands for a place outside the document, the last rows for classes.
        self.row = np.append(np.where(rank < by_class - 1, rank + 1, by_class + cls), INPUTS - 1).astype(np.int64)


class Places:
    """The tokens of several documents end to end, with gaps so that windows see no neighbour document."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, vocab: Vocabulary):
        self.at = np.arange(len(ids)) + REACH * (np.repeat(np.arange(len(sizes)), sizes) + 1)
        self.rows = np.zeros(len(ids) + REACH * (len(sizes) + 1), np.int64)
        self.rows[self.at] = vocab.row[ids]

    def windows(self, which) -> np.ndarray:
        """Input rows around the tokens ``which`` (n x 4)."""
        return self.rows[self.at[which][:, None] + np.array(WINDOW)]


def _forward(parts: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and class scores, the latter small enough to take their exponentials."""
    e, w1, b1, w2, b2 = parts
    inp = e.take(x.ravel(), axis=0).reshape(len(x), -1)
    hid = inp @ w1
    hid += b1
    np.tanh(hid, out=hid)
    z = hid @ w2
    z += b2
    if np.abs(w2).sum(axis=0).max() + np.abs(b2).max() > 60:
        z -= z.max(axis=1, keepdims=True)
    return inp, hid, z


def train_block(state: tuple[np.ndarray, np.ndarray], places: Places, target: np.ndarray, seed: int, rate: float = 0.08) -> tuple[np.ndarray, np.ndarray]:
    """Adagrad over mini-batches of all tokens in a seeded order; returns the new state.

    A block far smaller than ``BLOCK`` (a small corpus) is gone through up to eight times.
    """
    flat, seen = state[0].copy(), state[1].copy()
    parts, seen_e, first = _split(flat), _split(seen)[0], INPUTS * DIM
    e, w1, _, w2, _ = parts
    grad = np.zeros_like(flat)
    _, g1, gb1, g2, gb2 = _split(grad)
    grad, dense, dense_seen = grad[first:], flat[first:], seen[first:]
    step, rng, ones, rate = np.empty_like(grad), np.random.default_rng(seed), np.ones(max(BATCH, CLASSES), np.float32), np.float32(rate)
    for _ in range(max(1, min(8, BLOCK // max(1, len(target))))):
        order = rng.permutation(len(target))
        rows, wanted = places.windows(order), target[order]
        for lo in range(0, len(order), BATCH):
            x, y = rows[lo : lo + BATCH], wanted[lo : lo + BATCH]
            n = len(y)
            inp, hid, d = _forward(parts, x)
            np.exp(d, out=d)
            d *= (1 / (n * (d @ ones[:CLASSES])))[:, None]
            d[np.arange(n), y] -= np.float32(1 / n)
            np.matmul(hid.T, d, out=g2)
            np.matmul(ones[:n], d, out=gb2)
            dh = d @ w2.T
            hid *= hid
            np.subtract(1, hid, out=hid)
            dh *= hid
            np.matmul(inp.T, dh, out=g1)
            np.matmul(ones[:n], dh, out=gb1)
            di = (dh @ w1.T).reshape(-1, DIM)
            # Embeddings: only the rows in use have a gradient.
            row = x.ravel()
            by = np.argsort(row.astype(np.uint16), kind="stable")
            row = row[by]
            border = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            row, ge = row[border], np.add.reduceat(di.take(by, axis=0), border, axis=0)
            sums = seen_e[row] + ge * ge
            seen_e[row] = sums
            e[row] -= rate * ge / np.sqrt(sums)
            np.multiply(grad, grad, out=step)
            dense_seen += step
            np.sqrt(dense_seen, out=step)
            np.divide(grad, step, out=step)
            step *= rate
            dense -= step
    return flat, seen


def log_likelihood(flat: np.ndarray, vocab: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log P of each token given the tokens around it, but for log(count + 0.5) of unlisted words."""
    parts, places, target, out = _split(flat), Places(ids, sizes, vocab), vocab.target[ids], np.empty(len(ids), np.float64)
    ones = np.ones(CLASSES, np.float32)
    for lo in range(0, len(ids), _SCORED):
        own = slice(lo, lo + _SCORED)
        _, _, z = _forward(parts, places.windows(own))
        out[own] = z[np.arange(len(z)), target[own]]
        np.exp(z, out=z)
        out[own] -= np.log(z @ ones)
    return out + vocab.base[ids]


# ------------------------------------------------------------------ words


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


class _Lookup:
    """Positions of hashes in a list of distinct ones (its length: not in it)."""

    def __init__(self, hashes: np.ndarray):
        self.at, self.n = np.argsort(hashes), len(hashes)
        self.keys = hashes[self.at]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(h), np.int64)
        lo = np.minimum(np.searchsorted(self.keys, h), self.n - 1)
        return np.where(self.keys[lo] == h, self.at[lo], self.n)


def word_counts(docs: DataFrame) -> DataFrame:
    """h, n: how often each word occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return _table(h=h, n=n.astype(np.int64))

        for batch in batches:
            for h, _ in words_of(batch.column(0)):
                held.append(h.view(np.int64))
                size += len(h)
                if size >= _COUNTED:
                    yield done()
                    held, size = [], 0
        if size:
            yield done()

    return docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _listed(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and counts of the most frequent words, in that order, and their least count.

    All words of a count are listed or none, so that there are at most ``most``.
    """
    hist = words.groupBy("n").count().toArrow()
    n, k = hist.column(0).to_numpy(), hist.column(1).to_numpy()
    order = np.argsort(-n)
    fit = np.cumsum(k[order]) <= most
    least = int(n[order][fit].min()) if fit.any() else int(n.max(initial=0)) + 1
    got = words.where(F.col("n") >= least).toArrow()
    h, n = got.column("h").to_numpy(), got.column("n").to_numpy()
    order = np.lexsort((h, -n))
    return h[order], n[order], least


# ------------------------------------------------------------------ blocks of coded documents

_BLOCK = "block int, wave int, doc_ids array<long>, sizes array<int>, ids binary, rare_at array<int>, rare_h array<long>"


def wave_of(block: int) -> int:
    return 0 if block < FIRST_WAVE else int(np.log2(block // FIRST_WAVE)) + 1


def encode(docs: DataFrame, listed: np.ndarray, blocks: int) -> DataFrame:
    """Rows of whole blocks: the doc_ids and sizes of its documents, the ranks of all their words
    (32-bit; len(listed) for an unlisted one), and hash and document of each unlisted word."""
    shared = docs.sparkSession.sparkContext.broadcast(listed)
    key = F.xxhash64("doc_id", "text")
    docs = docs.select(F.pmod(key, F.lit(blocks)).cast("int").alias("block"), key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Lookup(shared.value)
        for batch in batches:
            lo = 0
            for h, sizes in words_of(batch.column(3)):
                part, lo = batch.slice(lo, len(sizes)), lo + len(sizes)
                h = h.view(np.int64)
                at, end = look(h).astype(np.int32), np.cumsum(sizes)
                ids = [at[j - n : j].tobytes() for n, j in zip(sizes.tolist(), end.tolist(), strict=True)]
                rare = np.flatnonzero(at == look.n)
                cut = np.searchsorted(rare, np.concatenate([[0], end]))
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(h[rare]))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(ids, pa.binary()), lists], ["block", "key", "doc_id", "ids", "rare"])

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("key").combine_chunks()
        ids = table.column("ids").to_pylist()
        rare = table.column("rare").chunk(0)
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "wave": pa.array([wave_of(key[0].as_py())], pa.int32()),
            "doc_ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())), "sizes": pa.array([[len(x) // 4 for x in ids]], pa.list_(pa.int32())), "ids": pa.array([b"".join(ids)], pa.binary()),
            "rare_at": pa.array([np.repeat(np.arange(len(ids), dtype=np.int32), rare.value_lengths().to_numpy())], pa.list_(pa.int32())), "rare_h": pa.array([rare.flatten().to_numpy()], pa.list_(pa.int64())),
        })

    coded = docs.mapInArrow(code, "block int, key long, doc_id long, ids binary, rare array<long>")
    return coded.groupBy("block").applyInArrow(gather, _BLOCK)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch, int]]:
    """Block, sizes and word ranks of each row (block, sizes, ids, ...), with its batch and place."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), batch.column(1)[i].values.to_numpy().astype(np.int64), np.frombuffer(batch.column(2)[i].as_buffer(), np.int32).astype(np.int64), batch, i


# ------------------------------------------------------------------ classes from contexts


def contexts(coded: DataFrame, n_listed: int) -> DataFrame:
    """w, c: how often each listed word has each of the most frequent ``FEATURES`` to its left or right."""
    width, features = 2 * FEATURES, min(FEATURES, n_listed)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return _table(w=(key // width).astype(np.int32), f=(key % width).astype(np.int32), n=n.astype(np.int64))

        for _, sizes, ids, *_ in _read(batches):
            ends = np.cumsum(sizes[sizes > 0])
            left, right = np.roll(ids, 1), np.roll(ids, -1)
            left[np.concatenate([[0], ends[:-1]])[: len(ends)]] = n_listed
            right[ends - 1] = n_listed
            inner = (ids >= OWN) & (ids < n_listed)
            a, b = inner & (left < features), inner & (right < features)
            held += [ids[a] * width + left[a], ids[b] * width + FEATURES + right[b]]
            size += len(held[-1]) + len(held[-2])
            if size >= _COUNTED:
                yield done()
                held, size = [], 0
        if size:
            yield done()

    rows = coded.select("block", "sizes", "ids").mapInArrow(pairs, "w int, f int, n long").repartition("w")
    return rows.groupBy("w", "f").agg(F.sum("n").alias("n")).groupBy("w").agg(F.collect_list(F.struct("f", "n")).alias("c"))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Lengths of the lists and the fields of all their structs."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return size, *(x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten())


def _closest(theta: np.ndarray, size: np.ndarray, f: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each word the class (of FOUND) that gives its contexts the highest likelihood."""
    if not len(size):
        return np.zeros(0, np.int64)
    return np.add.reduceat(np.log(theta).T[f] * n[:, None], np.cumsum(size) - size, axis=0).argmax(axis=1)


def _shares(sums: np.ndarray) -> np.ndarray:
    return ((sums + 0.1) / (sums + 0.1).sum(axis=1, keepdims=True)).astype(np.float32)


def _sums(cls: np.ndarray, size: np.ndarray, f: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Context counts of each class."""
    key = np.repeat(cls, size) * 2 * FEATURES + f
    return np.bincount(key, n, minlength=FOUND * 2 * FEATURES).reshape(FOUND, -1)


def find_classes(coded: DataFrame, n_listed: int) -> np.ndarray:
    """The class of each listed word."""
    cls = np.where(np.arange(n_listed) < OWN, np.arange(n_listed), CLASSES - 1)
    seen = materialize(contexts(coded, n_listed), "lm-contexts")
    first = seen.where(F.col("w") < FIRST + OWN).orderBy("w").toArrow().combine_chunks()
    if not first.num_rows:
        discard(seen)
        return cls
    size, f, n = _flat(first.column("c").chunk(0))
    found = np.arange(len(size)) % FOUND
    for _ in range(20):
        theta = _shares(_sums(found, size, f, n))
        found = _closest(theta, size, f, n)
    width = 2 * FEATURES
    for _ in range(2):  # now over all words

        def gather(batches: Iterator[pa.RecordBatch], theta=theta) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((FOUND, width))
            for batch in batches:
                size, f, n = _flat(batch.column(0))
                sums += _sums(_closest(theta, size, f, n), size, f, n)
            at = np.flatnonzero(sums)
            yield _table(at=at.astype(np.int32), s=sums.ravel()[at].astype(np.int64))

        got = seen.select("c").mapInArrow(gather, "at int, s long").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
        sums = np.zeros(FOUND * width)
        sums[got.column(0).to_numpy()] = got.column(1).to_numpy()
        theta = _shares(sums.reshape(FOUND, width))

    def assign(batches: Iterator[pa.RecordBatch], theta=theta) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table(w=batch.column(0), c=(OWN + _closest(theta, *_flat(batch.column(1)))).astype(np.int32))

    got = seen.select("w", "c").mapInArrow(assign, "w int, c int").toArrow()
    cls[got.column("w").to_numpy()] = got.column("c").to_numpy()
    discard(seen)
    return cls


# ------------------------------------------------------------------ training and scores


class Model:
    """Listed words (hash, count, class), class masses, the table of the other words and the network."""

    def __init__(self, listed: np.ndarray, counts: np.ndarray, cls: np.ndarray, rest: DataFrame):
        self.listed, self.counts, self.cls, self.rest = listed, counts.astype(np.float64), cls, rest
        self.mass = np.bincount(cls, self.counts + 0.5, minlength=CLASSES)
        self.mass[CLASSES - 1] += float(rest.agg(F.sum(F.col("n") + F.lit(0.5))).first()[0] or 0)
        self.state = start(self.vocabulary().prior)

    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.counts, self.cls, self.mass)


def _wave(coded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The state after the blocks of one wave: the token-weighted mean of theirs."""
    shared = coded.sparkSession.sparkContext.broadcast((model.state, model.counts, model.cls, model.mass))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, *words = shared.value
        vocab, total, sums = Vocabulary(*words), 0, np.zeros(2 * _SIZE, np.int64)
        for block, sizes, ids, *_ in _read(batches):
            if len(ids):
                new = train_block(state, Places(ids, sizes, vocab), vocab.target[ids], block)
                # Whole numbers, so that the order in which blocks are added doesn't matter.
                sums += np.round(np.concatenate(new).astype(np.float64) * 1e6).astype(np.int64) * len(ids)
                total += len(ids)
        if total:
            pieces = [pa.array(sums[lo : lo + _PIECE]) for lo in range(0, len(sums), _PIECE)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, pieces)]).astype(np.int32)), pa.concat_arrays(pieces))
            yield _table(piece=np.arange(len(pieces), dtype=np.int32), n=np.full(len(pieces), total, np.int64), s=lists)

    rows = coded.select("block", "sizes", "ids").mapInArrow(learn, "piece int, n long, s array<long>")
    each = rows.select("piece", "n", F.posexplode("s").alias("at", "s")).groupBy("piece", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    got = each.select((F.col("piece") * _PIECE + F.col("at")).alias("at"), (F.col("s").cast("double") / F.col("n") / 1e6).alias("m")).toArrow()
    both = np.concatenate(model.state)
    both[got.column(0).to_numpy()] = got.column(1).to_numpy()
    shared.unpersist()
    return both[:_SIZE], both[_SIZE:]


def train(docs: DataFrame) -> Model:
    """The model learnt from all of ``docs``."""
    return _train(docs)[0]


def _train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and ``docs`` as coded for it."""
    words = materialize(word_counts(docs), "lm-words")
    listed, counts, least = _listed(words, LISTED)
    blocks = int((words.agg(F.sum("n")).first()[0] or 0) // BLOCK + 1)
    coded = materialize(encode(docs, listed, blocks), "lm-coded", by="wave")
    model = Model(listed, counts, find_classes(coded, len(listed)), words.where(F.col("n") < least))
    for wave in range(wave_of(blocks - 1) + 1):
        model.state = _wave(coded.where(F.col("wave") == wave), model)
    return model, coded


def lm_scores(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum) and mean_log_likelihood for every row of ``docs``.

    A text without a word (null and empty ones too) has sum 0 and a null mean. Repeated rows
    score alike, however the table is partitioned; other columns are ignored. The model is
    learnt from ``docs`` if none is given.
    """
    if model is None:
        model, coded = _train(docs)
    else:
        n = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        coded = materialize(encode(docs, model.listed, int(n // (6 * BLOCK) + 1)), "lm-coded")
    shared = docs.sparkSession.sparkContext.broadcast((model.state[0], model.counts, model.cls, model.mass))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, *words = shared.value
        vocab = Vocabulary(*words)
        for block, sizes, ids, batch, i in _read(batches):
            sums = np.concatenate([[0.0], np.cumsum(log_likelihood(flat, vocab, ids, sizes))])
            end = np.cumsum(sizes)
            yield _table(block=np.full(len(sizes), block, np.int32), at=np.arange(len(sizes), dtype=np.int32), doc_id=batch.column(3)[i].values, n=sizes, s=sums[end] - sums[end - sizes])

    def unlisted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, h = batch.column(1)[i].values, batch.column(2)[i].values
                yield _table(b=np.full(len(h), batch.column(0)[i].as_py(), np.int32), i=at, h=h)

    scored = coded.select("block", "sizes", "ids", "doc_ids").mapInArrow(score, "block int, at int, doc_id long, n long, s double")
    rare = coded.select("block", "rare_at", "rare_h").mapInArrow(unlisted, "b int, i int, h long").join(model.rest, "h", "left")
    # Whole millionths again: the same sum in any order.
    logs = F.round(F.ln(F.coalesce("n", F.lit(0)) + F.lit(0.5)) * 1e6).cast("long")
    rare = rare.groupBy("b", "i").agg(F.sum(logs).alias("r"))
    out = scored.join(rare, (F.col("block") == F.col("b")) & (F.col("at") == F.col("i")), "left")
    total = F.col("s") + F.coalesce(F.col("r") / 1e6, F.lit(0.0))
    return out.select("doc_id", F.col("n").alias("n_tokens"), total.alias("log_likelihood"), F.when(F.col("n") > 0, total / F.col("n")).alias("mean_log_likelihood"))
