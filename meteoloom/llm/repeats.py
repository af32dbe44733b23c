"""Finding every occurrence of a long window that also occurs earlier in the corpus.

The frame that ``suffix_tree.py`` (windows of words) and ``suffix_array.py`` (windows of bytes)
share. A window of L symbols holds L - k + 1 runs of k symbols; the one with the least hash
(the leftmost on ties) is its seed, which depends on the window's symbols alone. So:

1. Documents are dealt to batches. Each batch sends the distinct hashes of its seeds, four
   bytes each, to hash buckets; a bucket answers which ones another batch sent too.
2. For each seed that repeats, its batch sends out the seed's context: the stretch that the
   windows of this seed cover. Of equal contexts in a batch only the first travels; the windows
   of the later ones repeat it. Everything else is unique and travels no further.
3. Contexts meet by seed. In a group, equal contexts count once, with their earliest place;
   the suffixes at the window starts of the distinct ones are sorted by the operator's own
   construction, which tells the windows that occur at an earlier place too. Those go back to
   their batch as runs.
4. Seeds with more than ``hot`` contexts don't fit a group and are split by the longest prefix
   that matters, the window itself: of equal windows (their bytes are the key) a combined
   aggregation keeps the earliest place, and a join marks the later ones.

Hashes only choose what travels and where it meets; whether windows are equal is decided by
their bytes. Texts travel three times, one shuffle at a time; a batch or group is a few MB,
whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, as_bytes, discard, materialize, mix, sliding

BATCH_BYTES = 4 << 20
BUCKET_SEEDS = 1 << 18
GROUP_WINDOWS = 400_000
HOT = 50_000
_PIECE = 1 << 20
_NO_ID = (1 << 63) - 1
_MASK = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Windows:
    """What counts as a window. ``symbols`` gives hashes, byte starts and byte ends of a text's
    symbols, ``names`` numbers that are equal only for equal symbols; ``later(names, starts, stop,
    place, length)`` tells which windows also occur at a smaller place; ``within``: an earlier
    start in the same document counts too; ``density``: about how many symbols a byte has."""

    name: str
    length: int
    seed: int
    symbols: Callable
    names: Callable
    later: Callable
    within: bool
    density: float


def winnow(hashes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed positions, and the first and last of the windows (of w runs) that each is the least of."""
    if len(hashes) < w:
        none = np.zeros(0, np.int64)
        return none, none, none
    key = (hashes & ~_MASK) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding(key, w, True) & _MASK).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:], len(at)) - 1


def seeds(symbols: np.ndarray, spec: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the seeds of one text, and the first and last window start of each."""
    n = len(symbols) - spec.length + 1
    out = []
    for lo in range(0, max(n, 0), _PIECE):  # a very long text goes piece by piece
        part = symbols[lo : lo + min(_PIECE, n - lo) + spec.length - 1]
        grams = Rolling(part).grams(spec.seed)
        at, first, last = winnow(grams, spec.length - spec.seed + 1)
        # Least hashes crowd at the low end; scrambled again they fill all buckets alike.
        out.append((mix(~grams[at]), first + lo, last + lo))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Batch:
    """The documents of one batch in a fixed order, with their seeds."""

    def __init__(self, table: pa.Table, spec: Windows):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (_NO_ID if ids[i] is None else ids[i], texts[i] or ""))
        self.spec, self.ids = spec, [ids[i] for i in order]
        self.data = [as_bytes(texts[i]) for i in order]
        self.keys = np.array([_NO_ID if i is None else i for i in self.ids], np.int64)
        self.each = []
        for data in self.data:
            symbols, start, end = spec.symbols(data)
            self.each.append((*seeds(symbols, spec), start, end))
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *(e[0] for e in self.each)])
        self.distinct, self.inverse = np.unique(self.hashes, return_inverse=True)

    def local(self) -> np.ndarray:
        """Which distinct seeds repeat inside the batch (in another document, or anywhere)."""
        owner = np.repeat(self.keys, [len(e[0]) for e in self.each])
        order = np.argsort(self.inverse, kind="stable")
        start = np.searchsorted(self.inverse[order], np.arange(len(self.distinct)))
        end = np.append(start[1:], len(order))
        if self.spec.within:
            return end - start > 1
        owner = owner[order]
        return owner[start] != owner[end - 1] if len(start) else np.zeros(0, bool)

    def ranges(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash buckets that the distinct seeds fall in, and where each begins (and the last ends)."""
        own = (self.distinct >> np.uint64(64 - bits)).astype(np.int64)
        first = np.flatnonzero(np.diff(own, prepend=-1))
        return own[first], np.append(first, len(own))


def _sent(spec: Windows, bits: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        batch = Batch(table, spec)
        buckets, at = batch.ranges(bits)
        short = ((batch.distinct >> np.uint64(32 - bits)) & _MASK).astype("<u4")
        return pa.table({
            "batch": pa.array([key[0].as_py()] * len(buckets), pa.int32()),
            "bucket": pa.array(buckets, pa.int32()),
            "seeds": pa.array([short[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    return send


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """Of each batch's seeds in this bucket, a bit for those that another batch has too."""
    each = [np.frombuffer(x.as_py(), "<u4") for x in table.column("seeds")]
    values, counts = np.unique(np.concatenate(each), return_counts=True)
    twice = values[counts > 1]
    batch, bits = [], []
    for b, own in zip(table.column("batch").to_pylist(), each, strict=True):
        if len(twice):
            at = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
            hit = twice[at] == own
            if hit.any():
                batch.append(b)
                bits.append(np.packbits(hit).tobytes())
    bucket = key[0].as_py()
    return pa.table({"batch": pa.array(batch, pa.int32()), "bucket": pa.array([bucket] * len(batch), pa.int32()), "bits": pa.array(bits, pa.binary())})


_CONTEXT = "h long, batch int, doc long, s int, n int, context binary"


def _contexts(spec: Windows, bits: int):
    def cut(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        batch = Batch(docs, spec)
        (buckets, at), repeats = batch.ranges(bits), batch.local()
        for b, own in zip(np.searchsorted(buckets, answers.column("bucket").to_numpy()), answers.column("bits"), strict=True):
            lo, hi = at[b], at[b + 1]
            repeats[lo:hi] |= np.unpackbits(np.frombuffer(own.as_py(), np.uint8), count=hi - lo).view(bool)
        chosen, done = repeats[batch.inverse], 0
        seen: dict = {}
        rows: list[tuple] = []
        for doc, data, (h, first, last, start, end) in zip(batch.keys.tolist(), batch.data, batch.each, strict=True):
            pick = np.flatnonzero(chosen[done : done + len(h)])
            done += len(h)
            raw, open_ = data.tobytes(), None
            a, b = start[first[pick]].tolist(), end[last[pick] + spec.length - 1].tolist()
            for seed, s, e, i, j in zip(h[pick].view(np.int64).tolist(), first[pick].tolist(), last[pick].tolist(), a, b, strict=True):
                context = raw[i:j]
                place = (doc, s) if spec.within else doc
                # Only the batch's first of equal contexts travels; a later one is settled here.
                if place <= seen.get(context, place):
                    seen[context] = place
                    rows.append((seed, doc, s, e - s + 1, context))
                elif open_ and open_[1] + 1 == s:
                    open_[1] = e
                else:
                    if open_:
                        rows.append((None, doc, open_[0], open_[1] - open_[0] + 1, None))
                    open_ = [s, e]
            if open_:
                rows.append((None, doc, open_[0], open_[1] - open_[0] + 1, None))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table({
            "h": pa.array(cols[0], pa.int64()), "batch": pa.array([key[0].as_py()] * len(rows), pa.int32()), "doc": pa.array(cols[1], pa.int64()),
            "s": pa.array(cols[2], pa.int32()), "n": pa.array(cols[3], pa.int32()), "context": pa.array(cols[4], pa.binary()),
        })

    return cut


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


_RUN = "batch int, doc long, first int, last int"


def _runs(batch: np.ndarray, doc: np.ndarray, at: np.ndarray, row: np.ndarray) -> pa.Table:
    """Window starts ``at`` (ascending inside each ``row``) as runs of neighbours."""
    if not len(at):
        new = end = np.zeros(0, np.int64)
    else:
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])]))
        end = np.append(new[1:], len(at)) - 1
    return pa.table({"batch": pa.array(batch[row[new]].astype(np.int32)), "doc": pa.array(doc[row[new]]), "first": pa.array(at[new].astype(np.int32)), "last": pa.array(at[end].astype(np.int32))})


def _joined(contexts: list[bytes], spec: Windows) -> np.ndarray:
    """The bytes of contexts, end to end; a space keeps words apart."""
    return np.frombuffer((b" " if spec.density < 1 else b"").join(contexts), np.uint8)


def _later(spec: Windows):
    """Windows of a group's contexts that are not the first of their class."""

    def mark(table: pa.Table) -> pa.Table:
        doc = table.column("doc").to_numpy()
        batch, s, n = (table.column(c).to_numpy().astype(np.int64) for c in ("batch", "s", "n"))
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(c, len(seen)) for c in table.column("context").to_pylist()], np.int64)
        # Places in order: the document's rank, then the start if it counts.
        place = np.unique(doc, return_inverse=True)[1].astype(np.int64) << 32
        if spec.within:
            place |= s
        count = np.zeros(len(seen), np.int64)
        count[which] = n
        earliest = np.full(len(seen), np.iinfo(np.int64).max)
        np.minimum.at(earliest, which, place)
        size = count + spec.length - 1
        offset = np.cumsum(size) - size
        step = _ramp(count)
        starts, stop = np.repeat(offset, count) + step, np.repeat(offset + size, count)
        own = np.repeat(earliest, count) + (step if spec.within else 0)
        again = spec.later(spec.names(_joined(list(seen), spec)), starts, stop, own, spec.length)
        # Back to all occurrences: all windows of a context that isn't the earliest of its kind.
        row, step = np.repeat(np.arange(len(n)), n), _ramp(n)
        base = np.cumsum(count) - count
        late = (place > earliest[which])[row] | again[base[which[row]] + step]
        return _runs(batch, doc, (s[row] + step)[late], row[late])

    return mark


def _window_rows(spec: Windows):
    """Contexts -> one row for each window: its bytes (words one space apart) and its place."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(2).to_numpy()
            own, s, n = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 3, 4))
            windows = []
            for context, k in zip(batch.column(5).to_pylist(), n.tolist(), strict=True):
                if spec.density < 1:
                    words = context.split()
                    windows += [b" ".join(words[i : i + spec.length]) for i in range(k)]
                else:
                    windows += [context[i : i + spec.length] for i in range(k)]
            row = np.repeat(np.arange(len(n)), n)
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(own[row].astype(np.int32)), pa.array(doc[row]), pa.array((s[row] + _ramp(n)).astype(np.int32))], ["w", "batch", "doc", "s"])

    return explode


def _hot_runs(contexts: DataFrame, spec: Windows) -> tuple[DataFrame, DataFrame]:
    """Later windows of hot seeds as runs of one, and the table that they are read from."""
    rows = contexts.mapInArrow(_window_rows(spec), "w binary, batch int, doc long, s int")
    place = F.struct("doc", F.col("s") if spec.within else F.lit(0).alias("s"))
    first = materialize(rows.groupBy("w").agg(F.min(place).alias("least")).select(F.col("w").alias("v"), "least"), f"{spec.name}-first")
    late = rows.join(first, F.col("w") == F.col("v")).where(F.col("least") < place)
    return late.select("batch", "doc", F.col("s").alias("first"), F.col("s").alias("last")), first


def _covered(n: int, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + length, -1)
    return np.cumsum(edge[:n]) > 0


def batched(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, batch, and the bytes of all texts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = total // BATCH_BYTES + 1
    return docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")), total


def repeated_runs(docs: DataFrame, total: int, spec: Windows, hot: int = HOT) -> DataFrame:
    """Runs (batch, doc, first, last) of window starts whose window also occurs earlier."""
    bits = min(30, max(4, int(total * spec.density * 2 / (spec.length - spec.seed + 2) / BUCKET_SEEDS).bit_length()))
    sent = materialize(docs.groupBy("batch").applyInArrow(_sent(spec, bits), "batch int, bucket int, seeds binary"), f"{spec.name}-seeds")
    answers = materialize(sent.groupBy("bucket").applyInArrow(_answer, "batch int, bucket int, bits binary"), f"{spec.name}-answers")
    discard(sent)
    contexts = docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_contexts(spec, bits), _CONTEXT)
    contexts = materialize(contexts, f"{spec.name}-contexts")
    discard(answers)
    settled = contexts.where("context is null").select("batch", "doc", F.col("s").alias("first"), (F.col("s") + F.col("n") - 1).alias("last"))
    travelling = contexts.where("context is not null")
    counts = travelling.groupBy("h").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    many = materialize(counts.where(F.col("k") > hot).select(F.col("h").alias("hot_h")), f"{spec.name}-hot")
    cold = travelling
    if not many.isEmpty():
        cold = travelling.join(many, travelling["h"] == many["hot_h"], "left_anti")
    groups = (cold.agg(F.sum("n")).first()[0] or 0) // GROUP_WINDOWS + 1
    runs = cold.withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups))).groupBy("g").applyInArrow(_later(spec), _RUN)
    spent = [contexts, many]
    if not many.isEmpty():
        late, first = _hot_runs(travelling.join(many, travelling["h"] == many["hot_h"], "left_semi"), spec)
        runs = runs.unionByName(late)
        spent.append(first)
    runs = materialize(runs.unionByName(settled), f"{spec.name}-runs")
    discard(*spent)
    return runs


def without_repeats(docs: DataFrame, spec: Windows, finish: Callable, schema: str, hot: int = HOT) -> DataFrame:
    """``finish(doc_id, data, start, end, covered)`` for every row of ``docs``, as rows of ``schema``.

    Null texts count as empty; texts shorter than a window lose nothing. Rows that repeat a
    doc_id are one document at one place, so they don't make each other later. A null doc_id
    comes after all others. Other columns are ignored; an empty table gives no rows.
    """
    dealt, total = batched(docs)
    runs = repeated_runs(dealt, total, spec, hot)
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(key: tuple, own: pa.Table, found: pa.Table) -> pa.Table:
        doc, first, last = (found.column(c).to_numpy() for c in ("doc", "first", "last"))
        order = np.argsort(doc, kind="stable")
        doc, first, last = doc[order], first[order].astype(np.int64), last[order].astype(np.int64)
        rows = []
        for i, text in zip(own.column("doc_id").to_pylist(), own.column("text"), strict=True):
            data = as_bytes(text.as_py())
            _, start, end = spec.symbols(data)
            k = _NO_ID if i is None else i
            lo, hi = np.searchsorted(doc, k), np.searchsorted(doc, k, "right")
            rows.append(finish(i, data, start, end, _covered(len(start), first[lo:hi], last[lo:hi], spec.length)))
        return pa.table({n: pa.array([r[j] for r in rows], pa.string() if n.endswith(("sha256", "text")) else pa.int64()) for j, n in enumerate(names)})

    return dealt.groupBy("batch").cogroup(runs.groupBy("batch")).applyInArrow(cut, schema)


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
