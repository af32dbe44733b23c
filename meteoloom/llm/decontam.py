"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared seeds (runs of ``SEED`` words, or the whole
of a shorter item). Every word of a tile lies in a shared seed, so a pair is tiled if the words
under the seeds that it shares can reach the coverage; no pair that reaches it is left out.
Tiling marks the longest common runs of unmarked words first, found by running Karp-Rabin hashes
of ``TILE`` words. The share of the item's words under tiles is the coverage.
Tiles may come in any order, so a passage whose sentences were moved about is still covered.

A benchmark of up to ``BROADCAST_WORDS`` words is broadcast, and each text is looked through
where it lies. A larger one meets the documents by shuffles on the seeds: each item keeps only
its rarest seeds, so many that the others alone can't reach the coverage, which no common phrase
can make frequent unless it is most of the item.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, as_bytes, materialize, word_hashes

SEED = 4
TILE = 5
COVERAGE = 0.5
#: Words of the benchmark that may be broadcast (about 40 bytes each); beyond, the join shuffles.
BROADCAST_WORDS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased."""
    return word_hashes(_LOWER[as_bytes(text)])[0]


#: Pairs of equal runs that are looked at together.
_AT_ONCE = 1 << 20


def _common_runs(item: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All longest runs that both hold, of ``least`` words or more: start in item, start in doc, length.

    Starts are equal Karp-Rabin hashes of ``least`` words; how far a run goes on is found by
    hashes of whole runs, whose length is halved step by step.
    """
    roll_i, roll_d = Rolling(item), Rolling(doc)
    hi, hd = roll_i.grams(least), roll_d.grams(least)
    order = np.argsort(hi, kind="stable")
    lo, hi_end = np.searchsorted(hi[order], hd), np.searchsorted(hi[order], hd, "right")
    many = hi_end - lo
    own = np.flatnonzero(many)
    found = []
    for part in np.split(own, np.flatnonzero(np.diff(np.cumsum(many[own]) // _AT_ONCE)) + 1) if len(own) else []:
        j = np.repeat(part, many[part])
        i = order[np.repeat(lo[part], many[part]) + np.arange(len(j)) - np.repeat(np.cumsum(many[part]) - many[part], many[part])]
        new = (i == 0) | (j == 0) | (item[i - 1] != doc[j - 1])  # the start of its run
        i, j = i[new], j[new]
        n, most = np.full(len(i), least), np.minimum(len(item) - i, len(doc) - j)
        step = 1 << (int(most.max(initial=0)) - 1).bit_length() if len(i) else 0
        while step:
            more = np.flatnonzero(n + step <= most)
            a, b = i[more] + n[more], j[more] + n[more]
            same = roll_i.slices(a, a + step) == roll_d.slices(b, b + step)
            n[more[same]] += step
            step >>= 1
        found.append((i, j, n))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (own, own, own)


def tile(item: np.ndarray, doc: np.ndarray, least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in doc, length), longest first, none shorter than ``least``.

    Of equally long ones the first in the item goes first, then the first in the document. What a tile leaves of the
    runs that it overlaps waits in the same queue by its own length. An item shorter than ``least``
    needs one tile of its own length.
    """
    least = max(1, min(least, len(item)))
    i, j, n = _common_runs(item, doc, least)
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    queue = sorted(zip((-n).tolist(), i.tolist(), j.tolist(), strict=True))  # a sorted list is a heap
    out: list[tuple[int, int, int]] = []
    left = len(item)
    while queue and left >= least:
        n, i, j = heapq.heappop(queue)
        free = free_i[i : i - n] & free_d[j : j - n]
        if free.all():
            out.append((i, j, -n))
            free_i[i : i - n] = free_d[j : j - n] = False
            left += n
        elif free.any():
            edge = np.flatnonzero(np.diff(free, prepend=False, append=False))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if b - a >= least:
                    heapq.heappush(queue, (a - b, i + a, j + a))
    return out


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; runs of other lengths hash apart."""
    return Rolling(words).grams(k) ^ np.uint64(k)


def _coverable(item: np.ndarray, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items, and how many words of each lie in the seeds of ``k`` words that start at ``at``.

    Every word of a tile of k words or more lies in such a seed, so tiles can't cover more.
    """
    order = np.lexsort((at, item))
    item, at = item[order], at[order]
    step = k[order].astype(np.int64)
    same = item[1:] == item[:-1]
    step[:-1][same] = np.minimum(step[:-1], at[1:] - at[:-1])[same]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    return item[first], np.add.reduceat(step, first)


def _item_words(items: DataFrame) -> DataFrame:
    """item_id, words (64-bit hashes, binary), n: the items that hold a word, each id once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [token_hashes(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.tobytes() for w in own], pa.binary()), pa.array([len(w) for w in own], pa.int64())], ["item_id", "words", "n"])

    own = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    once = own.groupBy("item_id").agg(F.min("text").alias("text"))
    return once.mapInArrow(read, "item_id long, words binary, n long").where("n > 0")


class Benchmark:
    """Items with their seeds, sorted by hash."""

    def __init__(self, ids: list[int], words: list[np.ndarray], coverage: float, least: int):
        self.ids, self.words, self.coverage, self.least = ids, words, coverage, least
        longest = max(1, min(SEED, least))
        size = np.array([len(w) for w in words], np.int64)
        seed = np.minimum(size, longest)
        each = [_grams(w, int(k)) for w, k in zip(words, seed, strict=True)]
        n = np.array([len(h) for h in each], np.int64)
        h = np.concatenate([np.zeros(0, np.uint64), *each])
        order = np.argsort(h, kind="stable")
        item = np.repeat(np.arange(len(ids)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.keys, self.item, self.at = h[order], item[order], at[order]
        self.size, self.seed, self.lengths = size, seed, np.unique(seed).tolist()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Item, its words, covered words and tiles, for each item whose coverage the text reaches."""
        own = token_hashes(text)
        if not len(own) or not len(self.keys):
            return []
        grams = np.concatenate([_grams(own, k) for k in self.lengths])
        lo = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        hit = np.unique(grams[self.keys[lo] == grams])
        if not len(hit):
            return []
        lo, hi = np.searchsorted(self.keys, hit), np.searchsorted(self.keys, hit, "right")
        ix = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
        who, words = _coverable(self.item[ix], self.at[ix], self.seed[self.item[ix]])
        who = who[words >= self.coverage * self.size[who]]
        return [r for i in who.tolist() if (r := covering(self.ids[i], self.words[i], own, self.coverage, self.least))]


def covering(item_id: int, item: np.ndarray, doc: np.ndarray, coverage: float, least: int) -> tuple[int, int, int, int] | None:
    tiles = tile(item, doc, least)
    covered = sum(t[2] for t in tiles)
    return (item_id, len(item), covered, len(tiles)) if covered >= coverage * len(item) else None


def _benchmark(items: DataFrame, coverage: float, least: int, most: int) -> Benchmark | None:
    """The items for the driver to broadcast; None if they have more than ``most`` words."""
    words = _item_words(items)
    if (words.agg(F.sum("n")).first()[0] or 0) > most:
        return None
    got = words.toArrow()
    order = np.argsort(got.column("item_id").to_numpy())
    ids, data = got.column("item_id").to_pylist(), got.column("words").to_pylist()
    return Benchmark([ids[i] for i in order], [np.frombuffer(data[i], np.uint64) for i in order], coverage, least)


_PAIRS = "doc_id long, item_id long, item_words int, covered int, coverage double, tiles int"


def _pair_rows(ids: list, found: list[list[tuple[int, int, int, int]]]) -> pa.RecordBatch:
    rows = [(d, i, n, c, c / n, t) for d, own in zip(ids, found, strict=True) for i, n, c, t in own]
    cols = list(zip(*rows, strict=True)) or [()] * 6
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in _PAIRS.split(", ")])


def contaminated_pairs(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = TILE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, item_id, item_words, covered, coverage, tiles: the pairs that reach ``coverage``.

    Null texts count as empty. Every row of ``docs`` is reported on its own, repeated ones and
    those without a doc_id too (their doc_id is null). Items without an id or without a word are
    not looked for; of items that share an id the one with the smallest text is. Other columns
    are ignored.
    """
    known = _benchmark(items, coverage, least, broadcast_words)
    if known is None:
        return _pairs_shuffled(docs, items, coverage, least).select(*[x.split()[0] for x in _PAIRS.split(", ")])
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pair_rows(batch.column(0).to_pylist(), [shared.value.find(text.as_py()) for text in batch.column(1)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, _PAIRS)


def _rare_seeds(seeds: DataFrame, coverage: float) -> DataFrame:
    """item_id, h: of each item's seeds (h, at, n, k, df) the rarest, so many that those left out cover too little."""

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        h, at, n, k, df = (table.column(c).to_numpy() for c in ("h", "at", "n", "k", "df"))
        # Whole hashes, the most frequent first.
        order = np.lexsort((h, -df))
        border = np.append(np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])), len(h))
        lo, hi = 0, len(border) - 1  # the greatest number of hashes that may be left out
        while lo < hi:
            mid = (lo + hi + 1) // 2
            own = order[: border[mid]]
            if _coverable(np.zeros(len(own), np.int64), at[own], k[own])[1][0] < coverage * n[0]:
                lo = mid
            else:
                hi = mid - 1
        kept = np.unique(h[order[border[lo] :]])
        return pa.table({"item_id": pa.array([key[0].as_py()] * len(kept), pa.int64()), "h": pa.array(kept)})

    return seeds.groupBy("item_id").applyInArrow(choose, "item_id long, h long")


def _pairs_shuffled(docs: DataFrame, items: DataFrame, coverage: float, least: int) -> DataFrame:
    """The pairs for a benchmark of any size, with the row's key ``key__``."""
    words, longest = _item_words(items), max(1, min(SEED, least))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(data, np.uint64)
                k = min(longest, len(own))
                h = _grams(own, k).view(np.int64)
                m = len(h)
                yield pa.RecordBatch.from_arrays([pa.array([item] * m, pa.int64()), pa.array(h), pa.array(np.arange(m, dtype=np.int32)), pa.array([len(own)] * m, pa.int32()), pa.array([k] * m, pa.int32())], ["item_id", "h", "at", "n", "k"])

    of_items = words.select("item_id", "words").mapInArrow(seeds, "item_id long, h long, at int, n int, k int")
    lengths = list(range(1, longest + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                own = token_hashes(text.as_py())
                h = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_grams(own, k) for k in lengths)])).view(np.int64)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(h), key.type), pa.array(h)], ["key__", "h"])

    # Rows with the same doc_id and text are one until the end.
    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")).alias("key__"), "text")
    held = keyed.mapInArrow(scan, "key__ struct<doc_id:long,h:long>, h long")
    held = materialize(held.join(of_items.select("h").distinct(), "h", "left_semi").distinct(), "decontam-held")
    often = held.groupBy("h").agg(F.count("*").alias("df"))
    rare = _rare_seeds(of_items.join(often, "h"), coverage)
    pairs = held.join(rare, "h").select("key__", "item_id").distinct().join(words, "item_id")
    wanted = pairs.groupBy("key__").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, own in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                doc = token_hashes(text.as_py())
                found = [r for i in own.as_py() if (r := covering(i["item_id"], np.frombuffer(i["words"], np.uint64), doc, coverage, least))]
                rows = _pair_rows([key.as_py()["doc_id"]], [found])
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * rows.num_rows, key.type), *rows.columns], ["key__", *rows.schema.names])

    joined = keyed.join(wanted, "key__").select("key__", "text", "items")
    return joined.mapInArrow(check, "key__ struct<doc_id:long,h:long>, " + _PAIRS)


def drop_contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = TILE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``docs`` without the rows that hold an item, whatever their doc_id. Edge cases as in ``contaminated_pairs``."""
    known = _benchmark(items, coverage, least, broadcast_words)
    if known is None:
        key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"))
        found = _pairs_shuffled(docs, items, coverage, least).select(F.col("key__").alias("found__")).distinct()
        return docs.join(found, key == F.col("found__"), "left_anti")
    shared, at = docs.sparkSession.sparkContext.broadcast(known), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.find(text.as_py()) for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
