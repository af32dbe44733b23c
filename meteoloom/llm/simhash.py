"""SimHash near-duplicates found by deletion variants of fingerprint segments.

Fingerprints link at ``most`` or fewer differing bits. With most = 3 and two segments of 32
bits, one segment differs by at most one bit; so each fingerprint is indexed under 64 keys,
either segment with one bit wildcarded. Equal keys are found by an equality shuffle, and the
whole fingerprints are then compared. A key's members are not paired off: links inside a key
grow a tree from member to member, at most one row each, which keeps the same components. A
key with more than ``cap`` members is dealt out again under the variants of the halves of its
other segment, which fix 46 of 64 bits, so that no group can exceed 2**18 members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, discard, materialize
from .components import components

MOST = 3
CAP = 4096
_CHUNK = 1 << 16


def shingle_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of the 3-word shingles of the text with A-Z lower-cased, as array<long>.

    Fewer than three words give the whole sequence, none an empty array.
    """
    words = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        n = F.size(w)
        at = F.sequence(F.lit(1), F.greatest(F.lit(1), n - 2))
        return F.when(n > 0, F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(w, i, 3), " "))))

    # One-element lambda: the words are made once and named.
    return F.coalesce(F.element_at(F.transform(F.array(words), of), 1), F.array().cast("array<bigint>"))


def _majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = batch.column(1)
        values = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        offsets = np.asarray(hashes.offsets)
        offsets = offsets - offsets[0]
        counts = np.zeros((len(offsets) - 1, 64), np.int64)
        for lo in range(0, len(values), _CHUNK):
            hi = min(lo + _CHUNK, len(values))
            bits = np.unpackbits(values[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first, last = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
            rows = np.arange(first, last)
            rows = rows[offsets[rows + 1] > np.maximum(offsets[rows], lo)]
            if len(rows):
                counts[rows] += np.add.reduceat(bits, np.maximum(offsets[rows], lo) - lo, axis=0, dtype=np.int64)
        over = (2 * counts > np.diff(offsets)[:, None]).astype(np.uint8)
        fp = np.packbits(over, axis=1, bitorder="little").copy().view("<u8").ravel().view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), batch.column(2)], ["doc_id", "fp", "text_h"])


def simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) and text_h, a hash of the text, one row per row of ``docs``; zero without a word."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes(F.col("text")).alias("h"), F.xxhash64("text").alias("text_h"))
    return hashed.mapInArrow(_majority, "doc_id long, fp long, text_h long")


def _variants(value: Column, width: int, tag: int) -> list[Column]:
    """Keys of a segment with each bit wildcarded: the other bits, the wildcard's place and ``tag``."""
    return [value.bitwiseAND(F.lit(~(1 << i) & ((1 << width) - 1))).bitwiseOR(F.lit((tag * width + i) << width)) for i in range(width)]


def _halves(value: Column, width: int) -> tuple[Column, Column]:
    return value.bitwiseAND(F.lit((1 << width) - 1)), F.shiftrightunsigned(value, width).bitwiseAND(F.lit((1 << width) - 1))


def _tree(group: np.ndarray, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that span the components of a group of distinct fingerprints."""
    a, b = [], []
    left = group
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= most
            if near.any():
                found = left[near]
                a.append(found)
                b.append(np.full(len(found), x, np.uint64))
                left = left[~near]
                todo.extend(found)
    return a, b


def _linker(most: int, cap: int | None):
    """Over rows sorted by (k1, k2, fp): link rows (a, b, k1 = null), or for a key with more than
    ``cap`` members its rows (a = fp, b = null, k1) to be dealt out again."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        hot = None  # the key whose rows are being passed on

        def out(a, b, again):
            a, b = np.concatenate([*a, again[2].view(np.uint64)]).view(np.int64), np.concatenate(b).view(np.int64)
            k = len(again[2])
            ka = np.concatenate([np.zeros(len(b), np.int64), again[0]])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.concatenate([b, np.zeros(k, np.int64)]), mask=np.arange(len(a)) >= len(b)), pa.array(ka, mask=np.arange(len(a)) < len(b))], ["a", "b", "k1"])

        def runs(rows: np.ndarray, ended: bool):
            nonlocal held, hot
            start = np.flatnonzero(np.concatenate([[True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])]))
            end = np.append(start[1:], rows.shape[1])
            a, b, again = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], []
            fp = rows[2].view(np.uint64)
            for i in np.flatnonzero((end - start > 1) | (np.arange(len(start)) == len(start) - 1) | (np.arange(len(start)) == 0)):
                s, e, last = start[i], end[i], i == len(start) - 1 and not ended
                key = (rows[0, s], rows[1, s])
                if hot == key or (cap and e - s > cap):
                    hot = key
                    again.append(rows[:, s:e])
                    if last:
                        held = rows[:, :0]
                elif last:
                    held = rows[:, s:e]
                elif e - s > 1:
                    x, y = _tree(fp[s:e], most)
                    a += x
                    b += y
            return out(a, b, np.concatenate(again, axis=1) if again else rows[:, :0])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(c, dtype=np.int64) for c in (batch.column(0), batch.column(1), batch.column(2))])
            rows, held = np.concatenate([held, rows], axis=1), held[:, :0]
            done = runs(rows, False)
            if done.num_rows:
                yield done
        if held.shape[1]:
            yield runs(held, True)

    return link


def near_links(fps: DataFrame, most: int = MOST, cap: int = CAP) -> DataFrame:
    """fps (fp), distinct -> (a, b): links of ``most`` or fewer bits that span all components."""
    if not 0 <= most <= 3:
        raise ValueError("two segments with one wildcard find links of at most 3 bits")
    low, high = _halves(F.col("fp"), 32)
    keys = F.explode(F.array(*_variants(low, 32, 0), *_variants(high, 32, 1)))
    found = fps.select(keys.alias("k1"), F.lit(0).cast("long").alias("k2"), "fp")
    schema = "a long, b long, k1 long"
    first = materialize(found.repartition("k1").sortWithinPartitions("k1", "k2", "fp").mapInArrow(_linker(most, cap), schema), "simhash-links")
    # The segment that a hot key does not fix: key numbers from 32 on belong to the high one.
    rest = F.when(F.shiftright("k1", 32) < 32, F.shiftrightunsigned("a", 32)).otherwise(F.col("a")).bitwiseAND(F.lit(0xFFFFFFFF))
    hot = first.where("k1 is not null").select("k1", F.col("a").alias("fp"), rest.alias("_rest"))
    lower, upper = _halves(F.col("_rest"), 16)
    again = hot.select("k1", F.explode(F.array(*_variants(lower, 16, 0), *_variants(upper, 16, 1))).alias("k2"), "fp")
    second = again.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp").mapInArrow(_linker(most, None), schema)
    return first.where("k1 is null").select("a", "b").unionByName(second.select("a", "b")).distinct()


def simhash_groups(docs: DataFrame, most: int = MOST, cap: int = CAP) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    component_id is the smallest doc_id that links reach. Null and empty texts have the zero
    fingerprint and link like any other. Documents with equal fingerprints are one node, so
    copies are never paired. A null doc_id gets its group's component_id, null if no document
    of the group has an id. Rows that repeat a doc_id are each signed and reported.
    """
    out, _ = _grouped(docs, most, cap)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, most: int = MOST, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """Every row as doc_id, fp, component_id; and one row (doc_id, text_h) for each group: the
    least doc_id (null last), and of rows with that id the one whose text has the least hash."""
    signed = materialize(simhash(docs), "simhash-fp")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_h")
    nodes = materialize(signed.groupBy("fp").agg(F.min(row).alias("rep")), "simhash-nodes")
    links = near_links(nodes.select("fp"), most, cap)
    label = components(links)
    # A component is named by its least fingerprint first, then by its least doc_id.
    named = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("rep").alias("rep"))
    of = materialize(named.select("fp", "c").join(least, "c").select(F.col("fp").alias("_fp"), "c", "rep"), "simhash-components")
    discard(nodes)
    out = signed.join(of, F.col("fp") == F.col("_fp")).select("doc_id", "fp", F.col("rep.doc_id").alias("component_id"))
    return out, of.select("c", "rep").distinct().select("rep.doc_id", "rep.text_h")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group: the one with the least doc_id, nulls last.

    Of rows that repeat this doc_id the one whose text has the least hash stays, and of equal
    rows one. A group without any doc_id keeps one row too.
    """
    _, kept = _grouped(docs, **options)
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_h"))
    kept = kept.select(F.struct("doc_id", "text_h").alias("kept"))
    # The documents' columns travel as one, so that none clashes.
    rows = docs.select(F.struct("*").alias("doc"), key.alias("row")).join(kept, F.col("row") == F.col("kept"), "left_semi")
    # Sorted by this key already; only equal rows are numbered beyond 1.
    nth = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    return rows.withColumn("nth", nth).where("nth = 1").select("doc.*")
