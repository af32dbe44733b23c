"""Helpers shared by the corpus operators: working tables and vectorised text kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.working import delete, scratch

#: The separators between words: space and the five control characters 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"

# ------------------------------------------------------------------ working tables


#: Spark deletes a query's shuffle files as soon as the query is done.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage.

    The files are as durable as the shared store, so a lost executor costs nothing. The shuffle
    files of the finished job are let go. With ``by`` the table is partitioned by that column.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        out = df.write.option("compression", "zstd")
        (out.partitionBy(by) if by else out).parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` returned, once nothing reads them any more."""
    for df in tables:
        delete(df.sparkSession, df._stored_at)


def hash_share(hashed: Column, share: float) -> Column:
    """Whether a hash (long) lies among that share of all hashes; a cheap first cut before a sort that keeps a fixed number of rows."""
    return F.shiftrightunsigned(hashed, 1) <= F.lit(min(2**63 - 1, int(share * 2**63)))


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(col: Column) -> Column:
    """Number of words (long); null counts as empty."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


# ------------------------------------------------------------------ vectorised kernels

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _INV)]), dtype=np.uint64)
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the well-known 64-bit finaliser)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


class Rolling:
    """Polynomial hashes (modulo 2**64) of any slices of one sequence, all at once."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.up, down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * down[:n], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scrambled hash of symbols[start:end] for each pair."""
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.up[start])

    def grams(self, k: int) -> np.ndarray:
        """Scrambled hash of the k symbols from every position."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix((self.sums[k:] - self.sums[: n - k + 1]) * self.up[: n - k + 1])


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the words of a UTF-8 text start and end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end (bytes) of every word."""
    start, end = word_spans(data)
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    return Rolling(data).slices(start, end), start, end


_TOGETHER = 1 << 20


def words_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of all texts in order, and how many each text has; some texts at a time.

    Works on the column's own buffer. A text of more than a megabyte comes alone; null ones have
    no words.
    """
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _TOGETHER, "right")) - 1)
        lo, cut = offsets[first], offsets[first : last + 1] - offsets[first]
        own = data[lo : lo + cut[-1]]
        inside = np.zeros(len(own) + 1, bool)
        inside[:-1] = ~_SEPARATOR[own]
        after = np.concatenate([[False], inside[:-1]])
        after[cut[:-1][cut[:-1] < len(own)]] = False  # a text begins anew
        start = np.flatnonzero(inside & ~after)
        ends = ~inside
        ends[cut] = True
        ends = np.flatnonzero(ends)
        end = ends[np.searchsorted(ends, start, "right")]
        h = Rolling(own).slices(start, end) if len(start) else np.zeros(0, np.uint64)
        yield h, np.diff(np.searchsorted(start, cut))
        first = last


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def sliding(values: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of each w consecutive values, by doubling."""
    f = np.minimum if least else np.maximum
    out, span = values, 1
    while span * 2 <= w:
        out = f(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = f(out[: len(out) - (w - span)], out[w - span :])
    return out
