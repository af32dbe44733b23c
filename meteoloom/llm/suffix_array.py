"""Suffix-array dedup over bytes with difference-cover blockwise construction.

The suffixes at window starts are sorted one bucket at a time, a bucket holding whole 7-byte
prefixes. Ties in a bucket, however long, are resolved by ranks that were computed beforehand
for the suffixes of a difference cover modulo 7: for any two places there is a shift of at most
six bytes that takes both into the cover. Suffixes of one residue thus sort by a plain key, and
two residues merge by the ranks at their common shift. Memory is that of the cover's ranks and
of one bucket. See ``repeats.py`` for how suffixes that can repeat are found and meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import HOT, Windows, digest, without_repeats

LENGTH = 50
SEED = 26
BUCKET = 1 << 18
#: A difference cover modulo 7: every difference of residues occurs in it.
PERIOD, COVER = 7, (0, 1, 3)
_SHIFT = [[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)]


def cover_ranks(prefix: np.ndarray) -> np.ndarray:
    """Ranks (from 1) of the cover's suffixes in their full order, by doubling; 0 elsewhere.

    Only a full order makes all shifts agree on ties.
    """
    n = len(prefix)
    place = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    rank = np.zeros(n + PERIOD, np.uint64)
    distinct, inverse = np.unique(prefix[place], return_inverse=True)
    rank[place] = inverse + 1
    span = PERIOD
    while len(distinct) < len(place):  # a place and the one a span later are in the cover together
        after = np.where(place + span < n, rank[np.minimum(place + span, n)], 0)
        distinct, inverse = np.unique((rank[place] << np.uint64(32)) | after, return_inverse=True)
        rank[place] = inverse + 1
        span *= 2
    return rank


def sort_bucket(at: np.ndarray, prefix: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes at ``at``, by merging the seven residues."""
    name = np.unique(prefix[at], return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
    lists = []
    for r in range(PERIOD):
        own = np.flatnonzero(at % PERIOD == r)
        lists.append(own[np.argsort(name[own] | rank[at[own] + _SHIFT[r][r]], kind="stable")])
    order = np.empty(len(at), np.int64)
    for a, own in enumerate(lists):
        if not len(own):
            continue
        place = np.arange(len(own))
        for b, other in enumerate(lists):
            if a != b and len(other):
                d = _SHIFT[a][b]
                place += np.searchsorted(name[other] | rank[at[other] + d], name[own] | rank[at[own] + d], "left" if a < b else "right")
        order[place] = own
    return order


def array_classes(symbols: np.ndarray, starts: np.ndarray, length: int, bucket: int = BUCKET) -> np.ndarray:
    """Class labels of the windows at ``starts``: equal where ``length`` bytes are equal."""
    n = len(symbols)
    text = np.zeros(n + length + PERIOD, np.uint64)
    text[:n] = symbols + np.uint64(1)
    prefix = np.zeros(n, np.uint64)
    for j in range(PERIOD):  # nine bits a byte, so that the end of the text sorts before byte 0
        prefix = (prefix << np.uint64(9)) | text[j : j + n]
    rank = cover_ranks(prefix)
    text = text.astype(np.uint16)
    by = np.argsort(prefix[starts], kind="stable")
    key = prefix[starts[by]]
    border = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(by))
    label, used, lo = np.empty(len(starts), np.int64), 0, 0
    reach = np.arange(length)
    while lo < len(by):
        # Whole prefixes up to the bucket's size; at least one.
        hi = border[max(np.searchsorted(border, lo + bucket, "right") - 1, np.searchsorted(border, lo, "right"))]
        own = by[lo:hi]
        own = own[sort_bucket(starts[own], prefix, rank)]
        at, same = starts[own], np.empty(len(own), bool)
        same[0] = False
        for k in range(1, len(own), 1 << 15):  # depth that neighbours share, by their bytes
            x = at[k - 1 : k + (1 << 15)]
            rows = text[x[:, None] + reach]
            same[k : k + len(x) - 1] = (rows[1:] == rows[:-1]).all(axis=1)
        node = np.cumsum(~same) - 1
        label[own] = used + node
        used += node[-1] + 1
        lo = hi
    return label


def array_later(symbols: np.ndarray, starts: np.ndarray, stop: np.ndarray, place: np.ndarray, length: int, bucket: int = BUCKET) -> np.ndarray:
    """Which of the windows of ``length`` bytes at ``starts`` also occur at a smaller place."""
    label = array_classes(symbols, starts, length, bucket)
    order = np.argsort(label, kind="stable")
    border = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) != 0]))
    least = np.empty(label.max() + 1, np.int64)
    least[label[order][border]] = np.minimum.reduceat(place[order], border)
    return least[label] < place


def _symbols(data: np.ndarray):
    at = np.arange(len(data))
    return data.astype(np.uint64), at, at + 1


BYTES = Windows("bytes", LENGTH, SEED, _symbols, lambda data: data.astype(np.uint64), array_later, False, 1.0)


def remove_repeated_bytes(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_text: each text without the bytes that a string
    of 50 bytes covers which also starts in a document with a smaller doc_id.

    What is left may cut a character; such bytes are replaced in ``kept_text`` (not in the
    registered query's digest). Edge cases are those of ``repeats.without_repeats``.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_text string"
    return without_repeats(docs, BYTES, lambda i, data, s, e, c: (*_counts(i, c), data[~c].tobytes().decode("utf-8", "replace")), schema, hot)


def _counts(i, covered):
    edge = np.diff(np.concatenate([[0], covered.view(np.int8)]))
    return i, len(covered), int(covered.sum()), int((edge == 1).sum())


def byte_digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The columns of the registered query."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return without_repeats(docs, BYTES, lambda i, data, s, e, c: (*_counts(i, c), digest(data[~c].tobytes())), schema, hot)
