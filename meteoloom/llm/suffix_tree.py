"""Substring dedup over words with prefix-partitioned suffix trees.

The suffixes at window starts are split by variable-length prefixes: a prefix is made longer,
word by word, until the suffixes that share it fit ``GROUP``. The subtree of each group is built
on its own, from its root down: the suffixes under a node part by their next words, and a part
of a single suffix is a leaf that nothing repeats. A node at a depth of ``LENGTH`` words or more
is a repeat, and the deepest one under which a suffix isn't the earliest leaf gives the longest
stretch from there that also starts earlier: a maximal repeat. See ``repeats.py`` for how
suffixes that can repeat are found and meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import Rolling, word_hashes, word_spans
from .repeats import HOT, Windows, digest, without_repeats

LENGTH = 20
SEED = 10
GROUP = 1 << 16
_WORDS = 1 << 17


def word_names(data: np.ndarray) -> np.ndarray:
    """A number for each word: equal where the words' bytes are equal, and only there."""
    start, end = word_spans(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    _, first, name = np.unique(Rolling(data).slices(start, end), return_index=True, return_inverse=True)
    model, size = first[name], end - start
    same = size == size[model]
    for lo in range(0, len(start), _WORDS):  # the bytes of each word against those of the first of its hash
        own = np.arange(lo, min(lo + _WORDS, len(start)))
        own = own[same[own] & (model[own] != own)]
        if len(own):
            n = size[own]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            differ = data[np.repeat(start[own], n) + step] != data[np.repeat(start[model[own]], n) + step]
            same[own] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
    if not same.all():
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(~same).tolist():
            name[i] = len(first) + others.setdefault(data[start[i] : end[i]].tobytes(), len(others))
    return name.astype(np.uint64)


def _parts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each key begins in it."""
    order = np.argsort(key)
    key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


def prefix_groups(names: np.ndarray, starts: np.ndarray, length: int, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """Indices of ``starts`` in groups of at most ``most`` suffixes, with the length of the prefix they share.

    A group holds one prefix or several neighbouring small ones of the same parent. A prefix of
    ``length`` words is split no further; a prefix of one suffix belongs to no group.
    """
    todo = [(np.arange(len(starts)), 0)]
    while todo:
        own, depth = todo.pop()
        if len(own) <= most or depth == length:
            yield own, depth
            continue
        order, border = _parts(names[starts[own] + depth])
        own, ends = own[order], np.append(border[1:], len(own))
        held, size = [], 0
        for a, b in zip(border.tolist(), ends.tolist(), strict=True):
            if b - a > most:
                todo.append((own[a:b], depth + 1))
            elif b - a > 1:
                if size + b - a > most:
                    yield np.concatenate(held), depth
                    held, size = [], 0
                held.append(own[a:b])
                size += b - a
        if held:
            yield np.concatenate(held), depth


def subtree(names: np.ndarray, starts: np.ndarray, stop: np.ndarray, place: np.ndarray, length: int, depth: int) -> np.ndarray:
    """Depth of the deepest node of ``length`` words or more under which each suffix isn't the earliest leaf; 0: none.

    The suffixes share their first ``depth`` words and end at ``stop``.
    """
    reach = np.zeros(len(starts), np.int64)
    bits = int(names.max()).bit_length() if len(names) else 1
    left, node = np.arange(len(starts)), np.zeros(len(starts), np.uint64)
    while len(left) > 1:
        if depth >= length:
            order, border = _parts(node)
            left, size = left[order], np.diff(np.append(border, len(left)))
            late = place[left] > np.repeat(np.minimum.reduceat(place[left], border), size)
            reach[left[late]] = depth
            more = stop[left] > starts[left] + depth  # the others end here
            node = np.repeat(np.arange(len(border), dtype=np.uint64), size)[more]
            left = left[more]
            if len(left) < 2:
                break
        # One edge step: as many words as a key holds, but none across the least depth.
        step = 1 if depth >= length else max(1, min(length - depth, (64 - len(left).bit_length()) // max(bits, 1)))
        key = node
        for j in range(step):
            key = (key << np.uint64(bits)) | names[starts[left] + depth + j]
        order, border = _parts(key)
        size = np.diff(np.append(border, len(left)))
        node = np.repeat(np.arange(len(border), dtype=np.uint64), size)
        branch = np.repeat(size > 1, size)
        left, node = left[order][branch], node[branch]
        if len(node):  # dense again, so that keys stay short
            node = np.cumsum(np.concatenate([[0], node[1:] != node[:-1]])).astype(np.uint64)
        depth += step
    return reach


def tree_later(names: np.ndarray, starts: np.ndarray, stop: np.ndarray, place: np.ndarray, length: int, most: int = GROUP) -> np.ndarray:
    """Which of the windows of ``length`` words at ``starts`` also occur at a smaller place.

    Suffixes end at ``stop``; ``place`` grows by one with each start of the same stretch.
    """
    edge = np.zeros(len(names) + 1, np.int64)
    for own, depth in prefix_groups(names, starts, length, most):
        at = starts[own]
        reach = subtree(names, at, stop[own], place[own], length, depth)
        hit = reach > 0
        np.add.at(edge, at[hit], 1)  # the repeat's windows, from its first to its last
        np.add.at(edge, at[hit] + reach[hit] - length + 1, -1)
    return np.cumsum(edge)[starts] > 0


WORDS = Windows("words", LENGTH, SEED, word_hashes, word_names, tree_later, True, 0.17)


def _kept(data: np.ndarray, covered: np.ndarray) -> bytes:
    words = data.tobytes().split()  # bytes.split() separates at exactly space and 09 to 0D
    return b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])


def remove_repeated_words(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: each text without the words that a window of 20
    words covers which also starts earlier (a smaller doc_id, or before in the same document).

    Edge cases are those of ``repeats.without_repeats``; a text without a word keeps ''.
    """

    def finish(i, data, start, end, covered):
        return i, len(start), int(covered.sum()), _kept(data, covered).decode("utf-8", "surrogatepass")

    return without_repeats(docs, WORDS, finish, "doc_id long, n_words long, n_removed long, kept_text string", hot)


def word_digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The columns of the registered query."""

    def finish(i, data, start, end, covered):
        return i, len(start), int(covered.sum()), digest(_kept(data, covered))

    return without_repeats(docs, WORDS, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", hot)
