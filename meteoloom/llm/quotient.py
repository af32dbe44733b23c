"""Counting quotient filters without loss, built and merged as sorted arrays.

A key of ``width`` bits is scrambled by an invertible permutation, so equal shares of the keys fall
into equal ranges whatever they count. The highest ``prefix_bits`` bits say which filter of a
shard holds the key, the next ones are its quotient and all the rest its remainder; nothing is cut off, so
a filter gives its keys back and no two keys are ever mistaken for each other.

In a filter, runs of entries with the same quotient lie in slots at or after the quotient. One bit
for each quotient tells whether it has a run, one bit for each slot whether a run ends there; both
together place every run, and empty slots take no more than that bit. Remainders take whole
bytes, counters as many groups of seven bits as they need, which is one byte up to 127.

Keys are lists of uint64 columns: one for widths to 64 bits; two, of 64 and ``width`` - 64, beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix

_ROUNDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)
#: Share of a filter's quotients that would be in use if runs had one entry each.
LOAD = 0.8

Keys = list[np.ndarray]


def _mask(bits: int) -> np.uint64:
    return np.uint64(2**bits - 1)


def _scrambled(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x + np.uint64(salt))


def _halves(keys: Keys, width: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    if width > 64:
        return keys[0], keys[1], 64, width - 64
    low = width // 2
    return keys[0] >> np.uint64(low), keys[0] & _mask(low), width - low, low


def _joined(high: np.ndarray, low: np.ndarray, width: int) -> Keys:
    return [high, low] if width > 64 else [high << np.uint64(width // 2) | low]


def permute(keys: Keys, width: int) -> Keys:
    """A bijection on numbers of ``width`` bits: the halves change each other in turn."""
    high, low, up, down = _halves(keys, width)
    for k, salt in enumerate(_ROUNDS):
        if k % 2:
            low = low ^ (_scrambled(high, salt) & _mask(down))
        else:
            high = high ^ (_scrambled(low, salt) & _mask(up))
    return _joined(high, low, width)


def restore(keys: Keys, width: int) -> Keys:
    """The keys that ``permute`` had."""
    high, low, up, down = _halves(keys, width)
    for k, salt in reversed(list(enumerate(_ROUNDS))):
        if k % 2:
            low = low ^ (_scrambled(high, salt) & _mask(down))
        else:
            high = high ^ (_scrambled(low, salt) & _mask(up))
    return _joined(high, low, width)


def summed(keys: Keys, counts: np.ndarray | None) -> tuple[Keys, np.ndarray]:
    """Sorted distinct keys with the sums of their counts (None: one each); a stable sort, which is quick on sorted stretches.

    The list ``keys`` gets the sorted columns, so that nothing holds the others any more.
    """
    if not len(keys[0]):
        return keys, np.zeros(0, np.int64)
    if counts is None and len(keys) == 1:
        x = np.sort(keys[0])
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        return [x[at]], np.diff(at, append=len(x))
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    for c in range(len(keys)):
        keys[c] = keys[c][order]
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(at, append=len(order)) if counts is None else np.add.reduceat(counts[order], at)


def _varints(values: np.ndarray) -> bytes:
    """Seven bits a byte, lowest first; the highest bit says that more follow."""
    size = np.maximum(1, -(-np.frexp(values.astype(np.float64))[1] // 7)).astype(np.int64)
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        out[start[has] + k] = (values[has] >> (7 * k) & 127) | np.where(size[has] > k + 1, 128, 0)
    return out.tobytes()


def _from_varints(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    start = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(data)) - np.repeat(start, last - start + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), start) if len(start) else np.zeros(0, np.int64)


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _from_bytes(data: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = data.reshape(-1, size)
    return out.view("<u8").ravel()


def _rest(width: int, prefix_bits: int, bits: int) -> tuple[int, list[int]]:
    """Bits of the first column below the quotient, and the bytes of each remainder column."""
    low = min(width, 64) - prefix_bits - bits
    return low, [-(-low // 8)] * (low > 0) + [-(-(width - 64) // 8)] * (width > 64)


def encode(keys: Keys, counts: np.ndarray, width: int, prefix_bits: int) -> bytes:
    """The filter of sorted distinct permuted keys that share their first ``prefix_bits`` bits."""
    n = len(counts)
    bits = min(max(1, int(np.ceil(np.log2(max(1, n) / LOAD)))), min(width, 64) - prefix_bits)
    low, sizes = _rest(width, prefix_bits, bits)
    quotient = ((keys[0] >> np.uint64(low)) & _mask(bits)).astype(np.int64)
    place = np.arange(n)
    slot = place + np.maximum.accumulate(quotient - place) if n else place
    ends = np.flatnonzero(np.concatenate([quotient[1:] != quotient[:-1], [True]])) if n else place
    taken, end = np.zeros(1 << bits, bool), np.zeros(max(1 << bits, int(slot[-1]) + 1 if n else 0), bool)
    taken[quotient] = True
    end[slot[ends]] = True
    parts = [_bytes_of(k, s) for k, s in zip([keys[0] & _mask(low)] * (low > 0) + keys[1:], sizes, strict=True)]
    return np.array([n, bits, len(end)], "<i8").tobytes() + np.packbits(taken).tobytes() + np.packbits(end).tobytes() + b"".join(parts) + _varints(counts)


def decode(data: bytes, width: int, prefix_bits: int, prefix: int) -> tuple[Keys, np.ndarray]:
    """Sorted keys and counts of a filter."""
    n, bits, slots = (int(x) for x in np.frombuffer(data, "<i8", 3))
    raw, at = np.frombuffer(data, np.uint8), 24
    low, sizes = _rest(width, prefix_bits, bits)

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at]

    taken = np.flatnonzero(np.unpackbits(take(-(-(1 << bits) // 8)), count=1 << bits))
    end = np.flatnonzero(np.unpackbits(take(-(-slots // 8)), count=slots))
    start = np.maximum(taken, np.concatenate([[0], end[:-1] + 1])) if n else taken
    first = np.repeat(taken, end - start + 1).astype(np.uint64) | np.uint64(prefix << bits)
    columns = [_from_bytes(take(n * s), s) for s in sizes]
    keys = [(first << np.uint64(low)) | columns[0] if low else first]
    return keys + columns[low > 0 :], _from_varints(raw[at:])


def filters(keys: Keys, counts: np.ndarray | None, width: int, prefix_bits: int) -> Iterator[tuple[int, bytes]]:
    """The filters of any keys (not permuted, in any order, repeats allowed; counts None: one each), by prefix."""
    keys = permute(keys, width)
    keys, counts = summed(keys, counts)
    starts = np.arange(1 << prefix_bits, dtype=np.uint64) << np.uint64(min(width, 64) - prefix_bits) if prefix_bits else np.zeros(1, np.uint64)
    edges = np.append(np.searchsorted(keys[0], starts), len(counts))
    for prefix in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[prefix], edges[prefix + 1]
        yield prefix, encode([k[a:b] for k in keys], counts[a:b], width, prefix_bits)


def build(keys: Keys, counts: np.ndarray | None, width: int, prefix_bits: int) -> list[tuple[int, bytes]]:
    """All that ``filters`` gives."""
    return list(filters(keys, counts, width, prefix_bits))


def merge(parts: list[tuple[Keys, np.ndarray]]) -> tuple[Keys, np.ndarray]:
    """Decoded filters of one prefix as one: sorted keys with the sums of their counts."""
    return summed([np.concatenate(c) for c in zip(*(k for k, _ in parts), strict=True)], np.concatenate([c for _, c in parts]))
