"""Counters of packed n-grams as counting quotient filters, exact because nothing is thrown away.

An n-gram of word ids is a number of a few times ``bits`` bits. A fixed permutation of these numbers, which
can be undone, spreads them evenly. The leading bits of a permuted number, its quotient, are not stored:
one bit per quotient says whether any number has it, one bit per number whether it is the last of
its quotient, and only the remaining bits stand beside the count. Taking the permutation back gives
the n-gram itself, so two different n-grams never share a counter.

A filter holds the numbers of one shard, a range of permuted numbers; filters of the same shard are
merged by bringing their sorted numbers together and adding the counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tarmac.llm.word_blocks import mixed

_U = np.uint64
# One key per half round of the permutation.
_KEYS = [_U(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


@dataclass(frozen=True)
class Shape:
    """N-grams of ``words`` ids of ``bits`` bits each, dealt to ``shards`` ranges."""

    words: int
    bits: int
    shards: int

    def __post_init__(self):
        if self.bits * (self.words - 1) > 62:
            raise ValueError(f"{self.words} ids of {self.bits} bits do not fit")

    @property
    def right(self) -> int:
        """Bits behind the first id."""
        return self.bits * (self.words - 1)

    def packed(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The first id, and the others side by side."""
        rest = ids[1].astype(_U)
        for more in ids[2:]:
            rest = rest << _U(self.bits) | more.astype(_U)
        return ids[0].astype(_U), rest

    def unpacked(self, left: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
        ids = [rest >> _U(self.bits * i) & _mask(self.bits) for i in range(self.words - 2, -1, -1)]
        return [left, *ids]

    def permuted(self, left: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each half is changed by a function of the other one only, so each step can be undone."""
        for k in _KEYS:
            rest = (rest ^ mixed(left + k)) & _mask(self.right)
            left = (left ^ mixed(rest + k)) & _mask(self.bits)
        return left, rest

    def restored(self, left: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(_KEYS):
            left = (left ^ mixed(rest + k)) & _mask(self.bits)
            rest = (rest ^ mixed(left + k)) & _mask(self.right)
        return left, rest

    def shard_of(self, left: np.ndarray) -> np.ndarray:
        """The range a permuted number lies in: ranges are cut by the left half, evenly."""
        return left * _U(self.shards) >> _U(self.bits)


def counted(left: np.ndarray, rest: np.ndarray, counts: np.ndarray | None, shape: Shape):
    """Distinct numbers in order, with their counts added up."""
    if shape.bits + shape.right <= 64:
        key = left << _U(shape.right) | rest
        if counts is None:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        left, rest = key[first] >> _U(shape.right), key[first] & _mask(shape.right)
        size = len(key)
    else:
        order = np.lexsort((rest, left))
        left, rest = left[order], rest[order]
        counts = None if counts is None else counts[order]
        size = len(left)
        fresh = (left[1:] != left[:-1]) | (rest[1:] != rest[:-1])
        first = np.flatnonzero(np.concatenate([[True], fresh])) if size else np.empty(0, np.int64)
        left, rest = left[first], rest[first]
    if counts is None:
        sums = np.diff(np.append(first, size)).astype(np.int64)
    else:
        sums = np.add.reduceat(counts, first) if size else np.empty(0, np.int64)
    return left, rest, sums


def _wide(remainder_bits: int) -> int:
    return -(-remainder_bits // 8)


def encode(left: np.ndarray, rest: np.ndarray, counts: np.ndarray, shape: Shape) -> bytes:
    """A filter of sorted distinct numbers of one shard."""
    n = len(left)
    # About one quotient per number of the shard.
    depth = min(shape.bits, max(1, (n * shape.shards).bit_length() - 1))
    below = shape.bits - depth
    quotient = left >> _U(below)
    base = int(quotient[0])
    last = np.append(quotient[1:] != quotient[:-1], True)
    taken = np.zeros(int(quotient[-1]) - base + 1, bool)
    taken[(quotient - _U(base)).astype(np.int64)] = True
    head = np.array([n, depth, base, len(taken)], np.int64)
    parts = [head.tobytes(), np.packbits(taken).tobytes(), np.packbits(last).tobytes()]
    for lane, bits in ((left & _mask(below), below), (rest, shape.right)):
        if bits:
            lane = np.ascontiguousarray(lane).astype("<u8").view(np.uint8).reshape(n, 8)
            parts.append(np.ascontiguousarray(lane[:, : _wide(bits)]).tobytes())
    # A count of 255 or more says so in its byte and stands at the end.
    parts.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    parts.append(counts[counts >= 255].astype("<i8").tobytes())
    return b"".join(parts)


def decode(data: bytes, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted numbers and counts of a filter."""
    n, depth, base, span = np.frombuffer(data, np.int64, 4).tolist()
    at, below = 32, shape.bits - depth

    def bits(count: int) -> np.ndarray:
        nonlocal at
        size = _wide(count)
        found = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count).astype(bool)
        at += size
        return found

    taken, last = bits(span), bits(n)
    runs = np.diff(np.flatnonzero(last), prepend=-1)
    left = np.repeat(np.flatnonzero(taken).astype(_U) + _U(base), runs) << _U(below)

    def lane(count: int) -> np.ndarray:
        nonlocal at
        if not count:
            return np.zeros(n, _U)
        wide = _wide(count)
        out = np.zeros((n, 8), np.uint8)
        out[:, :wide] = np.frombuffer(data, np.uint8, n * wide, at).reshape(n, wide)
        at += n * wide
        return out.view("<u8").reshape(n).astype(_U)

    left |= lane(below)
    rest = lane(shape.right)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=at + n)
    return left, rest, counts


def sharded(left: np.ndarray, rest: np.ndarray, counts: np.ndarray, shape: Shape) -> list[tuple[int, bytes]]:
    """One filter per shard that has any of the sorted distinct numbers."""
    shard = shape.shard_of(left)
    cuts = [*np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist(), len(left)] if len(left) else []
    return [
        (int(shard[a]), encode(left[a:b], rest[a:b], counts[a:b], shape)) for a, b in zip(cuts, cuts[1:])
    ]


def merged(filters: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and counts of several filters of one shard together."""
    lanes = [np.concatenate(lane) for lane in zip(*[decode(data, shape) for data in filters])]
    return counted(*lanes, shape)
