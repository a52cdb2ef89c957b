"""Words of a block of texts as 64-bit hashes, cut and hashed in whole-array steps."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_RANDOM = np.random.default_rng(20240131)
_BASE = int(_RANDOM.integers(1 << 62, 1 << 63)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = _RANDOM.integers(1, 1 << 63, 256).astype(_U) | _U(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# Bytes looked at in one go; a single longer text makes a larger block.
BLOCK = 1 << 19


class _Powers:
    """Powers of the base and of its inverse, as far as needed; those for longer texts are not kept."""

    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def until(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = cls.up, cls.down
        while len(up) < n:
            size = len(up)
            up = np.concatenate([up, up * _U(pow(_BASE, size, 1 << 64))])
            down = np.concatenate([down, down * _U(pow(_INVERSE, size, 1 << 64))])
        if len(up) <= 2 * BLOCK:
            cls.up, cls.down = up, down
        return up, down


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _runs(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run ``values[begin:end]``, the same wherever it stands."""
    up, down = _Powers.until(len(values) + 1)
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[begins]) * down[begins]


@dataclass
class Words:
    """Words of consecutive texts: those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    blob: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each place on, and whether they are all of one text.

        There is one entry per word; entries too near the end of their text are marked False.
        """
        n = len(self.hashes)
        row_end = np.repeat(self.bounds[1:], self.counts())
        begins = np.arange(n)
        fits = begins + k <= row_end
        return self.runs(begins, np.minimum(begins + k, n), salt), fits

    def runs(self, begins: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        values = mixed(self.hashes + _U(salt)) if salt else self.hashes
        return mixed(_runs(values, begins, ends) + (ends - begins).astype(_U))


def blocks(column: pa.Array, fold: bool = False) -> Iterator[tuple[int, Words]]:
    """(first row, words) of consecutive slices of a column of texts; ``fold`` equates A-Z and a-z."""
    column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK, side="right")) - 1)
        yield row, _words(everything[at[row] : at[end]], at[row : end + 1] - at[row], fold)
        row = end


def _words(blob: np.ndarray, offsets: np.ndarray, fold: bool) -> Words:
    inside = np.zeros(len(blob) + 2, bool)
    inside[1:-1] = ~_SPACE[blob]
    # A text's first byte begins a word even if the text before ends in one.
    first = np.zeros(len(blob) + 2, bool)
    first[offsets + 1] = True
    begins = np.flatnonzero(inside[1:] & (~inside[:-1] | first[1:]))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first[1:]))
    hashes = _runs((_FOLDED if fold else _BYTE)[blob], begins, ends)
    hashes = mixed(hashes + (ends - begins).astype(_U))
    return Words(hashes, np.searchsorted(begins, offsets), blob, begins, ends)
