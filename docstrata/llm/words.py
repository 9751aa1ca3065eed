"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes of a class. Its hash is a polynomial over its bytes,
computed for all words of a chunk at once; equal words have equal hashes in every task,
so hashes name words (and runs of words) across the cluster without a dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
CHUNK_BYTES = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed))


def signed(x: np.ndarray) -> np.ndarray:
    """As Spark longs."""
    return np.ascontiguousarray(x).view(np.int64)


def not_space() -> np.ndarray:
    """Words between ASCII white space."""
    return ~_SPACE


def alphanumeric() -> np.ndarray:
    """Words of ASCII letters, digits and anything beyond ASCII."""
    member = np.zeros(256, dtype=bool)
    member[ord("0") : ord("9") + 1] = True
    member[ord("A") : ord("Z") + 1] = True
    member[ord("a") : ord("z") + 1] = True
    member[128:] = True
    return member


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each row starts; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes; a longer row is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


class Words:
    """The words of a range of rows.

    ``starts`` and ``ends`` are byte positions, ``first[d]`` is the number of the
    first word of row d, with the total at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = member[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        before[cuts] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, hasher: Hasher) -> np.ndarray:
        return hasher(self)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Hasher:
    """Names words by 64-bit hashes; ``fold`` makes A-Z equal to a-z."""

    def __init__(self, member: np.ndarray, seed: int, fold: bool = False):
        table = stream(seed, 256)
        if fold:
            table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
        table[~member] = 0
        self.table = table
        self.base = (int(stream(seed ^ 0x5DEECE66D, 1)[0]) | 1) & MASK
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            self.power = powers(self.base, n)
            self.inverse = powers(pow(self.base, -1, 1 << 64), n)

    def __call__(self, words: Words) -> np.ndarray:
        if not len(words):
            return np.zeros(0, np.uint64)
        n = len(words.data)
        self._grow(n)
        values = self.table[words.data]
        values *= self.power[:n]
        sums = np.add.reduceat(values, words.starts)
        sums *= self.inverse[words.starts]
        return mix(sums + (words.ends - words.starts).astype(np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class Spans:
    """Hashes of any run of consecutive words, from prefix sums."""

    def __init__(self, hashes: np.ndarray, seed: int):
        base = (int(stream(seed, 1)[0]) | 1) & MASK
        n = len(hashes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(base, n)[:n], out=self.sums[1:])
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the words from start up to, not with, end."""
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))
