"""Counting quotient filters that lose nothing: exact counts of integer keys in little space.

A key of p bits is first permuted by a function that can be undone, so that keys spread evenly. Its
upper q bits, the quotient, say in which run its entry stands; only the rest, the remainder, is
written, whole, beside a counter. As remainders are whole, two keys never share an entry, and every
key can be read back. Entries stand in the order of permuted keys, so filters of several shards are
merged by merging sorted sequences, and a filter can be cut into blocks by leading bits, to be merged
block by block in different tasks.

Keys wider than 64 bits are several columns of 64 bits each, the first of which holds the quotient.
"""

from __future__ import annotations

import struct

import numpy as np

#: Fixed odd factors of the permutation; any would do.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
HEADER = struct.Struct("<IBBBBII")
BIG = 255


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    """A permutation of the numbers of so many bits."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for factor in FACTORS:
        x = x ^ (x >> half)
        x = (x * np.uint64(factor)) & mask
    return x ^ (x >> half)


def _gather(x: np.ndarray, bits: int) -> np.ndarray:
    """What ``_spread`` made it from: a shift by half the bits undoes itself, a factor has an inverse."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for factor in reversed(FACTORS):
        x = x ^ (x >> half)
        x = (x * np.uint64(pow(factor, -1, 1 << 64))) & mask
    return x ^ (x >> half)


def permuted(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Permuted keys; several columns are 64 bits each, and each depends on all in the end."""
    if len(columns) == 1:
        return [_spread(columns[0], bits)]
    columns = list(columns)
    for _ in range(2):
        for i in range(len(columns)):
            columns[i] = columns[i] ^ _spread(columns[i - 1] + np.uint64(i + 1), 64)
    return columns


def restored(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Keys before they were permuted."""
    if len(columns) == 1:
        return [_gather(columns[0], bits)]
    columns = list(columns)
    for _ in range(2):
        for i in reversed(range(len(columns))):
            columns[i] = columns[i] ^ _spread(columns[i - 1] + np.uint64(i + 1), 64)
    return columns


def _short(numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers in a byte each, and those that need more."""
    return np.minimum(numbers, BIG).astype(np.uint8).tobytes(), numbers[numbers >= BIG].astype(np.uint64)


def _long(data: bytes, big: np.ndarray) -> np.ndarray:
    numbers = np.frombuffer(data, np.uint8).astype(np.uint64)
    numbers[numbers == BIG] = big
    return numbers


class CountingFilter:
    """Counts by key; ``columns`` holds permuted keys in order, ``counts`` their counters.

    ``prefix`` leading bits are the same in all keys of a block and are not written.
    """

    def __init__(self, columns: list[np.ndarray], counts: np.ndarray, bits: int, prefix: int = 0, block: int = 0):
        self.columns, self.counts, self.bits, self.prefix, self.block = columns, counts, bits, prefix, block

    @classmethod
    def of(cls, keys: list[np.ndarray], bits: int) -> CountingFilter:
        """Counts of the rows of some key columns, repeated ones added up."""
        found = permuted(keys, bits)
        if len(found) == 1:
            column, counts = np.unique(found[0], return_counts=True)
            return cls([column], counts.astype(np.uint64), bits)
        return cls._summed(found, np.ones(len(found[0]), np.uint64), bits)

    @classmethod
    def _summed(cls, columns, counts, bits, prefix=0, block=0) -> CountingFilter:
        """Entries put in order and those of equal keys added up. The sort is one that makes use of
        sorted stretches, which is what the filters to be merged are."""
        order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
        columns, counts = [column[order] for column in columns], counts[order]
        if len(order):
            new = np.zeros(len(order), bool)
            new[0] = True
            for column in columns:
                new[1:] |= column[1:] != column[:-1]
            first = np.flatnonzero(new)
            columns, counts = [column[first] for column in columns], np.add.reduceat(counts, first)
        return cls(columns, counts, bits, prefix, block)

    @classmethod
    def merged(cls, filters: list[CountingFilter]) -> CountingFilter:
        """One filter with the counts of several over the same kind of keys and the same block."""
        first = filters[0]
        columns = [np.concatenate(parts) for parts in zip(*(f.columns for f in filters), strict=True)]
        counts = np.concatenate([f.counts for f in filters])
        return cls._summed(columns, counts, first.bits, first.prefix, first.block)

    def __len__(self) -> int:
        return len(self.counts)

    def keys(self) -> list[np.ndarray]:
        """The keys as they were counted."""
        return restored(self.columns, self.bits)

    def over(self, least: int) -> CountingFilter:
        """Only the entries counted so often or more."""
        kept = self.counts >= least
        return CountingFilter([column[kept] for column in self.columns], self.counts[kept], self.bits, self.prefix, self.block)

    def count(self, key: list[int]) -> int:
        """The counter of one key, found by its quotient's run; 0 if it was never counted."""
        wanted = [column[0] for column in permuted([np.array([part], np.uint64) for part in key], self.bits)]
        low, high = 0, len(self)
        for column, part in zip(self.columns, wanted, strict=True):
            run = column[low:high]
            low, high = low + int(np.searchsorted(run, part, "left")), low + int(np.searchsorted(run, part, "right"))
        return int(self.counts[low]) if high > low else 0

    def blocks(self, prefix: int) -> list[CountingFilter]:
        """The filter cut by the first ``prefix`` bits of its permuted keys; empty blocks are left out."""
        if not prefix or not len(self):
            return [self] if len(self) else []
        leading = self.columns[0] >> np.uint64(self.bits - prefix)
        numbers, starts = np.unique(leading, return_index=True)
        ends = [*starts[1:].tolist(), len(self)]
        return [
            CountingFilter([column[low:high] for column in self.columns], self.counts[low:high], self.bits, prefix, int(number))
            for number, low, high in zip(numbers, starts.tolist(), ends, strict=True)
        ]

    def to_bytes(self) -> bytes:
        """Run lengths by quotient, remainders and counters. A run and a remainder take a byte more
        than they need at most; long runs and large counters follow after."""
        own = min(max(len(self).bit_length() - 1, 0), self.bits - self.prefix, 32)
        rest = self.bits - self.prefix - own
        quotients = (self.columns[0] >> np.uint64(rest)) & np.uint64((1 << own) - 1)
        runs, long_runs = _short(np.bincount(quotients.astype(np.int64), minlength=1 << own))
        counts, large = _short(self.counts)
        width = (rest + 7) // 8
        written = self.columns[0] & np.uint64((1 << rest) - 1)
        remainders = [np.ascontiguousarray(written.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()]
        remainders += [column.astype("<u8").tobytes() for column in self.columns[1:]]
        header = HEADER.pack(len(self), len(self.columns), self.bits, self.prefix, own, len(long_runs), len(large))
        return b"".join([header, struct.pack("<Q", self.block), runs, long_runs.tobytes(), counts, large.tobytes(), *remainders])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingFilter:
        n, width, bits, prefix, own, long_runs, large = HEADER.unpack_from(data)
        (block,) = struct.unpack_from("<Q", data, HEADER.size)
        at = HEADER.size + 8

        def take(size: int) -> bytes:
            nonlocal at
            at += size
            return data[at - size : at]

        runs = _long(take(1 << own), np.frombuffer(take(8 * long_runs), np.uint64))
        counts = _long(take(n), np.frombuffer(take(8 * large), np.uint64))
        rest = bits - prefix - own
        held = (rest + 7) // 8
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :held] = np.frombuffer(take(n * held), np.uint8).reshape(n, held)
        first = whole.view("<u8").reshape(n).astype(np.uint64)
        quotients = np.repeat(np.arange(1 << own, dtype=np.uint64), runs.astype(np.int64)) | np.uint64(block << own)
        if rest < 64:
            first |= quotients << np.uint64(rest)
        columns = [first, *(np.frombuffer(take(8 * n), "<u8").astype(np.uint64) for _ in range(width - 1))]
        return cls(columns, counts, bits, prefix, block)
