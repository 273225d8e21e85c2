"""Word shingles as hashes, and their circulant MinHash coordinates, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
KNOWN_WORDS = 1 << 17

P = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept as long as few are known."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


known = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\r\v\f")] = True


def texts_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of the words of some texts, end to end, and the number of words of each. XXH3
    of words of up to 16 bytes, nearly all, is worked out for all of them at once."""
    parts = [(text or "").encode() for text in texts]
    joined = b" ".join([b"", *parts, b""]).lower()
    space = SPACE[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    borders = np.cumsum([0, *(len(part) + 1 for part in parts)])
    sizes = np.diff(np.searchsorted(starts, borders, side="right"))
    padded = joined + bytes(8)
    eights = np.ndarray((len(joined),), "<u8", padded, strides=(1,))
    n = ends - starts
    hashes = np.empty(len(n), np.uint64)
    for few, most, digest in ((1, 3, xxh3_to_3), (4, 8, xxh3_to_8), (9, 16, xxh3_to_16)):
        own = np.flatnonzero((n >= few) & (n <= most))
        long = n[own].astype(np.uint64)
        hashes[own] = digest(eights[starts[own]], eights[np.maximum(ends[own] - 8, 0)], long)
    for i in np.flatnonzero(n > 16).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(joined[starts[i] : ends[i]])
    return hashes, sizes


def xxh3_to_3(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 1 to 3 bytes, from the eight bytes at the first one."""
    byte, eight = np.uint64(0xFF), np.uint64(8)
    c1, c2, c3 = first & byte, (first >> (n >> np.uint64(1)) * eight) & byte, (first >> (n - np.uint64(1)) * eight) & byte
    x = (c1 << np.uint64(16) | c2 << np.uint64(24) | c3 | n << eight) ^ np.uint64(0x87275A9B)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return x ^ (x >> np.uint64(32))


def xxh3_to_8(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 4 to 8 bytes, from the eight bytes at the first one."""
    half = np.uint64(0xFFFFFFFF)
    ending = (first >> (n - np.uint64(4)) * np.uint64(8)) & half
    x = (ending + (first << np.uint64(32))) ^ np.uint64(0xC73AB174C5ECD5A2)
    x ^= (x << np.uint64(49) | x >> np.uint64(15)) ^ (x << np.uint64(24) | x >> np.uint64(40))
    x *= np.uint64(0x9FB21C651E98DF25)
    x = (x ^ ((x >> np.uint64(35)) + n)) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def xxh3_to_16(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 9 to 16 bytes, from the first and the last eight."""
    low, high = first ^ np.uint64(0x6782737BEA4239B9), last ^ np.uint64(0xAF56BC3B0996523A)
    half, half_of = np.uint64(0xFFFFFFFF), np.uint64(32)
    a, b, c, d = low & half, low >> half_of, high & half, high >> half_of
    middle = (a * c >> half_of) + (b * c & half) + a * d
    product = (b * c >> half_of) + (middle >> half_of) + b * d
    x = n + low.byteswap() + high + (low * high ^ product)
    x = (x ^ (x >> np.uint64(37))) * np.uint64(0x165667919E3779F9)
    return x ^ (x >> np.uint64(32))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; of the whole sequence if it is shorter."""
    size = min(size, len(hashes))
    if size == 0:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        total = mixed(total * P + hashes[i : len(hashes) - size + 1 + i])
    return total


def permuted(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(first)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(second)
    return x ^ (x >> np.uint32(16))


def circulant(sets: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash coordinates of the last axis of shingle hashes from two permutations only.

    The first permutation scatters the elements; coordinate k is the least value that the second,
    shifted around by k places, gives to them.
    """
    places = permuted((sets ^ (sets >> np.uint64(32))).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    found = np.empty((*sets.shape[:-1], coordinates), np.uint32)
    step = max(1, (1 << 16) // max(1, sets.shape[-1]))
    flat = places.ndim == 1
    for start in range(0, coordinates, step):
        shifts = np.arange(start, min(start + step, coordinates), dtype=np.uint32)
        if flat:
            found[start : start + step] = permuted(places[None, :] - shifts[:, None], 0x21F0AAAD, 0xD35A2D97).min(1)
        else:
            for k in shifts:
                found[..., k] = permuted(places - k, 0x21F0AAAD, 0xD35A2D97).min(-1)
    return found


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; bands never share keys."""
    bands = coordinates.shape[-1] // rows
    shaped = coordinates[..., : bands * rows].reshape(*coordinates.shape[:-1], bands, rows).astype(np.uint64)
    total = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * P), shaped.shape[:-1]).copy()
    for i in range(rows):
        total = mixed(total * P + shaped[..., i])
    return total.view(np.int64)
