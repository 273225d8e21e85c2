"""Document fingerprints by consistent weighted sampling of words weighted by their counts.

For each coordinate every word has gamma variates r and c and a uniform b, drawn from a hash of
the word and the coordinate. A word of weight w gets t = floor(ln w / r + b), ln y = r (t - b)
and ln a = ln c - ln y - r; the coordinate keeps the (word, t) of least a. Two texts agree on a
coordinate with a probability equal to the generalised Jaccard similarity of their counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.shingles import mixed
from reelframe.llm.workers import map_rows

COORDINATES = 64
#: Words whose variates a task keeps at hand.
KNOWN_WORDS = 40_000
#: Words of one text that are sampled at a time: bounds memory for very long texts.
WORDS_AT_ONCE = 4_096

#: Rows in a range of ids, about, where the session's number of partitions would make it larger.
ROWS_A_RANGE = 200_000

FINGERPRINTED = "doc_id long, fingerprint string"
PAIRED = (
    "doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def variates(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """r, ln c and b of words and coordinates: (words, 3, coordinates)."""
    lanes = mixed(np.arange(1, 5 * coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    draws = mixed(hashes[:, None] ^ lanes[None, :])
    uniform = ((draws >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    u = uniform.reshape(len(hashes), 5, coordinates)
    r = -np.log(u[:, 0] * u[:, 1])
    c = -np.log(u[:, 2] * u[:, 3])
    return np.stack([r, np.log(c), u[:, 4]], axis=1).astype(np.float32)


def log_a(r: np.ndarray, log_c: np.ndarray, b: np.ndarray, t: np.ndarray) -> np.ndarray:
    """What the least of decides a coordinate."""
    return log_c - r * (t - b) - r


class Sampler:
    def __init__(self, coordinates: int = COORDINATES):
        self.coordinates = coordinates
        self.rows: dict[str, int] = {}
        self.hashes = np.zeros(KNOWN_WORDS, np.uint64)
        self.known = np.zeros((KNOWN_WORDS, 3, coordinates), np.float32)
        self.once = np.zeros((KNOWN_WORDS, coordinates), np.float32)

    def _places(self, words: list[str]) -> np.ndarray:
        new = [word for word in words if word not in self.rows]
        if len(self.rows) + len(new) > KNOWN_WORDS:
            self.rows.clear()
            new = words
        if new:
            start = len(self.rows)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, map(str.encode, new)), np.uint64, len(new))
            self.hashes[start : start + len(new)] = hashes
            self.known[start : start + len(new)] = drawn = variates(hashes, self.coordinates)
            self.once[start : start + len(new)] = log_a(drawn[:, 0], drawn[:, 1], drawn[:, 2], np.floor(drawn[:, 2]))
            self.rows.update(zip(new, range(start, start + len(new)), strict=True))
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def sample(self, text: str) -> np.ndarray:
        """The coordinates of a whole text; all zero if it has no word."""
        counts = Counter(text.lower().split())
        best = np.full(self.coordinates, np.inf, np.float32)
        kept = np.zeros(self.coordinates, np.uint32)
        every = np.arange(self.coordinates)
        words, numbers = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE]
            places = self._places(part)
            seen = numbers[start : start + WORDS_AT_ONCE]
            weights = np.log(seen.astype(np.float64)).astype(np.float32)
            # What a word that occurs once gives does not depend on the text.
            found = self.once[places]
            again = np.flatnonzero(seen > 1)
            r, log_c, b = (self.known[places[again], i] for i in range(3))
            found[again] = log_a(r, log_c, b, np.floor(weights[again, None] / r + b))
            least = found.argmin(axis=0)
            value = found[least, every]
            r, _, b = (self.known[places[least], i, every] for i in range(3))
            steps = np.floor(weights[least] / r + b).astype(np.int64).astype(np.uint64)
            codes = mixed(self.hashes[places[least]] ^ (steps * np.uint64(0x9E3779B97F4A7C15)))
            better = value < best
            best[better] = value[better]
            kept[better] = (codes[better] >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
        return kept


def printed(coordinates: np.ndarray) -> str:
    return coordinates.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, fingerprint): eight hexadecimal digits for each coordinate of each whole text.

    A null text counts as empty; a text without a word is all zeros, so equal texts always have
    equal fingerprints. Null ids and repeated rows are kept; other columns are ignored. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sampler = Sampler(coordinates)
        for batch in batches:
            prints = [printed(sampler.sample(text or "")) for text in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "fingerprint": prints}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), task, FINGERPRINTED)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the head of the following text."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness: one row per document.

    The next document is the one of the next larger doc_id; after the last comes the first.
    Rows of equal doc_id follow each other by their compressed text, and null ids come first.
    Texts move once, compressed, to the range of their id; the first document of a range also
    goes to the range before it. A single document is its own next; an empty table gives no row.
    """
    spark = docs.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // ROWS_A_RANGE)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = np.unique(ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or [])

    def ranges_of(values: list) -> list[int]:
        return [0 if v is None else int(np.searchsorted(cuts, v, side="right")) for v in values]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            yield {"range": ranges_of(values), "doc_id": values}

    firsts = map_rows(ids, number, "range int, doc_id long").groupBy("range").agg(
        F.min("doc_id").alias("first"), F.count_if(F.isnull("doc_id")).alias("nulls")
    )
    filled = sorted((row["range"], None if row["nulls"] else row["first"]) for row in firsts.collect())
    before = {number: (filled[i - 1][0], first) for i, (number, first) in enumerate(filled)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            values = batch.column(0).to_pylist()
            for value, own, text in zip(values, ranges_of(values), batch.column(1).to_pylist(), strict=True):
                packed = press.compress((text or "").encode())
                rows.append((own, False, value, packed))
                previous, first = before[own]
                if value == first:
                    rows.append((previous, True, value, packed))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield dict(zip(("range", "tail", "doc_id", "packed"), map(list, columns), strict=True))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sampler, unpress = Sampler(), zstandard.ZstdDecompressor()
        last, done = None, False
        for batch in batches:
            out = []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                _, tail, value, packed = row
                if tail and done:
                    continue
                text = unpress.decompress(packed).decode()
                own = sampler.sample(text)
                if last is not None:
                    out.append(compared(sampler, *last, text, own))
                last, done = (value, text, own), tail
            columns = list(zip(*out, strict=True)) or [[]] * 7
            names = [part.split()[0] for part in PAIRED.split(", ")]
            yield dict(zip(names, map(list, columns), strict=True))

    dealt = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), deal, "range int, tail boolean, doc_id long, packed binary")
    placed = dealt.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", "tail", "doc_id", "packed")
    return map_rows(placed, pair, PAIRED)


def compared(sampler: Sampler, value, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = sampler.sample(changed)
    return (
        value,
        text,
        changed,
        printed(own),
        printed(other),
        float((own == other).mean()),
        float((own == theirs).mean()),
    )
