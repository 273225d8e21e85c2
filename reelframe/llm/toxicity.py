"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum of w[i] + sum over pairs i < j of v[i] . v[j]) over the distinct terms of
a text: the pair part learns that two terms together mean more than their sum. It costs no
more than the linear part, as the sum over pairs is (|sum of v|^2 - sum of |v|^2) / 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.langid import held_out
from reelframe.llm.workers import map_rows

BUCKETS = 1 << 18
FACTORS = 4
#: Most labelled documents the machine is fitted on, in expectation; terms in fewer of them than this stay at 0.
SAMPLE_DOCUMENTS = 16_000
LEAST_DOCUMENTS = 5
#: A term is learned if it is frequent, or if its chi-squared with the label is beyond chance
#: among all terms, or among the texts that hold some other term beyond chance among all pairs;
#: the others stay at 0, so that copies of a text can't be learned by heart.
FREQUENT, ASSOCIATED, ASSOCIATED_IN_PAIRS = 0.3, 25.0, 45.0
EPOCHS = 15
RATE = 0.15
SHRINK_LINEAR, SHRINK_PAIRS = 1e-5, 1e-3
KNOWN_WORDS = 1 << 19

SCORED = "doc_id long, score double"

words_of = re.compile(r"[^\W_]+").findall


class Terms(dict):
    """Hashed place of a word, kept as long as few are known."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        place = self[word] = xxhash.xxh3_64_intdigest(word.encode()) % BUCKETS
        return place


terms = Terms()


def places(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a whole text, case folded."""
    found = set(words_of((text or "").lower()))
    return np.fromiter({terms[word] for word in found}, np.int32)


def chi_squared(seen: np.ndarray, both: np.ndarray, n: int, ones: float) -> np.ndarray:
    """Of terms in ``seen`` of n texts, and in ``both`` of the ``ones`` that are labelled 1."""
    gap = both * n - seen * ones
    spread = np.maximum(seen * (n - seen) * ones * (n - ones), 1.0)
    return n * gap**2 / spread


def worth_learning(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Which hashed terms the machine learns, by their counts in all texts and in those labelled 1."""
    n, ones = len(texts), float(labels.sum())
    flat, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    seen = np.bincount(flat, minlength=BUCKETS).astype(float)
    both = np.bincount(flat, np.repeat(labels, sizes), minlength=BUCKETS)
    known = seen >= LEAST_DOCUMENTS
    learned = known & ((seen >= FREQUENT * n) | (chi_squared(seen, both, n, ones) >= ASSOCIATED))
    numbers = np.flatnonzero(known)
    learned[numbers[in_pairs([np.searchsorted(numbers, t[known[t]]) for t in texts], labels, len(numbers))]] = True
    return learned


def in_pairs(texts: list[np.ndarray], labels: np.ndarray, terms: int) -> np.ndarray:
    """Which of the numbered terms tell the label among the texts that hold some other term. Every
    pair is tested; chi-squared is at most the number of texts, so terms in fewer have none."""
    flat, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    holders = np.repeat(np.arange(len(texts)), sizes)[np.argsort(flat, kind="stable")]
    ends = np.cumsum(np.bincount(flat, minlength=terms))
    found = np.zeros(terms, bool)
    if not terms:
        return found
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        n, own = end - start, labels[holders[start:end]]
        if n < ASSOCIATED_IN_PAIRS or not 0 < own.sum() < n:
            continue
        chosen = holders[start:end]
        held = np.concatenate([texts[i] for i in chosen])
        seen = np.bincount(held, minlength=terms).astype(float)
        both = np.bincount(held, np.repeat(own, sizes[chosen]), minlength=terms)
        found |= (seen >= LEAST_DOCUMENTS) & (chi_squared(seen, both, n, float(own.sum())) >= ASSOCIATED_IN_PAIRS)
    return found


class Machine:
    def __init__(self):
        self.intercept = 0.0
        self.linear = np.zeros(BUCKETS, np.float32)
        self.factors = np.zeros((BUCKETS, FACTORS), np.float32)

    def margins(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of texts whose terms lie end to end in ``flat``."""
        total = np.zeros((len(offsets) - 1, 1 + 2 * FACTORS), np.float64)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            v = self.factors[flat]
            parts = np.concatenate([self.linear[flat][:, None], v, v * v], axis=1)
            total[full] = np.add.reduceat(parts, offsets[full], axis=0)
        pairs = (total[:, 1 : 1 + FACTORS] ** 2 - total[:, 1 + FACTORS :]).sum(1) / 2
        return self.intercept + total[:, 0] + pairs

    def train(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> None:
        """Adagrad on the log loss in batches, over the terms worth learning."""
        rng = np.random.default_rng(seed)
        learned = worth_learning(texts, labels)
        texts = [t[learned[t]] for t in texts]
        base = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
        self.intercept = float(np.log(base / (1 - base)))
        self.factors[learned] = rng.normal(0, 0.01, (int(learned.sum()), FACTORS))
        grown, grown_pairs = np.full(BUCKETS, 1e-2, np.float32), np.full((BUCKETS, FACTORS), 1e-2, np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), 64):
                chosen = [texts[i] for i in order[at : at + 64]]
                offsets = np.cumsum([0, *map(len, chosen)])
                flat = np.concatenate(chosen)
                if not len(flat):
                    continue
                error = 1 / (1 + np.exp(-self.margins(flat, offsets))) - labels[order[at : at + 64]]
                owner = np.repeat(np.arange(len(chosen)), np.diff(offsets))
                used, inverse = np.unique(flat, return_inverse=True)
                slope = np.bincount(inverse, error[owner]) + SHRINK_LINEAR * 64 * self.linear[used]
                v = self.factors[flat]
                sums = np.stack([np.bincount(owner, v[:, f], len(chosen)) for f in range(FACTORS)], 1)
                each = error[owner][:, None] * (sums[owner] - v)
                slopes = np.stack([np.bincount(inverse, each[:, f]) for f in range(FACTORS)], 1)
                slopes += SHRINK_PAIRS * 64 * self.factors[used]
                grown[used] += slope**2
                grown_pairs[used] += slopes**2
                self.linear[used] -= RATE * slope / np.sqrt(grown[used])
                self.factors[used] -= 0.1 * RATE * slopes / np.sqrt(grown_pairs[used])
                self.intercept -= 0.01 * float(error.mean())


def fit(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Machine:
    """A machine fitted on about ``sample_documents`` rows of ``labels`` (doc_id, toxic), chosen
    by a hash, with the texts of their documents. Null labels are left out; a label without a
    document too. Without any row the machine scores everything 0.5 and nothing is learned."""
    labels = labels.where(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("double").alias("toxic"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = min(1.0, sample_documents / max(labels.count(), 1))
    sample = labels.where(part < share).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [np.sort(places(text)) for text in batch.column(2).to_pylist()]
            yield {"doc_id": batch.column(0), "toxic": batch.column(1), "places": found}

    rows = map_rows(joined.select(F.col("doc_id").cast("long"), "toxic", "text"), task, "doc_id long, toxic double, places array<int>")
    rows = sorted(rows.collect(), key=lambda row: (row["doc_id"], row["places"]))
    machine = Machine()
    if rows:
        machine.train([np.array(row["places"], np.int32) for row in rows], np.array([row["toxic"] for row in rows]))
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score): the probability that each whole text is toxic.

    A null or empty text gets the score of the intercept alone. Null ids and repeated rows are
    kept as they are; other columns are ignored, whatever their names. No shuffle; the machine
    goes to the tasks as one broadcast of fixed size.
    """
    model = docs.sparkSession.sparkContext.broadcast((machine.intercept, machine.linear, machine.factors))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = Machine.__new__(Machine)
        own.intercept, own.linear, own.factors = model.value
        for batch in batches:
            found = [places(text) for text in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            margins = np.clip(own.margins(flat, offsets), -40, 40)
            yield {"doc_id": batch.column(0), "score": 1 / (1 + np.exp(-margins))}

    return map_rows(docs.select(docs["doc_id"].cast("long"), "text"), task, SCORED)


__all__ = ["Machine", "fit", "held_out", "places", "score"]
