"""License scans by a positional index of rare words.

Every template is indexed under its rarest words, by how few documents of the corpus hold them.
A document's rare license words are looked up; each proposes where a template would start, the
postings of a template's other rare words must agree on the start, and the key phrases must
stand at their places in the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows

# Phrases whose every place is reported, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of public licenses, their labels, and the phrases that must be there.
TEMPLATES = [
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("cc-by-nc", "licensed under cc by nc", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd", ["cc by nd"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ["hereby granted free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification", ["source and binary forms"]),
    ("mpl", "mozilla public license", ["mozilla public license"]),
    ("epl", "eclipse public license", ["eclipse public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ["copy modify and or distribute"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]
#: Rarest words of a template that are indexed, and the share of its words that must be in place.
ANCHORS = 3
LEAST_SHARE = 0.6

#: Everything but digits, small letters and bytes beyond ASCII separates words; capitals become small.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, score double"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def vocabulary() -> list[str]:
    phrases = [*BASE, *(text for _, text, _ in TEMPLATES)]
    return sorted({word for phrase in phrases for word in phrase.split()})


def document_counts(docs: DataFrame) -> dict[str, int]:
    """In how many documents of the whole table each license word occurs; a fixed list of words."""
    listed = {word.encode() for word in vocabulary()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(listed.intersection(words_of(text)))
        yield {"word": [word.decode() for word in counts], "n": list(counts.values())}

    rows = map_rows(docs.select("text"), task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row["word"]: row["n"] for row in rows.collect()}


class Index:
    """Postings of rare words: word -> (template, place of the word in it)."""

    def __init__(self, counts: dict[str, int]):
        self.templates: list[tuple[str, list[bytes], list[tuple[int, list[bytes]]], bool]] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.anchors: list[list[tuple[int, bytes]]] = []
        for label, text, keys, strict in [
            *((label, phrase, [phrase], True) for phrase, label in BASE.items()),
            *((label, text, keys, False) for label, text, keys in TEMPLATES),
        ]:
            words = text.split()
            rare = sorted(range(len(words)), key=lambda i: (counts.get(words[i], 0), i))[:ANCHORS]
            spelled = [word.encode() for word in words]
            phrases = [(self._place(words, key.split()), [word.encode() for word in key.split()]) for key in keys]
            number = len(self.templates)
            self.templates.append((label, spelled, phrases, strict))
            self.anchors.append([(i, spelled[i]) for i in rare])
            self.postings.setdefault(spelled[rare[0]], []).append((number, rare[0]))

    @staticmethod
    def _place(words: list[str], phrase: list[str]) -> int:
        return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Starts of base phrases, their labels, all labels, and the best template's share."""
        starts, base, labels, score = [], set(), set(), 0.0
        postings, size = self.postings, len(words)
        for at, word in enumerate(words):
            if word not in postings:
                continue
            for number, place in postings[word]:
                start = at - place
                label, spelled, phrases, strict = self.templates[number]
                agreed = all(0 <= start + i < size and words[start + i] == rare for i, rare in self.anchors[number])
                if not agreed or not all(start + i >= 0 and words[start + i : start + i + len(key)] == key for i, key in phrases):
                    continue
                inside = sum(0 <= start + i < size and words[start + i] == w for i, w in enumerate(spelled))
                share = inside / len(spelled)
                if strict:
                    starts.append(start)
                    base.add(label)
                if strict or share >= LEAST_SHARE:
                    labels.add(label)
                    score = max(score, share)
        return starts, base, labels, score


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per document.

    ``score`` is the share of the best template's words that stand at their places, 0 without a
    label. A null or empty text has no words and no labels. Null ids and repeated rows are kept;
    other columns are ignored, whatever their names. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [part.split()[0] for part in SCANNED.split(", ")]
        for batch in batches:
            rows = []
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                starts, base, labels, score = index.scan(words)
                ends = (min(starts), max(starts)) if starts else (None, None)
                rows.append((value, len(words), len(starts), *ends, sorted(base), sorted(base | labels), score))
            yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), task, SCANNED)
