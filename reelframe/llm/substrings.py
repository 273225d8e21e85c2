"""Substring duplicates by shared runs of content-defined paragraphs.

Repeated passages seldom start where a line does, so a paragraph is ``LENGTH`` words that start
at an anchor: the least hash of any ``RADIUS`` + 1 words in a row, of equal ones the first. Two
copies of a passage have the same anchors inside, wherever they stand and however their words
repeat, so any shared run of ``LENGTH`` + ``RADIUS`` words holds a shared paragraph. Paragraphs of
equal words are one node; nodes of similar shingle sets are linked, and each component that spans
documents is a class of repeats.

Most links need no sets. Let no three words of a paragraph A occur in it twice. Its shingles are
then a path over its four words in a row, and a shingle that is not A's own touches that path with
one end at most. So where a similar paragraph B can have one such shingle only (``by_runs``), it is
B's first or last one, and A and B share the first or the last ``RUN`` words of each. The other
way round, a shared run without repeated three words makes them similar. Paragraphs with repeated
three words are knotted: among themselves they are keyed by the least n - ceil(s n) + 1 of their n
shingle hashes (two sets of Jaccard similarity s or more share the least element they have in
common, and it is among those of both) and compared on their whole shingle sets.

Texts are read twice, where they lie. The first time each run is known by the least hash of its
``GRAM`` words in a row, which hardly changes from one run to the next, and only keys are counted. The
second time paragraphs without a key that occurs again are left out: they repeat nowhere and
resemble nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.linking import components, crowded, link
from reelframe.llm.shingles import SHINGLE, P, mixed, shingle_hashes, texts_hashes
from reelframe.llm.workers import broadcast_if_small, map_rows, stored

PERCENT = 80
LENGTH = 20
RADIUS = 5
#: Words of a run that linked paragraphs share, of the pieces that it is known by, and those that
#: may not repeat in it; shingles of a paragraph.
RUN, GRAM, KNOT = LENGTH - 1, 8, 3
SHINGLES = LENGTH - SHINGLE + 1
#: Bands of MinHash coordinates that paragraphs were once keyed by; a changed paragraph at the
#: threshold shared one with probability 0.97 only, so no key is made of them any more.
BANDS, ROWS = 5, 3
#: Characters of texts that are read at once, one text at least.
AT_ONCE = 1 << 20
#: Bits in one piece of the table of repeated keys, and in all of it at most. A key has two of them; with
#: less than 16 bits a key more paragraphs are kept in vain, none is lost.
PIECE, MOST_BITS = 1 << 20, 1 << 30
#: Knotted paragraphs of a task whose sets are not written again.
KNOWN_SETS = 1 << 17

WORD = re.compile(r"[^ \t-\r]+")
NONE = ~np.uint64(0)

PARAGRAPHS = "doc_id long, start int, node long, low long, high long, h array<int>"


def by_runs(percent: int) -> bool:
    """Whether a paragraph without repeated three words is similar to just those that share a run."""
    sizes = np.arange(1, SHINGLES + 1)
    needed = -(-percent * (SHINGLES + sizes) // (100 + percent))
    others = (sizes - needed)[sizes >= needed]
    return bool((others <= 1).all()) and 100 * (SHINGLES - 1) >= percent * (SHINGLES + 1)


def anchors(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place in it of each word whose hash is the least of some window, the first of equal
    ones, from the word hashes of texts end to end and the number of words of each."""
    n = np.maximum(sizes - LENGTH + 1, 0)
    slots = np.where(n > 0, np.maximum(n, RADIUS + 1), 0)
    text = np.repeat(np.arange(len(sizes)), slots)
    place = np.arange(len(text)) - (np.cumsum(slots) - slots)[text]
    inside = place < n[text]
    padded = np.full(len(text), NONE)
    padded[inside] = mixed(hashes[((np.cumsum(sizes) - sizes)[text] + place)[inside]])
    windows = max(0, len(text) - RADIUS)
    least, chosen = padded[:windows].copy(), np.arange(windows)
    for k in range(1, RADIUS + 1):
        lower = np.flatnonzero(padded[k : k + windows] < least)
        least[lower] = padded[k + lower]
        chosen[lower] = lower + k
    whole = place[:windows] + RADIUS < slots[text[:windows]]
    found = np.zeros(len(text), bool)
    found[chosen[whole]] = True
    return text[found], place[found]


def sliding(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The least or largest of each ``width`` values in a row; fewer at the end."""
    found, reach = values.copy(), 1
    while reach < width:
        step = min(reach, width - reach)
        found[:-step] = pick(found[:-step], found[step:])
        reach += step
    return found


class Paragraphs(NamedTuple):
    """Paragraphs of some texts: the text of each, its first word there and in ``hashes``, the word
    hashes of all texts; whether it is knotted, and its ``RUN`` first and last words: whether these
    may link it (no three words repeat) and the keys they are known by."""

    text: np.ndarray
    start: np.ndarray
    at: np.ndarray
    hashes: np.ndarray
    knotted: np.ndarray
    linking: np.ndarray
    keys: np.ndarray

    def shingles(self, chosen: np.ndarray) -> np.ndarray:
        """Shingle hashes, as they are compared, of these paragraphs, sorted."""
        places = self.at[chosen][:, None] + np.arange(SHINGLES)
        return np.sort((shingle_hashes(self.hashes)[places] >> np.uint64(32)).astype(np.uint32), axis=1)

    def nodes(self, chosen: np.ndarray) -> np.ndarray:
        """Content hashes of these paragraphs."""
        at = self.at[chosen]
        content = np.full(len(at), np.uint64(LENGTH), np.uint64)
        for i in range(LENGTH):
            content = mixed(content * P + self.hashes[at + i])
        return content

    def runs(self) -> np.ndarray:
        """Content hashes of both runs of every paragraph."""
        pieces = shingle_hashes(self.hashes, GRAM)
        at = np.stack([self.at, self.at + 1])
        content = np.full(at.shape, np.uint64(RUN), np.uint64)
        for i in (0, GRAM, RUN - GRAM):
            content = mixed(content * P + pieces[at + i])
        return content


def paragraphs_of(texts: list[str | None], percent: int = PERCENT) -> Paragraphs:
    """The paragraphs of some texts."""
    hashes, sizes = texts_hashes(texts)
    text, start = anchors(hashes, sizes)
    at = (np.cumsum(sizes) - sizes)[text] + start
    if not len(at):
        return Paragraphs(text, start, at, hashes, np.zeros(0, bool), np.zeros((2, 0), bool), np.zeros((2, 0), np.uint64))
    both = np.stack([at, at + 1])
    if not by_runs(percent):
        return Paragraphs(text, start, at, hashes, np.ones(len(at), bool), np.zeros(both.shape, bool), np.zeros(both.shape, np.uint64))
    threes = shingle_hashes(hashes, KNOT)
    before = np.full(len(threes), -1)
    for k in range(LENGTH - KNOT, 0, -1):
        same = np.flatnonzero(threes[k:] == threes[:-k])
        before[same + k] = same
    knotted = sliding(np.maximum, before, LENGTH - KNOT + 1)[at] >= at
    linking = sliding(np.maximum, before, RUN - KNOT + 1)[both] < both
    keys = sliding(np.minimum, shingle_hashes(hashes, GRAM), RUN - GRAM + 1)[both]
    return Paragraphs(text, start, at, hashes, knotted, linking, keys)


def prefixes(shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted shingle hashes of each paragraph are its n distinct elements, and which
    its keys: the least n - ceil(percent n / 100) + 1. Any paragraph this similar to it shares one."""
    first = np.concatenate([np.ones((len(shingles), 1), bool), shingles[:, 1:] != shingles[:, :-1]], axis=1)
    n = first.sum(1)
    return first, first & (np.cumsum(first, 1) <= (n - (percent * n + 99) // 100 + 1)[:, None])


def knot_keys(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes as keys beside those of runs."""
    return mixed(shingles.astype(np.uint64) + P)


def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str | None]]]:
    """Ids and texts, ``AT_ONCE`` characters or one text at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held + len(text or "") > AT_ONCE and texts:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(value)
            texts.append(text)
            held += len(text or "")
    if texts:
        yield ids, texts


def keys_of(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key): what the paragraphs of every whole text are known by; a text has a key once, as far as
    it does not repeat itself."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, texts in at_once(batches):
            found = paragraphs_of(texts, percent)
            keys, text = found.keys.T[found.linking.T], np.repeat(found.text, 2)[found.linking.T.ravel()]
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
            knots = np.flatnonzero(found.knotted)
            shingles = found.shingles(knots)
            _, kept = prefixes(shingles, percent)
            owner = np.broadcast_to(found.text[knots][:, None], kept.shape)[kept].astype(np.uint64)
            tied = np.unique(owner << np.uint64(32) | shingles[kept])
            tied = knot_keys(tied & np.uint64(0xFFFFFFFF))
            yield {"key": np.concatenate([keys[fresh], tied]).view(np.int64)}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), task, "key long")


def bits_of(keys: np.ndarray, size: int) -> np.ndarray:
    """The two bits of each key in a table of ``size`` bits, a power of two."""
    scattered = mixed(keys * P)
    return np.stack([scattered, scattered >> np.uint64(34)]) & np.uint64(size - 1)


def table_of(keys: DataFrame) -> Broadcast:
    """A table of bits, two for each of the stored keys, made piece by piece and sent to all tasks."""
    size = PIECE
    wanted = 16 * keys.count()
    while size < min(wanted, MOST_BITS):
        size *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy().view(np.uint64), size).ravel().astype(np.int64)
            yield {"piece": bits // PIECE, "bit": bits % PIECE}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for one in np.unique(piece).tolist():
                made.setdefault(one, np.zeros(PIECE, bool))[bit[piece == one]] = True
        for one, bits in made.items():
            yield {"piece": [one], "bits": [np.packbits(bits, bitorder="little").tobytes()]}

    spread = map_rows(keys, places, "piece int, bit int").repartition("piece")
    table = np.zeros(size // 8, np.uint8)
    for row in map_rows(spread, pieces, "piece int, bits binary").collect():
        table[row.piece * (PIECE // 8) :][: PIECE // 8] = np.frombuffer(row.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(table)


def in_table(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which keys may be in a table of bits: all that are, and a few others."""
    bits = bits_of(keys, 8 * len(table))
    return ((table[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(0)


def related(chosen: np.ndarray, labels: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The chosen ones and all that share labels with them, directly or by others."""
    _, label, times = np.unique(labels, return_inverse=True, return_counts=True)
    several = times[label] > 1
    label, owners, before = label[several], owners[several], -1
    while before != (before := int(chosen.sum())):
        reached = np.zeros(len(times), bool)
        reached[label[chosen[owners]]] = True
        chosen = chosen.copy()
        chosen[owners[reached[label]]] = True
    return chosen


def paragraphs(docs: DataFrame, repeated: Broadcast, percent: int = PERCENT) -> DataFrame:
    """(doc_id, start, node, low, high, h): the paragraphs that share a key with another text, and those
    of their own text that may be tied to them. ``low`` and ``high`` are the runs that may link a
    paragraph; ``h`` is the shingle set of a knotted one, at least once for each node."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: set[int] = set()
        for ids, texts in at_once(batches):
            found = paragraphs_of(texts, percent)
            shared = found.linking & in_table(found.keys, repeated.value)
            knots = np.flatnonzero(found.knotted)
            shingles = found.shingles(knots)
            first, kept = prefixes(shingles, percent)
            chosen = shared.any(0)
            kept[kept] = in_table(knot_keys(shingles[kept]), repeated.value)
            chosen[knots] |= kept.any(1)
            if not chosen.any():
                continue
            runs, own = found.runs(), found.linking & ~shared
            # Knotted paragraphs of one text may be tied to each other.
            labels = np.concatenate([runs[own], mixed(found.text[knots].astype(np.uint64) + P)])
            owners = np.concatenate([np.nonzero(own)[1], knots])
            chosen = related(chosen, labels, owners)
            at = np.flatnonzero(chosen)
            nodes = found.nodes(at).view(np.int64)
            fresh, sizes = np.zeros(len(found.at), bool), np.zeros(len(found.at), np.int64)
            for i, node in zip(at[found.knotted[at]].tolist(), nodes[found.knotted[at]].tolist(), strict=True):
                if node not in known:
                    if len(known) >= KNOWN_SETS:
                        known.clear()
                    known.add(node)
                    fresh[i] = True
            sizes[knots] = first.sum(1)
            sets = shingles[first & fresh[knots][:, None]].view(np.int32)
            offsets = np.concatenate([[0], np.cumsum(np.where(fresh, sizes, 0)[at])]).astype(np.int32)
            low, high = (pa.array(runs[k][at].view(np.int64), mask=~found.linking[k][at]) for k in range(2))
            yield {
                "doc_id": np.array(ids, np.int64)[found.text[at]],
                "start": found.start[at].astype(np.int32),
                "node": nodes,
                "low": low,
                "high": high,
                "h": pa.ListArray.from_arrays(offsets, sets, mask=pa.array(~fresh[at])),
            }

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), task, PARAGRAPHS)


def run_links(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes that share a run, each tied to the least node that has it."""
    runs = nodes.select("node", F.explode(F.array("low", "high")).alias("run")).where("run is not null")
    ends = runs.groupBy("run").agg(F.min("node").alias("b"), F.max("node").alias("most"))
    ends = stored(ends.where("b < most").select("run", "b"), "runs")
    return runs.join(broadcast_if_small(ends), "run").where("node <> b").select(F.col("node").alias("a"), "b")


def knot_links(found: DataFrame, percent: int) -> DataFrame:
    """(a, b): knotted nodes of similar sets, each tied to the least of its component."""
    sets = found.where("h is not null").select(F.col("node").alias("id"), F.size("h").alias("n"), "h")
    sets = stored(sets.dropDuplicates(["id"]), "sets")
    prefix = F.expr(f"slice(h, 1, cast(n - ({percent} * n + 99) div 100 + 1 as int))")
    members = stored(crowded(sets.select(F.explode(prefix).alias("key"), "id", "n")), "members")
    return link(members, sets, percent).select(F.col("id").alias("a"), F.col("component").alias("b"))


def repeats(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, start_word, end_word, class_id, n_places, removed): paragraphs that repeat.

    One row for each paragraph whose class occurs in more than one document; documents without
    one have no row. ``class_id`` is the least node of the class. The class's copy in the
    least doc_id stays, the others are to be removed. Words are counted from 0, the end excluded.
    Null, empty and short texts have no paragraph; rows without doc_id are not compared; rows
    that repeat a doc_id count as one document. Other columns are ignored, whatever their names.
    """
    docs = docs.where(F.col("doc_id").isNotNull())
    keys = keys_of(docs, percent).groupBy("key").count().where("count > 1").select("key")
    repeated = table_of(stored(keys, "repeated-keys"))
    found = stored(paragraphs(docs, repeated, percent), "paragraphs")
    repeated.unpersist()
    nodes = found.groupBy("node").agg(
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"),
        F.count("*").alias("places"),
        F.max("low").alias("low"),
        F.max("high").alias("high"),
    )
    nodes = stored(nodes, "nodes")
    tied = components(run_links(nodes).union(knot_links(found, percent)))
    tied = tied.select(F.col("id").alias("node"), "component")
    tied = stored(tied.union(tied.select("component", "component").distinct()), "tied")
    classed = nodes.select("node", "first", "last", "places").join(broadcast_if_small(tied), "node", "left")
    classed = classed.where("component is not null or first < last")
    classed = classed.select("node", "first", "last", "places", F.coalesce("component", "node").alias("class_id"))
    spread = classed.groupBy("class_id").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("places").alias("n_places")
    )
    spread = spread.where("first < last").drop("last")
    classes = stored(classed.select("node", "class_id").join(spread, "class_id"), "classes")
    out = found.select("doc_id", "start", "node").join(broadcast_if_small(classes), "node")
    return out.select(
        "doc_id",
        F.col("start").alias("start_word"),
        (F.col("start") + LENGTH).alias("end_word"),
        "class_id",
        "n_places",
        (F.col("doc_id") != F.col("first")).alias("removed"),
    )


def without_repeats(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of these spans; white space around what stays is kept."""
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    kept, at = [], 0
    for start, end in sorted(spans):
        start, end = places[start][0], places[min(end, len(places)) - 1][1]
        kept.append(text[at : max(at, start)])
        at = max(at, end)
    return "".join([*kept, text[at:]])
