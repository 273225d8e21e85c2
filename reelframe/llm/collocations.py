"""Phrases of two and three words that occur together more than by chance.

Words get numbers, and runs of two and three numbers are packed into keys of counting quotient
filters (``quotient``), one filter a task and language. Filters are cut into blocks, blocks of equal
leading bits are merged, and what is frequent enough is scored with ordinary joins.

Numbers: the most frequent words, as many as fit a bounded table, are numbered from 1 and sent to all
tasks. If every word that can be in a phrase is among them, other words end a phrase, like
punctuation. If not, other words go by 63 bits of a hash, and runs with such a word are counted in
wide filters of three columns. Words that share a hash, if any, get numbers of their own. So
counts are exact at any size of the vocabulary.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelframe.llm.quotient import CountingFilter
from reelframe.llm.workers import broadcast_if_small, map_rows, reach_package, stored
from reelframe.operators.ranking import row_index

#: Occurrences that make a run of words a candidate; percent of a candidate's occurrences inside a
#: longer one from which it is dropped; phrases returned for each language.
LEAST, COVERED, TOP = 10, 50, 2000
NO_LANGUAGE = "und"

#: Words in the table that is sent to all tasks, and the bytes of the longest: 32 MB at most.
MOST_KNOWN, LONGEST_KNOWN = 2**19, 64
#: Distinct words, words and filter entries that a task holds before it hands them on.
MOST_WORDS, CHUNK, MOST_ENTRIES = 2**20, 2**20, 2**22
#: Occurrences that the blocks merged by one task hold together, about.
BLOCK = 2**21
#: Words outside the table that a task remembers the hash of.
MOST_HASHED = 2**18
#: Parts in which phrases of a language are ranked before they meet.
SALTS = 64
#: Hash of words as Spark has it.
HASH_SEED, HASH_BIT = 42, -(2**63)

BREAK = b"."
BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", BREAK * 9)


def tokens(text: str | None) -> list[bytes]:
    """Words of a whole text with A-Z made small, and a full stop wherever a piece of it ends.

    After full stops have taken the place of all that ends a piece, only spaces and tabs are left
    of the bytes at which ``split`` cuts.
    """
    data = (text or "").encode().lower().translate(BREAKS)
    return data.replace(BREAK, b" . ").split()


def language_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["lang"].cast("string"), F.lit(NO_LANGUAGE))


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(language_of(docs).alias("lang"), docs["text"].cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of every word; words are bytes. Tasks count before anything is shuffled."""

    def rows(counts: dict[str, Counter]) -> dict:
        listed = [(lang, word, f) for lang, own in counts.items() for word, f in own.items() if word != BREAK]
        return dict(zip(("lang", "word", "f"), map(list, zip(*listed, strict=True)) if listed else ([], [], []), strict=True))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                counts[lang.as_py()].update(tokens(text.as_py()))
            if sum(map(len, counts.values())) > MOST_WORDS:
                yield rows(counts)
                counts.clear()
        yield rows(counts)

    found = map_rows(texts(docs), task, "lang string, word binary, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


class Lexicon(dict):
    """Numbers of words. Where some are missing, other words go by their hash, with the top bit set."""

    def __init__(self, known: list[bytes], shared: list[bytes], complete: bool):
        super().__init__(zip(known, range(1, len(known) + 1), strict=True))
        self.bits = max(len(known).bit_length(), 1)
        self.update(zip(shared, range(1 << self.bits, (1 << self.bits) + len(shared)), strict=True))
        self[BREAK] = 0
        self.complete = complete
        self.hashed: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        number = self.hashed.get(word)
        if number is None:
            if len(self.hashed) >= MOST_HASHED:
                self.hashed.clear()
            number = self.hashed[word] = xxhash.xxh64_intdigest(word, HASH_SEED) % 2**63 - 2**63
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        found = map(self.get, words, repeat(0)) if self.complete else map(self.__getitem__, words)
        return np.fromiter(found, np.int64, len(words))


def runs(numbers: np.ndarray, bits: int) -> Iterator[tuple[list[np.ndarray], int]]:
    """Keys of the runs of two and three words in a sequence of numbers, in which 0 ends a piece:
    packed into one column where all words are in the table, else in three columns."""
    a, b = numbers[:-1], numbers[1:]
    c = np.append(numbers[2:], 0)
    pair = (a != 0) & (b != 0)
    for kept, third in ((pair, np.zeros_like(c)), (pair & (c != 0), c)):
        x, y, z = (column[kept].view(np.uint64) for column in (a, b, third))
        narrow = (x | y | z) < np.uint64(1 << bits)
        yield [x[narrow] << np.uint64(2 * bits) | y[narrow] << np.uint64(bits) | z[narrow]], 3 * bits
        if not narrow.all():
            yield [x[~narrow], y[~narrow], z[~narrow]], 64


BLOCKS = "lang string, width int, block long, entries binary"


def filter_blocks(docs: DataFrame, words: tuple, prefixes: dict[str, int]) -> DataFrame:
    """(lang, width, block, entries): the filters of all tasks, cut into blocks."""
    spark = docs.sparkSession
    known, shared, complete = words
    sent = spark.sparkContext.broadcast((b" ".join(known), b" ".join(shared)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        lexicon = Lexicon(*(blob.split() for blob in sent.value), complete)
        waiting: dict[str, list[np.ndarray]] = defaultdict(list)
        shards: dict[tuple[str, int], CountingFilter] = {}
        held = 0

        def count() -> None:
            nonlocal held
            for lang, parts in waiting.items():
                for keys, bits in runs(np.concatenate(parts), lexicon.bits):
                    found = CountingFilter.of(keys, bits)
                    at = lang, len(keys)
                    shards[at] = CountingFilter.merged([shards[at], found]) if at in shards else found
            waiting.clear()
            held = 0

        def blocks() -> Iterator[dict]:
            for (lang, width), shard in shards.items():
                for block in shard.blocks(prefixes.get(lang, 0)):
                    yield {"lang": [lang], "width": [width], "block": [block.block], "entries": [block.to_bytes()]}
            shards.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                numbers = lexicon.numbers([*tokens(text.as_py()), BREAK])
                waiting[lang.as_py()].append(numbers)
                held += len(numbers)
                if held > CHUNK:
                    count()
                    if sum(map(len, shards.values())) > MOST_ENTRIES:
                        yield from blocks()
        count()
        yield from blocks()

    return map_rows(texts(docs), task, BLOCKS)


RUNS = "lang string, w1 long, w2 long, w3 long, f long"


def merged_runs(blocks: DataFrame, bits: int, least: int) -> DataFrame:
    """(lang, w1, w2, w3, f) of runs that occur so often; w3 is 0 in runs of two words.

    A task merges the blocks of all filters that have the same leading bits.
    """
    reach_package(blocks.sparkSession)

    def merge(group: pa.Table) -> pa.Table:
        whole = CountingFilter.merged([CountingFilter.from_bytes(data.as_py()) for data in group["entries"]]).over(least)
        keys = whole.keys()
        if len(keys) == 1:
            mask = np.uint64((1 << bits) - 1)
            keys = [keys[0] >> np.uint64(2 * bits), keys[0] >> np.uint64(bits) & mask, keys[0] & mask]
        columns = [column.view(np.int64) for column in keys] + [whole.counts.astype(np.int64)]
        names = pa.array([group["lang"][0].as_py()] * len(whole), pa.string())
        return pa.table([names, *map(pa.array, columns)], names=["lang", "w1", "w2", "w3", "f"])

    return blocks.groupBy("lang", "width", "block").applyInArrow(merge, RUNS)


def numbered_words(counts: DataFrame, least: int) -> tuple[DataFrame, tuple[list[bytes], list[bytes], bool]]:
    """(word, number) of all words that can be in a phrase, and what tasks need to number words."""
    words = counts.groupBy("word").agg(F.sum("f").alias("total"), F.max("f").alias("most"))
    words = stored(words.where(F.col("most") >= least).select("word", "total"), "words")
    level = F.floor(F.log2("total")).cast("int")
    fits = F.octet_length("word") <= LONGEST_KNOWN
    levels = dict(words.where(fits).groupBy(level.alias("level")).count().collect())  # 63 rows at most
    floor = max(levels, default=0) + 1
    while floor and sum(n for at, n in levels.items() if at >= floor - 1) <= MOST_KNOWN:
        floor -= 1
    ranked = row_index(words.where(fits & (level >= floor)).select("word"), [F.col("word")], "at")
    ranked = stored(ranked.select("word", (F.col("at") + 1).alias("number")), "known")
    known = ranked.orderBy("number").toArrow()["word"].to_pylist()  # MOST_KNOWN rows at most
    complete = words.count() == len(known)
    if complete:
        return ranked, (known, [], True)
    hashed = F.xxhash64("word").bitwiseOR(F.lit(HASH_BIT))
    others = counts.select("word").distinct().join(ranked, "word", "left_anti").withColumn("number", hashed)
    others = stored(others, "others")
    twice = others.groupBy("number").count().where("count > 1").select("number")
    shared = sorted(bytes(row.word) for row in others.join(twice, "number", "left_semi").limit(MOST_KNOWN + 1).collect())
    if len(shared) > MOST_KNOWN:
        raise ValueError("too many words share a hash")
    bits = max(len(known).bit_length(), 1)
    own = counts.sparkSession.createDataFrame(
        [(word, (1 << bits) + at) for at, word in enumerate(shared)], "word binary, number long"
    )
    rare = others.join(words.select("word"), "word", "left_semi").join(F.broadcast(own.select("word")), "word", "left_anti")
    return ranked.unionByName(rare).unionByName(own), (known, shared, False)


def strength(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) in decimals of 38 digits, which counts below 10^15 fit."""
    exact = {name: f"cast({name} as decimal(19,0))" for name in (a, left, right)}
    above = f"cast({exact[a]} * {exact[a]} as decimal(32,0)) * cast(1000000 as decimal(7,0))"
    return F.expr(f"cast({above} as decimal(38,0)) div ({exact[left]} * {exact[right]})")


def scored(grams: DataFrame, ones: DataFrame, covered: int) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score) of the candidates that are not covered by a longer one."""

    def single(at: str, name: str) -> DataFrame:
        return ones.select("lang", F.col("number").alias(at), F.col("f").alias(name))

    def double(first: str, second: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("f").alias(name))

    pairs = grams.where("w3 = 0").select("lang", "w1", "w2", "f")
    triples = grams.where("w3 <> 0")
    longer = triples.select("lang", "w1", "w2", "f").union(triples.select("lang", "w2", "w3", "f"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("f").alias("inside"))
    free = pairs.join(longer, ["lang", "w1", "w2"], "left").where(f"inside is null or 100 * inside < {covered} * f")
    two = free.join(single("w1", "l"), ["lang", "w1"]).join(single("w2", "r"), ["lang", "w2"])
    two = two.select("lang", "w1", "w2", F.lit(0).cast("long").alias("w3"), F.col("f").alias("a"), "l", "r")
    two = two.withColumn("score", strength("a", "l", "r"))
    three = triples.withColumnRenamed("f", "a")
    for part, keys in (
        (double("w2", "w3", "r1"), ["lang", "w2", "w3"]),
        (double("w1", "w2", "l2"), ["lang", "w1", "w2"]),
        (single("w1", "l1"), ["lang", "w1"]),
        (single("w3", "r2"), ["lang", "w3"]),
    ):
        three = three.join(part, keys)
    three = three.withColumns({"s1": strength("a", "l1", "r1"), "s2": strength("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    cut = {"l": ("l1", "l2"), "r": ("r1", "r2"), "score": ("s1", "s2")}
    chosen = [F.when(first, F.col(one)).otherwise(F.col(other)).alias(name) for name, (one, other) in cut.items()]
    return two.unionByName(three.select("lang", "w1", "w2", "w3", "a", *chosen))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language.

    A phrase is a run of two or three words within a piece; ``a`` counts its occurrences, overlapping
    ones too, ``l`` and ``r`` those of its two parts at the weakest cut, ``n`` all words of the
    language. Phrases of which a longer candidate holds ``covered`` percent are left out. A null
    text is empty; a null language is ``und``, as is a language of that name; every row counts, repeated ones
    too; other columns are ignored, whatever their names. Texts without words and empty tables give
    no rows. A text of any length is taken as a whole.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "counts")
    sizes = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    words, lexicon = numbered_words(counts, least)
    # Languages with more words than a block: so many at most as there are blocks.
    large = {row.lang: max((2 * row.n // BLOCK).bit_length(), 0) for row in sizes.where(F.col("n") > BLOCK).collect()}
    bits = max(len(lexicon[0]).bit_length(), 1)
    blocks = filter_blocks(docs, lexicon, {lang: min(prefix, 3 * bits) for lang, prefix in large.items()})
    grams = stored(merged_runs(blocks, bits, least), "runs")
    words = stored(words, "numbers")
    frequent = counts.where(F.col("f") >= least).join(words, "word").select("lang", "number", "f")
    ones = broadcast_if_small(stored(frequent, "ones"))
    found = scored(grams, ones, covered)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)))
    strongest = [F.col("score").desc(), F.col("a").desc()]
    tied = Window.partitionBy("lang", "salt").orderBy(*strongest)
    best = salted.withColumn("place", F.rank().over(tied)).where(F.col("place") <= top).drop("place")
    for at in ("w1", "w2", "w3"):
        named = words.select(F.col("number").alias(at), F.col("word").cast("string").alias(f"text_{at}"))
        best = best.join(named, at, "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "text_w1", "text_w2", "text_w3"))
    last = [*strongest, F.col("phrase")]
    for keys in (["lang", "salt"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*last)))
        best = best.where(F.col("rank") <= top)
    found = best.join(sizes, "lang")
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def as_sql(least: int = LEAST, covered: int = COVERED, top: int = TOP) -> str:
    """The same in SQL, over a table ``documents``: every run of words is listed and counted."""
    return rf"""
    WITH words AS MATERIALIZED (
      SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
        SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
        FROM documents)),
    runs AS (
      SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p
      FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
    f AS MATERIALIZED (SELECT lang, k, p, CAST(count(*) AS HUGEINT) AS f FROM runs GROUP BY lang, k, p HAVING count(*) >= {least}),
    sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    cuts AS (
      SELECT c.lang, c.k, c.p, c.f AS a, l.f AS l, r.f AS r, j, 1000000 * c.f * c.f // (l.f * r.f) AS score
      FROM (SELECT *, string_split(p, ' ') AS w, unnest(range(1, k)) AS j FROM f WHERE k > 1) AS c
      JOIN f AS l ON l.lang = c.lang AND l.p = array_to_string(w[:j], ' ')
      JOIN f AS r ON r.lang = c.lang AND r.p = array_to_string(w[j + 1:], ' ')),
    weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
    inside AS (
      SELECT lang, p, max(f) AS f FROM (
        SELECT lang, f, unnest([array_to_string(string_split(p, ' ')[:2], ' '), array_to_string(string_split(p, ' ')[2:], ' ')]) AS p
        FROM f WHERE k = 3) GROUP BY lang, p)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase,
           CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
           CAST(score AS BIGINT) AS score
    FROM weakest AS w JOIN sizes USING (lang)
    WHERE NOT EXISTS (SELECT 1 FROM inside AS i WHERE i.lang = w.lang AND i.p = w.p AND 100 * i.f >= {covered} * w.a)
    QUALIFY rank <= {top}
    """
