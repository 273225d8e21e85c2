import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from cases import FILL, SCHEMA
from pyspark.sql import functions as F

from reelframe.llm import collocations
from reelframe.llm.queries import LLM_ORACLES, LLM_QUERIES
from reelframe.llm.quotient import CountingFilter, permuted, restored


def brute(docs, least=10, covered=50, top=2000):
    """All runs listed, cuts and covers tried one by one."""
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    rows = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    inside[part] = max(inside[part], a)
        found = []
        for p, a in candidates.items():
            if inside[p] and 100 * inside[p] >= covered * a:
                continue
            cuts = [(1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(rows)


def frame(spark, docs):
    rows = [(i, text, lang, *FILL[1:]) for i, (lang, text) in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def some_docs(seed, count=500):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Ä", "É", "new", "York", "\x00", "日本", " ", "x" * 80]
    joins = [" "] * 12 + ["\t", ". ", ",", "\n", "  ", "!", "\r", "\x0b", "\x85"]
    docs = []
    for _ in range(count):
        text = "".join(words[min(int(rng.expovariate(0.2)), len(words) - 1)] + rng.choice(joins) for _ in range(rng.randint(0, 60)))
        docs.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return docs


def results(found):
    return sorted(map(tuple, found.collect()))


def test_against_brute_force(spark):
    docs = some_docs(1)
    found = results(collocations.collocations(frame(spark, docs)))
    assert found == brute(docs) and len(found) > 80


def test_ties_at_the_last_place(spark):
    docs = [("en", f"a{i % 40} b{i % 40}") for i in range(480)]
    assert results(collocations.collocations(frame(spark, docs), top=7)) == brute(docs, top=7)


@pytest.mark.parametrize("most", [0, 9])
def test_words_beyond_the_table(spark, monkeypatch, most):
    """Hashed words, wide filters and many blocks give the same phrases."""
    docs = some_docs(2)
    monkeypatch.setattr(collocations, "MOST_KNOWN", most)
    monkeypatch.setattr(collocations, "BLOCK", 64)
    monkeypatch.setattr(collocations, "CHUNK", 200)
    monkeypatch.setattr(collocations, "MOST_ENTRIES", 300)
    counts = collocations.word_counts(frame(spark, docs))
    if most == 0:
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(collocations, "MOST_KNOWN", 10**6)
            assert collocations.numbered_words(counts, 10)[1][2]
    assert not collocations.numbered_words(counts, 10)[1][2]
    assert results(collocations.collocations(frame(spark, docs))) == brute(docs)


def test_words_that_share_a_hash(spark, monkeypatch):
    """With hashes of few values words share them all the time; they get numbers of their own."""
    docs = some_docs(3)
    monkeypatch.setattr(collocations, "LONGEST_KNOWN", 2)
    known = [b"w1", b"w2"]
    lexicon = collocations.Lexicon(known, [b"w11", b"w12"], complete=False)
    numbers = lexicon.numbers([b"w1", b"w11", b"w12", b"other", b"."])
    assert numbers[0] == 1 and numbers[1] != numbers[2] and min(numbers[1:3]) > 3 and numbers[3] < 0 and numbers[4] == 0
    assert results(collocations.collocations(frame(spark, docs))) == brute(docs)


def test_hash_is_that_of_spark(spark):
    words = ["", "a", "日本語", "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", F.xxhash64(F.col("w").cast("binary")).bitwiseOR(F.lit(collocations.HASH_BIT)).alias("h")
    )
    for row in rows.collect():
        assert row.h == xxhash.xxh64_intdigest(row.w.encode(), collocations.HASH_SEED) % 2**63 - 2**63


def test_one_language_holds_nearly_all(spark):
    docs = [("en", "the cat sat on the mat. the cat ran")] * 600 + some_docs(4, 40)
    assert results(collocations.collocations(frame(spark, docs))) == brute(docs)


def test_large_counts_score_exactly(spark):
    a, left, right = 10**13 - 1, 10**13 + 7, 10**13
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(collocations.strength("a", "l", "r")).first()[0] == 1000000 * a * a // (left * right)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.lang, r.text) for r in odd_docs.collect()]
    assert results(collocations.collocations(odd_docs, least=3)) == brute(docs, least=3)
    assert collocations.collocations(no_docs).collect() == []


def test_query_equals_sql_and_brute_force(spark, small_tables, documents):
    found = LLM_QUERIES["op12_collocations"](spark, small_tables)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_tables}/documents.parquet'")
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({LLM_ORACLES['op12_collocations']})").fetchall()
    assert results(found) == sorted(wanted) == brute([(r.lang, r.text) for r in documents.collect()])


@pytest.mark.parametrize("columns,bits", [(1, 5), (1, 54), (1, 63), (3, 64)])
def test_filters(columns, bits):
    rng = np.random.default_rng(3)
    keys = [rng.integers(0, 2**min(bits, 4), 4000).astype(np.uint64) << np.uint64(max(bits - 5, 0)) for _ in range(columns)]
    assert all((a == b).all() for a, b in zip(restored(permuted(keys, bits), bits), keys, strict=True))
    wanted = Counter(zip(*(key.tolist() for key in keys), strict=True))
    shards = [CountingFilter.of([key[i::3] for key in keys], bits) for i in range(3)]
    blocks = [CountingFilter.from_bytes(block.to_bytes()) for shard in shards for block in shard.blocks(2)]
    by_block = defaultdict(list)
    for block in blocks:
        by_block[block.block].append(block)
    counted = {}
    for parts in by_block.values():
        whole = CountingFilter.merged(parts)
        counted |= dict(zip(zip(*(key.tolist() for key in whole.keys()), strict=True), whole.counts.tolist(), strict=True))
    assert counted == dict(wanted)
    whole = CountingFilter.merged(shards)
    key, seen = next(iter(wanted.items()))
    assert whole.count(list(key)) == seen and whole.count([1] * columns) == wanted[(1,) * columns]
    assert len(whole.over(10**6)) == 0 and CountingFilter.from_bytes(whole.to_bytes()).counts.tolist() == whole.counts.tolist()


def test_large_counters_and_long_runs():
    """Counters and runs beyond a byte."""
    big = CountingFilter.of([np.repeat(np.arange(3, dtype=np.uint64), [1, 254, 70_000])], 12)
    assert sorted(CountingFilter.from_bytes(big.to_bytes()).counts.tolist()) == [1, 254, 70_000]
    column = np.arange(1000, dtype=np.uint64)
    run = CountingFilter([column], np.ones(1000, np.uint64), 40)
    back = CountingFilter.from_bytes(run.to_bytes())
    assert (back.columns[0] == column).all()
    assert CountingFilter.from_bytes(CountingFilter([column[:0]], column[:0], 40).to_bytes()).counts.tolist() == []
