import hashlib
from collections import Counter

from cases import FILL, SCHEMA, sentence

from reelframe.llm import fingerprints
from reelframe.llm.queries import LLM_QUERIES


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_query_equals_brute_force(spark, small_tables, documents):
    texts = sorted((r.doc_id, r.text or "") for r in documents.collect())
    rows = {r.doc_id: r for r in LLM_QUERIES["op8_fingerprints"](spark, small_tables).collect()}
    assert len(rows) == len(texts)
    errors, prints = [], {}
    for i, (doc, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        size = len(text) // 4
        changed = text[: len(text) - size] + following[:size]
        row = rows[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors += [row.near_edited - jaccard(text, changed), row.near_next - jaccard(text, following)]
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
    assert abs(sum(errors) / len(errors)) < 0.01
    assert sum(e * e for e in errors) / len(errors) < 0.05**2
    alone = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(documents).collect()}
    assert alone == {doc: row.fingerprint for doc, row in rows.items()}


def test_collisions_follow_weights():
    a = " ".join(["x"] * 30 + ["y"] * 10)
    b = " ".join(["x"] * 10 + ["y"] * 10 + ["z"] * 10)
    sampler = fingerprints.Sampler(2000)
    assert abs((sampler.sample(a) == sampler.sample(b)).mean() - jaccard(a, b)) < 0.04


def test_memory_of_words_changes_nothing(monkeypatch):
    text = sentence(3, 900)
    whole = fingerprints.Sampler().sample(text)
    monkeypatch.setattr(fingerprints, "KNOWN_WORDS", 150)
    monkeypatch.setattr(fingerprints, "WORDS_AT_ONCE", 100)
    small = fingerprints.Sampler()
    assert (small.sample(sentence(4, 300)) != whole).any()
    assert (small.sample(text) == whole).all()


def test_odd_rows(spark, odd_docs, no_docs):
    for ranges in (1, 2, 7):
        rows = fingerprints.with_next(odd_docs, ranges).collect()
        assert len(rows) == odd_docs.count()
        by_id = {r.doc_id: r for r in rows}
        assert by_id[2].text == by_id[3].text == "" and by_id[2].near_next == 1.0
        assert by_id[8].edited == "12345 !!! " + sentence(1, 120)[:3]
        assert by_id[6].edited == "x" * 150_000 + by_id[7].text
    assert fingerprints.with_next(no_docs).collect() == []
    one = spark.createDataFrame([(5, sentence(1, 40), *FILL)], SCHEMA)
    row = fingerprints.with_next(one, 4).first()
    size = len(row.text) // 4
    assert row.near_next == 1.0 and row.edited == row.text[: len(row.text) - size] + row.text[:size]
    assert fingerprints.fingerprint(odd_docs).count() == odd_docs.count()
