import re

from reelframe.llm import licenses
from reelframe.llm.queries import LLM_QUERIES

words_of = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words, starts, labels = words_of(lowered(text)), [], set()
    for phrase, label in licenses.BASE.items():
        spelled = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(spelled)] == spelled:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_query_equals_brute_force(spark):
    tables = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = LLM_QUERIES["op9_licenses"](spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any("apache-2" in r.labels for r in rows)


TEXTS = [
    "Licensed under the Apache License, Version 2.0; CC-BY CC BY cc\nby",
    "ÄMIT License MIT license mit   LICENSE GNU General Public Licenses",
    "Redistribution and use in source and binary forms, with or without modification",
    "Redistribution and use in source or binary forms, with or without modification",
    "mozilla public", "license mit", "mit mit license license", "gnu gnu general public license",
]


def test_templates_and_edges(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for counts in ({}, {"license": 10**6, "mit": 10**7, "cc": 10**8, "gnu": 10**9}):
        rows = {r.doc_id: r for r in licenses.scan(docs, licenses.Index(counts)).collect()}
        for i, text in enumerate(TEXTS):
            r = rows[i]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) == brute(text)
        assert rows[0].labels == ["apache", "apache-2", "cc-by"] and rows[0].score == 1.0
        assert rows[2].labels == ["bsd"] and rows[3].labels == [] and rows[4].score == 0


def test_odd_rows(odd_docs, no_docs):
    index = licenses.Index(licenses.document_counts(odd_docs))
    rows = licenses.scan(odd_docs, index).collect()
    assert len(rows) == odd_docs.count()
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert licenses.scan(no_docs, licenses.Index(licenses.document_counts(no_docs))).collect() == []
