import re

import pytest
from pyspark.sql import functions as F

from reelframe.llm import pii
from reelframe.llm.queries import LLM_QUERIES

# The patterns that define the base spans.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
        return 14 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def base_of(text):
    return sorted(
        (m.start(), rank, m.end())
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        # The definition's patterns take the square of a long run that no such mark follows.
        if re.search({"email": "@[A-Za-z0-9-]", "ip": "[0-9][.][0-9]"}.get(kind, ""), text or "")
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    )


TRICKY = [
    "a@b.c_d@e.f a@b@c.d .@x.y x@y x@y. x@y.z.",
    "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.255 1.2.3 1..2.3.4 00000000256.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4 111111111111111 5, 12 34 56 78 90 12 34 5",
    "9 4111111111111111 4111111111111111--4111111111111111 4111111111111111111111",
    "+1 (555) 010-9999 +12 +4-------------5 ++49 30 1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "é🙂 mail é.x@y.zé ok",
    "7" * 5000 + " " + "a" * 5000 + "@" + "b" * 50,
]


@pytest.fixture(scope="module")
def tricky(spark):
    return spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")


def test_base_spans_equal_the_definition(documents, tricky):
    nothing = pii.Scorer([], {})
    for docs in (documents.select("doc_id", "text"), tricky):
        for row in pii.find(docs, nothing).collect():
            assert [tuple(s) for s in row.base] == base_of(row.text), row.doc_id
            assert row.spans == row.base


def test_trees_add_likely_spans_and_keep_base_ones(spark):
    filler = "thorough words about nothing at all and more"
    rows = [(i, f'{filler} token = "{i:08x}9e31d0c2a57b46f8" then supercalifragilisticexpialidocious{i} end') for i in range(300)]
    rows.append((1000, 'the key: "00ffee9e31d0c2a57b46f8aa" and a.b@c.de from 10.0.0.1'))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scorer = pii.fit(docs)
    found = {r.doc_id: r for r in pii.find(docs, scorer).collect()}
    secret = pii.KINDS.index("secret")
    for i in range(300):
        text = rows[i][1]
        assert [text[s.start : s.end] for s in found[i].spans if s["rank"] == secret] == [f"{i:08x}9e31d0c2a57b46f8"]
    assert set(map(tuple, found[1000].base)) <= set(map(tuple, found[1000].spans))


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "write é a.b@c.de or +1 (555) 010-9999 now", 40, "x"), (2, None, None, "y"), (3, "none", 4, "z")],
        "doc_id long, text string, n_chars long, spans string",
    )
    got = {r.doc_id: r for r in pii.redact(docs, pii.Scorer([], {})).collect()}
    assert got[1].text == "write é [EMAIL] or [PHONE] now" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[3].text, got[3].n_chars, got[2].spans) == (None, "none", 4, "y")


def test_query_columns(spark, small_tables, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = LLM_QUERIES["op2_pii"](spark, small_tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = base_of(texts[row.doc_id])
        kinds = [rank for _, rank, _ in base]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds.count(rank) for rank in range(4)]
        names = [f"{list(PATTERNS)[rank]}:{start}:{end}" for start, rank, end in base]
        assert set(names) <= set(row.spans.split(","))


def test_plan_is_native(documents):
    plan = pii.find(documents, pii.Scorer([], {}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_odd_rows(odd_docs, no_docs):
    assert pii.find(odd_docs, pii.fit(odd_docs)).count() == odd_docs.count()
    found = pii.find(odd_docs, pii.Scorer([], {})).where("doc_id = 7").first()
    assert pii.KINDS[found.spans[0]["rank"]] == "email"
    assert pii.redact(odd_docs, pii.Scorer([], {})).columns == odd_docs.columns
    assert pii.find(no_docs, pii.fit(no_docs)).collect() == []
    assert pii.find(odd_docs.withColumn("text", F.lit(None).cast("string")), pii.Scorer([], {})).where("size(spans) > 0").count() == 0


#: What patterns repeat, many times over: each must cost linear time and no stack.
REPEATS = {
    "handle": "a [at] b" + " . c" * 50_000,
    "dots": "a (at) b" + " (dot) c" * 25_000,
    "no handle": "a [at] " * 28_000,
    "locals": "a.b-" * 50_000 + "@",
    "domains": "x@" + "a." * 100_000,
    "octets": "1." * 100_000,
    "digits": "7" * 200_000,
    "spaced digits": "7 " * 100_000,
    "spaced digits before a letter": "7 " * 100_000 + "x",
    "dashed digits": "(7) - " * 33_000,
    "phone": "+1" + " (" * 100_000 + "1",
    "pluses": "+1" * 100_000,
    "secret": "Ab0/" * 50_000,
    "blanks": " " * 200_000,
}


def test_long_repeats_end_no_executor(spark):
    taken = pii.Scorer([], {rank: 0.0 for rank in range(len(pii.BASE), len(pii.KINDS))})
    texts = dict(enumerate(REPEATS.values()))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for row in pii.find(docs, taken).collect():
        assert [tuple(s) for s in row.base] == base_of(texts[row.doc_id])
        spans = sorted((s.start, s.end) for s in row.spans if s["rank"] >= len(pii.BASE))
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    for row in pii.redact(docs, taken).collect():
        assert len(row.text) <= 2 * len(texts[row.doc_id])


def test_very_many_addresses_in_one_text(spark):
    """Far from the square of their number: as many matches in one text as other tables have rows."""
    text = " ".join(f"u{i}@h{i % 7}.de" for i in range(30_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.find(docs, pii.Scorer([], {})).first()
    assert [tuple(s) for s in row.base] == [(m.start(), 0, m.end()) for m in re.finditer(r"[^ ]+", text)]
    redacted = pii.redact(docs, pii.Scorer([], {})).first().text
    assert redacted == " ".join(["[EMAIL]"] * 30_000)


def test_long_candidates_are_whole(spark):
    numbers = " ".join(["12"] * 40)
    handle = "a" * 90 + " (at) " + "b" * 80 + " . " + "c" * 70
    key = "0f" * 300
    docs = spark.createDataFrame([(1, f"{numbers}; {handle}; {key}")], "doc_id long, text string")
    row = docs.select(pii.candidates(F.col("text")).alias("wide")).first()
    found = {(pii.KINDS[c["rank"]], c.found) for c in row.wide}
    assert {("number", numbers), ("handle", handle), ("secret", key)} <= found


def test_greedy_spans_against_a_plain_loop(spark):
    """Wide spans give way to base ones and to wide ones before them."""
    import random

    rng = random.Random(3)
    pieces = ["a@b.c", "x [at] y . z", "10.0.0.1", "555 123 4567 890", "0123456789abcdef0123456789", "and", "+1 555 010 99 99", ",", "12 34 56 78 90"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "", "-", ". "]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    taken = pii.Scorer([], {rank: 0.0 for rank in range(len(pii.BASE), len(pii.KINDS))})
    wide = docs.select("doc_id", pii.candidates(F.col("text")).alias("wide"))
    rows = pii.find(docs, taken).join(wide, "doc_id").collect()
    assert any(row.wide for row in rows)
    for row in rows:
        base = [tuple(s) for s in row.base]
        spans = [(c.start, c["rank"], c.end) for c in row.wide if not any(b[0] < c.end and c.start < b[2] for b in base)]
        at, wanted = 0, []
        for start, rank, end in sorted(base + spans):
            if rank < len(pii.BASE) or start >= at:
                wanted.append((start, rank, end))
                at = max(at, end)
        assert [tuple(s) for s in row.spans] == wanted


def test_the_sample_is_bounded_whatever_the_ids(spark):
    """Rows without ids, and copies of one text, neither fill the sample nor leave it empty."""
    rows = [(None, f"card {i}: 4111 1111 1111 1111 for {i:020x}") for i in range(2000)] + [(None, "copy 12 34 56 78 90")] * 4000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen = []
    real = pii.stored

    def counted(frame, label):
        found = real(frame, label)
        seen.append(found.count())
        return found

    pii.stored = counted
    try:
        pii.fit(docs, sample_documents=300)
    finally:
        pii.stored = real
    assert 20 < seen[0] < 1200


def test_the_trees_see_the_candidates_of_every_text(spark):
    """More texts than the old sample of 4,000: the candidates of all distinct texts are fitted on."""
    rows = [(i, f"call {i:07d} 555 01 23 or key {i:024x}") for i in range(6000)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    wanted = docs.select(F.sum(F.size(pii.candidates(F.col("text")))).alias("n")).first()["n"]
    seen = []
    real = pii.stored

    def counted(frame, label):
        found = real(frame, label)
        seen.append(found.count())
        return found

    pii.stored = counted
    try:
        pii.fit(docs)
    finally:
        pii.stored = real
    assert wanted >= 6000
    assert seen[0] == wanted
