import re

from cases import sentence

from reelframe.llm import decontamination
from reelframe.llm.queries import LLM_QUERIES

words_of = re.compile(r"[^\W_]+").findall


def shingles(text):
    words = words_of((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items, percent=80):
    found = {}
    for doc, text in docs:
        own = shingles(text)
        for item, wanted in items:
            wanted = shingles(wanted)
            if wanted and 100 * len(wanted & own) >= percent * len(wanted):
                found[doc, item] = max(found.get((doc, item), 0), len(wanted & own))
    return found


def test_query_equals_brute_force(spark):
    tables = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    rows = LLM_QUERIES["op5_decontamination"](spark, tables).collect()
    assert {(r.doc_id, r.item_id): r.n_shared for r in rows} == brute(docs, items)
    assert len(rows) > 5 and all(r.containment >= 0.8 for r in rows)


def test_edits_around_the_threshold_in_long_documents(spark):
    items, docs = [], []
    for i, size in enumerate((14, 25, 60, 200)):
        words = sentence(40 + i, size).split()
        items.append((i, " ".join(words)))
        for edits in range(0, 14):
            changed = list(words)
            for e in range(edits):
                changed[(e * 11 + 3) % size] = f"edit{e}"
            docs.append((100 * i + edits, f"{sentence(90 + i, 3000)}\n{' '.join(changed).upper()}! {sentence(95, 50)}"))
    docs.append((900, sentence(40, 10)))
    items.append((9, "only four short words"))
    docs += [(901, "Only four, short words."), (902, "it has only four short words in it")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_shared for r in decontamination.contaminated(frame, benchmark).collect()}
    assert got == brute(docs, items)
    assert (901, 9) in got and (902, 9) not in got
    left = {r.doc_id for r in decontamination.decontaminated(frame, benchmark).collect()}
    assert left == {doc for doc, _ in docs} - {doc for doc, _ in got}


def test_plan_is_native(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = decontamination.contaminated(documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_odd_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame(
        [(1, sentence(1, 60)), (2, None), (3, ""), (None, sentence(2, 40)), (1, sentence(1, 60))], "item_id long, text string"
    )
    rows = decontamination.contaminated(odd_docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (9, 1), (None, None)}
    left = decontamination.decontaminated(odd_docs, benchmark)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5, 6, 7, 8, 10]
    assert decontamination.contaminated(no_docs, benchmark).collect() == []
    assert decontamination.contaminated(odd_docs, benchmark.limit(0)).collect() == []
    assert decontamination.decontaminated(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
