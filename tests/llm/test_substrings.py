from collections import defaultdict

import numpy as np
from cases import FILL, SCHEMA, sentence

from reelframe.llm import linking, substrings
from reelframe.llm.queries import LLM_QUERIES
from reelframe.llm.shingles import band_keys, circulant, texts_hashes, word_hashes, words_of


def repeated(texts, size):
    holders = defaultdict(set)
    for doc, text in texts.items():
        words = (text or "").lower().split()
        for i in range(len(words) - size + 1):
            holders[tuple(words[i : i + size])].add(doc)
    return {doc for docs in holders.values() if len(docs) > 1 for doc in docs}


def test_query_finds_long_repeats_and_no_others(spark):
    tables = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = LLM_QUERIES["op10_substrings"](spark, tables).collect()
    found = {r.doc_id for r in rows}
    assert repeated(texts, 51) <= found <= repeated(texts, substrings.LENGTH - 4)
    firsts = defaultdict(set)
    for r in rows:
        firsts[r.class_id].add((r.doc_id, r.removed))
    for docs in firsts.values():
        assert len({doc for doc, _ in docs}) > 1
        assert {doc for doc, removed in docs if not removed} == {min(doc for doc, _ in docs)}


def test_passages_anywhere_and_edited_ones(spark):
    rows, passages = [], [sentence(300 + i, 55) for i in range(40)]
    for i, passage in enumerate(passages):
        words = passage.split()
        words[27] = "changed"
        rows += [(3 * i, f"{sentence(i, 30)} {passage} {sentence(900 + i, 40)}")]
        rows += [(3 * i + 1, f"{sentence(500 + i, 17)} {passage.upper()}\n{sentence(600 + i, 9)}")]
        rows += [(3 * i + 2, f"{sentence(1500 + i, 160)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeats(docs).collect()
    assert {r.doc_id for r in found} == {i for i, _ in rows if i % 3 < 2}
    removed = [r for r in found if r.removed]
    assert {r.doc_id % 3 for r in removed} == {1}
    texts = dict(rows)
    for r in removed:
        words = texts[r.doc_id].lower().split()[r.start_word : r.end_word]
        assert " ".join(words[2:-2]) in passages[r.doc_id // 3]  # a similar one may reach two words out
        cut = substrings.without_repeats(texts[r.doc_id], [(r.start_word, r.end_word)])
        assert len(cut.split()) == len(texts[r.doc_id].split()) - substrings.LENGTH


def test_near_paragraphs_are_one_class(spark):
    words = sentence(77, 400).split()
    other = list(words)
    for i in range(20, 400, 60):
        other[i] = f"edit{i}"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    starts = {r.start_word for r in substrings.repeats(docs).where("removed").collect()}
    exact = {i for i in range(381) if words[i : i + 20] == other[i : i + 20]}
    assert starts & exact and starts - exact


def test_runs_of_periodic_words_are_found(spark):
    """Runs of 25 words and more, with periods of 1 to 12 and after different texts."""
    rows = []
    for period in range(1, 13):
        for size in (25, 51, 400):
            words = sentence(1000 * period + size, period).split()
            run = " ".join((words * size)[:size])
            at = 2 * len(rows)
            rows += [(at, f"{sentence(at + 3, 40)} {run}"), (at + 1, f"{sentence(at + 4, 23)} {run} {sentence(at + 5, 30)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = defaultdict(list)
    for r in substrings.repeats(docs).collect():
        places[r.doc_id].append((r.start_word, r.end_word))
    assert set(places) == {i for i, _ in rows}
    for i, text in rows[1::2]:
        size = len(text.split()) - 53
        covered = {at for start, end in places[i] for at in range(start, end)}
        assert set(range(23 + 5, 23 + size - 5)) <= covered


def test_no_long_repeat_of_the_larger_tables_is_missed(spark):
    tables = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    found = {r.doc_id for r in LLM_QUERIES["op10_substrings"](spark, tables).select("doc_id").distinct().collect()}
    assert repeated(texts, 51) - found == set()


def test_paragraphs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 2**63, (4000, 16)).astype(np.uint64)
    keys = []
    for _ in range(2):
        own = rng.integers(0, 2**63, (4000, 2)).astype(np.uint64)
        coordinates = circulant(np.concatenate([shared, own], axis=1), substrings.BANDS * substrings.ROWS)
        keys.append(band_keys(coordinates, substrings.ROWS))
    assert (keys[0] == keys[1]).any(1).mean() >= 0.95


def test_passages_with_an_edit_in_the_middle_are_found(spark):
    rows = []
    for i in range(150):
        size = (51, 55, 60)[i % 3]
        words = sentence(3000 + i, size).split()
        changed = [*words[: size // 2], f"edit{i}", *words[size // 2 + 1 :]]
        rows += [(2 * i, f"{sentence(4000 + i, 31)} {' '.join(words)} {sentence(5000 + i, 20)}")]
        rows += [(2 * i + 1, f"{sentence(6000 + i, 18)} {' '.join(changed)} {sentence(7000 + i, 33)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in substrings.repeats(docs).collect()} == {i for i, _ in rows}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = substrings.repeats(odd_docs).collect()
    assert {r.doc_id for r in rows} == {1, 9} and {r.doc_id for r in rows if r.removed} == {9}
    assert substrings.repeats(no_docs).collect() == []
    null = spark.createDataFrame([(None, sentence(1, 100), *FILL), (None, sentence(1, 100), *FILL)], SCHEMA)
    assert substrings.repeats(null).collect() == []
    assert substrings.without_repeats("", []) == "" and substrings.without_repeats("a  b c", [(0, 1), (0, 2)]) == " c"


def test_every_pair_at_the_threshold_is_linked(spark):
    """Paragraphs of 20 words that differ in their first word share 15 of 17 shingles: each such
    pair is a class, whether or not its MinHash bands would have met."""
    rows = []
    for i in range(40):
        words = sentence(2000 + i, substrings.LENGTH).split()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([f"first{i}", *words[1:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeats(docs).collect()
    classes = defaultdict(set)
    for r in found:
        classes[r.class_id].add(r.doc_id)
    assert sorted(map(sorted, classes.values())) == [[2 * i, 2 * i + 1] for i in range(40)]


def test_what_repeats_nowhere_is_not_kept(spark):
    """Paragraphs that share nothing with another text are left out before any is written; those that
    repeat, are shifted by a word, or repeat within one text as well, are all kept."""
    shared = sentence(8001, 60)
    twice = sentence(8003, 30)
    rows = [(i, sentence(8100 + i, 400)) for i in range(20)]
    rows += [(30, f"{sentence(8200, 200)} {shared}"), (31, f"{shared} {sentence(8201, 200)}")]
    rows += [(40, f"{twice} {sentence(8202, 50)} {twice}"), (41, f"{sentence(8203, 50)} {twice}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = substrings.keys_of(docs).groupBy("key").count().where("count > 1").select("key")
    kept = substrings.paragraphs(docs, substrings.table_of(substrings.stored(keys, "keys")))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {30, 31, 40, 41}
    places = defaultdict(set)
    for r in substrings.repeats(docs).collect():
        places[r.doc_id].add(r.start_word)
    assert set(places) == {30, 31, 40, 41}
    assert places[40] >= {at - 50 for at in places[41] if at >= 55} | {at + 30 for at in places[41] if at >= 55}


def test_links_by_runs_are_those_of_the_sets(spark):
    """Classes against brute force over all pairs of paragraphs, with texts that are plain, edited,
    rotated, and knotted by repeated words, at thresholds with and without links by runs."""
    texts = []
    for i in range(12):
        words = sentence(8300 + i, 45).split()
        texts += [words, [f"head{i}", *words[1:]], [*words[:20], "middle", *words[20:]], [*words[:-1], "tail"]]
        period = sentence(8400 + i, 3 + 2 * i).split()
        texts += [(period * 20)[:50], (period * 20)[2:40], [*(period * 20)[:24], "end"]]
        texts += [["a"] * 4 + words[:16], words[:1] + ["a"] * 4 + words[1:16], ["a"] * 5 + words[:15]]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert substrings.by_runs(80) and not substrings.by_runs(70) and not substrings.by_runs(90)
    for percent in (80, 70):
        found = substrings.paragraphs_of([text for _, text in rows], percent)
        places = list(zip(found.text.tolist(), found.start.tolist(), strict=True))
        sets = [frozenset(tuple(texts[t][s + k : s + k + 5]) for k in range(16)) for t, s in places]
        parent = list(range(len(places)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(places)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
        classes = defaultdict(set)
        for i, place in enumerate(places):
            classes[root(i)].add(place)
        wanted = {frozenset(c) for c in classes.values() if len({t for t, _ in c}) > 1}
        got = defaultdict(set)
        for r in substrings.repeats(docs, percent).collect():
            got[r.class_id].add((r.doc_id, r.start_word))
        assert {frozenset(c) for c in got.values()} == wanted


def test_words_hashed_at_once_are_hashed_alike():
    rng = np.random.default_rng(5)
    letters = list("abcXYZ09é日\x85\x1c")
    texts = [None, "", " \t\n ", " A\vb\fC\r\nd ", *[" ".join("".join(rng.choice(letters, n)) for n in rng.integers(0, 24, 60)) for _ in range(200)]]
    hashes, sizes = texts_hashes(texts)
    one_by_one = [word_hashes(words_of(text)) for text in texts]
    assert sizes.tolist() == [len(found) for found in one_by_one]
    assert (hashes == np.concatenate(one_by_one)).all()


def test_links_settled_at_once_and_by_rounds_are_one(spark, monkeypatch):
    rng = np.random.default_rng(6)
    pairs = [(int(a), int(a) + 1) for a in range(-60, 0)] + [(int(a), int(b)) for a, b in rng.integers(1, 400, (250, 2))]
    links = spark.createDataFrame(pairs, "a long, b long")
    at_once = sorted(linking.components(links).collect())
    monkeypatch.setattr(linking, "MOST_AT_ONCE", 0)
    assert at_once == sorted(linking.components(links).collect())
    assert linking.components(links.limit(0)).collect() == []
