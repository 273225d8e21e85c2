import random

import numpy as np

from reelframe.llm import toxicity
from reelframe.llm.queries import LLM_QUERIES

WORDS = [f"w{i}" for i in range(60)]


def test_pairs_are_learned_that_sums_miss():
    """Toxic if both or neither word is there: no additive weights can tell."""
    rng = random.Random(2)
    texts, labels = [], []
    for _ in range(3000):
        first, second = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(WORDS, 6) + ["insult"] * first + ["group"] * second
        texts.append(np.sort(toxicity.places(" ".join(words))))
        labels.append(float(first and second))
    machine = toxicity.Machine()
    machine.train(texts[:2400], np.array(labels[:2400]))
    offsets = np.cumsum([0, *map(len, texts[2400:])])
    found = machine.margins(np.concatenate(texts[2400:]), offsets) > 0
    assert (found == np.array(labels[2400:], bool)).mean() > 0.95
    i, g = (int(toxicity.places(w)[0]) for w in ("insult", "group"))
    assert machine.factors[i] @ machine.factors[g] > 0


def test_pairs_without_marginal_effect_are_learned():
    """Both words are in about 5 % of the texts, as often in clean as in toxic ones; only the pair tells."""
    rng = random.Random(6)
    texts, labels, paired = [], [], []
    for _ in range(12_000):
        drawn = rng.random()
        first, second = drawn < 0.05, 0.025 <= drawn < 0.075
        slur = not (first or second) and rng.random() < 0.5
        words = rng.sample(WORDS, 6) + ["insult"] * first + ["group"] * second + ["slur"] * slur
        texts.append(np.sort(toxicity.places(" ".join(words))))
        labels.append(float(slur or (first and second)))
        paired.append(first or second)
    machine = toxicity.Machine()
    machine.train(texts[:9000], np.array(labels[:9000]))
    held = [i for i in range(9000, 12_000) if paired[i]]
    offsets = np.cumsum([0, *(len(texts[i]) for i in held)])
    found = machine.margins(np.concatenate([texts[i] for i in held]), offsets) > 0
    assert (found == np.array([labels[i] for i in held], bool)).mean() > 0.9


def test_held_out_scores(spark):
    tables = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels"))
    rows = LLM_QUERIES["op4_toxicity"](spark, tables).join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id").collect()
    insults = "idiot moron clown stupid pathetic disgusting trash scum loser worthless".split()
    held = [r for r in rows if r.held_out]
    plain = [r for r in held if not any(w in r.text.lower() for w in insults)]
    several = [r for r in held if sum(w in r.text.lower() for w in insults) >= 2]
    assert sum(r.predicted for r in several) / len(several) > 0.8
    assert sum(r.predicted for r in plain if not r.toxic) / len(plain) < 0.01
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, None, 1), (2, 1, None), (5, 1, 0), (77, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit(odd_docs, labels)
    rows = toxicity.score(odd_docs, machine).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert all(0 <= r.score <= 1 for r in rows)
    empty = toxicity.fit(no_docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd_docs, empty).collect()} == {0.5}
    assert toxicity.score(no_docs, machine).collect() == []


def test_margins_against_plain_loops():
    """Every pair of terms by itself, where the operator uses squares of sums."""
    rng = np.random.default_rng(4)
    machine = toxicity.Machine()
    machine.intercept = 0.3
    machine.linear[:] = rng.normal(0, 1, len(machine.linear))
    machine.factors[:] = rng.normal(0, 1, machine.factors.shape)
    texts = [rng.choice(len(machine.linear), size, replace=False) for size in (0, 1, 2, 7, 30)]
    found = machine.margins(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    for terms, margin in zip(texts, found, strict=True):
        wanted = machine.intercept + sum(float(machine.linear[t]) for t in terms)
        for i, a in enumerate(terms):
            for b in terms[i + 1 :]:
                wanted += sum(float(x) * float(y) for x, y in zip(machine.factors[a], machine.factors[b], strict=True))
        assert abs(margin - wanted) < 1e-3 * max(1.0, abs(wanted))
