import numpy as np
from pyspark.sql import functions as F

from reelframe.llm import langid
from reelframe.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark, documents):
    tables = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = LLM_QUERIES["op3_language"](spark, tables).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_every_byte_is_in_a_window():
    for size in (0, 1, 255, 256, 257, 508, 509, 5000):
        data = bytes(np.arange(size) % 251 + 1)
        windows, sizes = langid.windows_of(data)
        assert sum(sizes) >= size and windows.shape[1] == langid.WINDOW
        rebuilt = bytes(windows[0][: sizes[0]]) + b"".join(bytes(w[langid.WINDOW - langid.STRIDE : s]) for w, s in zip(windows[1:], sizes[1:]))
        assert rebuilt == data


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    windows = np.concatenate([rng.integers(97, 105, (60, 256)), rng.integers(103, 111, (60, 256))]).astype(np.uint8)
    labels = np.repeat([0, 1], 60)
    network = langid.Network(["a", "b"])
    network.train(windows, labels, epochs=6)
    assert (network.probabilities(windows).argmax(1) == labels).mean() > 0.95


def test_odd_rows(odd_docs, no_docs, documents):
    network = langid.fit(documents)
    rows = langid.identify(odd_docs, network).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (2, 3, 4, 8)] == ["und"] * 4
    assert by_id[2].score == 0 and by_id[1].lang_pred in network.languages
    kept = langid.accepted(odd_docs, network)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 5, 6, 7, 9, 10, None}
    assert langid.fit(no_docs) is None
    assert {r.lang_pred for r in langid.identify(odd_docs, None).collect()} == {"und"}
    assert langid.identify(no_docs, network).collect() == []


def test_held_out_rows(spark):
    ids = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")
    import zlib

    got = {r.doc_id: r.h for r in ids.select("doc_id", langid.held_out(4, 2).alias("h")).collect()}
    assert got == {1: zlib.crc32(b"1") % 4 == 2, 2: zlib.crc32(b"2") % 4 == 2, None: False}
    assert ids.where(F.col("doc_id").isNotNull()).count() == 2


def plain_probabilities(network, window):
    """The forward pass of one window in plain loops, filter by filter and place by place."""
    import math

    places = langid.WINDOW - max(langid.WIDTHS) + 1
    hidden = []
    for unit in range(langid.FILTERS * len(langid.WIDTHS)):
        width = langid.WIDTHS[unit // langid.FILTERS]
        best = -math.inf
        for place in range(places):
            total = 0.0
            for k in range(width):
                for d in range(langid.DIMENSIONS):
                    total += float(network.embedding[window[place + k], d]) * float(network.filters[k * langid.DIMENSIONS + d, unit])
            best = max(best, total)
        hidden.append(max(best + float(network.bias[unit]), 0.0))
    scores = [sum(h * float(w) for h, w in zip(hidden, column)) + float(b) for column, b in zip(network.output.T, network.output_bias)]
    powers = [math.exp(score - max(scores)) for score in scores]
    return [p / sum(powers) for p in powers]


def test_forward_pass_against_plain_loops(documents):
    network = langid.fit(documents, sample_documents=40)
    windows = np.concatenate([langid.windows_of(r.text.encode())[0][:1] for r in documents.limit(3).collect()])
    for window, found in zip(windows, network.probabilities(windows)):
        assert np.allclose(found, plain_probabilities(network, window), atol=1e-4)


def test_a_step_goes_down_the_slope():
    """A first step of Adam is the sign of the gradient times the rate; the slope is measured by
    moving single parameters and taking the loss again."""
    rng = np.random.default_rng(2)
    windows = rng.integers(97, 122, (64, langid.WINDOW)).astype(np.uint8)
    labels = rng.integers(0, 3, 64)

    def loss(network):
        return -np.log(network.probabilities(windows)[np.arange(64), labels].astype(np.float64)).mean()

    network, moved = langid.Network(["a", "b", "c"]), langid.Network(["a", "b", "c"])
    moved.train(windows, labels, epochs=1)
    checked = 0
    for before, after in zip(network.parameters(), moved.parameters()):
        flat, step = before.reshape(-1), (after - before).reshape(-1)
        for at in rng.choice(np.flatnonzero(np.abs(step) > langid.RATE / 2), 5):
            old = flat[at]
            flat[at] = old + 2e-3
            up = loss(network)
            flat[at] = old - 2e-3
            down = loss(network)
            flat[at] = old
            if abs(up - down) > 1e-5:
                checked += 1
                assert np.sign(up - down) == -np.sign(step[at])
    assert checked > 8


def test_windows_are_drawn_from_all_over(spark):
    text = "".join(f"{i:06d}abcdefghij " for i in range(4000))
    rows = [(i, f"{i} " + text, "xx") for i in range(40)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = langid.drawn_windows(sample).collect()
    assert len(drawn) == 40 * langid.WINDOWS_A_TEXT
    numbers = sorted(int(bytes(r.window).split(b"abcdefghij ")[1][:6]) for r in drawn)
    assert numbers[0] < 400 and numbers[-1] > 3600


def test_copies_do_not_fill_the_sample(spark):
    rows = [(None, "the same text again and again", "xx")] * 3000 + [(i, f"another text number {i}", "xx") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    real = langid.drawn_windows
    langid.drawn_windows = lambda sample: seen.append(sample.count()) or real(sample)
    try:
        langid.fit(docs, sample_documents=200)
    finally:
        langid.drawn_windows = real
    assert 10 < seen[0] < 120
