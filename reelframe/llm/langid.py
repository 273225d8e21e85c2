"""Language by a byte convolutional network, trained in numpy and applied to windows.

A text is cut into windows of ``WINDOW`` bytes that overlap by the widest filter, so that every
byte and every byte sequence up to that width is read. Each window goes through an embedding of
bytes, filters of several widths, max pooling over the window and a softmax; the text's answer
is the mean of its windows' probabilities, weighted by their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows, reach_package, small

WIDTHS = (2, 3, 4, 5)
FILTERS = 8
DIMENSIONS = 8
WINDOW = 256
STRIDE = WINDOW - max(WIDTHS) + 1
#: Windows that go through the network at once in a task: bounds its memory.
BATCH = 128
#: Most labelled documents that the network is fitted on, in expectation, and the windows that are
#: drawn from all over each of their texts.
SAMPLE_DOCUMENTS = 4_000
WINDOWS_A_TEXT = 3
EPOCHS = 8
RATE = 0.01
UNKNOWN = "und"

PREDICTED = "doc_id long, lang_pred string, score double"


class Network:
    """Filters of all widths are one matrix over the widest window, masked beyond their width."""

    def __init__(self, languages: list[str], rejecting: bool = False, seed: int = 5):
        """With ``rejecting`` there is one more class, the last, of what is no learned language."""
        rng = np.random.default_rng(seed)
        width, units, classes = max(WIDTHS), FILTERS * len(WIDTHS), len(languages) + rejecting
        self.languages, self.rejecting = languages, rejecting
        self.embedding = rng.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32)
        self.mask = np.zeros((width, DIMENSIONS, units), np.float32)
        for i, w in enumerate(WIDTHS):
            self.mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(width * DIMENSIONS, units)
        self.filters = (rng.normal(0, 0.2, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(units, np.float32)
        self.output = rng.normal(0, 0.2, (units, classes)).astype(np.float32)
        self.output_bias = np.zeros(classes, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.output, self.output_bias]

    def spans(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, width * dimensions): the embedded bytes below each filter place."""
        embedded = self.embedding[windows].reshape(len(windows), -1)
        size = max(WIDTHS) * DIMENSIONS
        return np.lib.stride_tricks.sliding_window_view(embedded, size, axis=1)[:, ::DIMENSIONS]

    def pooled(self, spans: np.ndarray) -> np.ndarray:
        places = spans.shape[1]
        return (np.ascontiguousarray(spans).reshape(-1, spans.shape[2]) @ self.filters).reshape(len(spans), places, -1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.output_bias)), np.float32)
        for start in range(0, len(windows), BATCH):
            hidden = self.pooled(self.spans(windows[start : start + BATCH])).max(axis=1)
            out[start : start + BATCH] = softmax(np.maximum(hidden + self.bias, 0) @ self.output + self.output_bias)
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam on the cross entropy; gradients flow through the place that won the pooling."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        width, step = max(WIDTHS), 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), 64):
                chosen = order[at : at + 64]
                x, y, n = windows[chosen], labels[chosen], len(chosen)
                spans = self.spans(x)
                scores = self.pooled(spans)
                winners = scores.argmax(axis=1)
                hidden = np.take_along_axis(scores, winners[:, None], 1)[:, 0] + self.bias
                active = np.maximum(hidden, 0)
                delta = softmax(active @ self.output + self.output_bias)
                delta[np.arange(n), y] -= 1
                delta /= n
                back = (delta @ self.output.T) * (hidden > 0)
                rows = np.arange(n)[:, None]
                won = spans[rows, winners]
                filters = np.einsum("nus,nu->su", won, back) * self.mask
                below = np.einsum("nu,su->nus", back, self.filters).reshape(n, -1, width, DIMENSIONS)
                embedding = np.zeros_like(self.embedding)
                places = x[rows[:, :, None], winners[:, :, None] + np.arange(width)]
                np.add.at(embedding, places, below)
                step += 1
                gradients = [embedding, filters, back.sum(0), active.T @ delta, delta.sum(0)]
                for p, g, (m, v) in zip(self.parameters(), gradients, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, padded with zero bytes, and how many bytes each adds."""
    count = max(1, -(-(len(data) - (WINDOW - STRIDE)) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]
    sizes = np.minimum(WINDOW, len(data) - np.arange(count) * STRIDE)
    return windows, sizes


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


#: Blocks of scripts from which strange text is made: first and last code points.
SCRIPTS = [(0x400, 0x45F), (0x391, 0x3C9), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939), (0xE01, 0xE2E),
           (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


def strange(windows: np.ndarray, seed: int = 13) -> np.ndarray:
    """As many windows that are in no language, of two kinds in turn: random letters or digits in
    words, and random characters of a script that the windows do not use. (Windows with their bytes in another order made the network take any
    prose but that it was fitted on to be strange.)"""
    rng = np.random.default_rng(seed)
    used = "".join(w.tobytes().decode("utf-8", "ignore") for w in windows[:: max(1, len(windows) // 2000)])
    scripts = [(a, b) for a, b in SCRIPTS if sum(a <= ord(c) <= b for c in used) < len(used) / 1000]
    alphabets = ["0123456789abcdef", "0123456789", "bcdfghjklmnpqrstvwxz", "abcdefghijklmnopqrstuvwxyz",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"]
    made = np.zeros_like(windows)
    for i in range(len(windows)):
        if i % 2 == 0 or not scripts:
            letters = alphabets[rng.integers(len(alphabets))]
            drawn = [letters[k] for k in rng.integers(0, len(letters), WINDOW)]
        else:
            first, last = scripts[rng.integers(len(scripts))]
            drawn = [chr(k) for k in rng.integers(first, last + 1, WINDOW)]
        blank = rng.random(WINDOW) < rng.choice([0.0, 0.05, 0.15])
        data = "".join(" " if gap else c for c, gap in zip(drawn, blank, strict=True)).encode()[:WINDOW]
        made[i, : len(data)] = np.frombuffer(data, np.uint8)
    return made


def drawn_windows(sample: DataFrame) -> DataFrame:
    """(lang, window): up to ``WINDOWS_A_TEXT`` windows of each text with a letter, from all over it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and any(map(str.isalpha, text)):
                    windows, _ = windows_of(text.encode())
                    rng = np.random.default_rng(zlib.crc32(text.encode()))
                    chosen = rng.choice(len(windows), min(len(windows), WINDOWS_A_TEXT), replace=False)
                    langs += [lang] * len(chosen)
                    found += [windows[k].tobytes() for k in chosen]
            yield {"lang": langs, "window": found}

    return map_rows(sample.select("lang", "text"), task, "lang string, window binary")


def fit(labelled: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, rejecting: bool = False) -> Network | None:
    """A network fitted on a sample of (doc_id, text, lang), evenly from each language.

    At most ``sample_documents`` texts are expected in the sample, chosen by a hash of them, copies
    of a text being one; windows are drawn from all over each. So the driver gets a few windows a
    text, however long it is. With ``rejecting`` one more class is fitted on as many ``strange``
    windows. None if no row has a language.
    """
    usable = labelled.where(F.col("lang").isNotNull())
    counts = usable.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    if not counts:
        return None
    each = sample_documents / len(counts)
    kept = F.lit(0.0)
    for row in counts:
        kept = F.when(F.col("lang") == row["lang"], min(1.0, each / row["count"])).otherwise(kept)
    at = F.pmod(F.xxhash64("text", "lang"), F.lit(1_000_000))
    sample = usable.where(at / 1_000_000 < kept).select("lang", "text").distinct()
    rows = sorted((row["lang"], bytes(row["window"])) for row in drawn_windows(sample).collect())
    languages = [row["lang"] for row in counts]
    network = Network(languages, rejecting)
    if rows:
        windows = np.stack([np.frombuffer(window, np.uint8) for _, window in rows])
        labels = np.array([languages.index(lang) for lang, _ in rows])
        if rejecting:
            odd = strange(windows)
            windows, labels = np.concatenate([windows, odd]), np.concatenate([labels, np.full(len(odd), len(languages))])
        network.train(windows, labels)
    return network


def means(network: Network, texts: list[str]) -> Iterator[np.ndarray]:
    """Mean probabilities of each text; windows of short texts share a pass."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for i, text in enumerate(texts):
        waiting.append(windows_of(text.encode()))
        if i + 1 == len(texts) or sum(len(sizes) for _, sizes in waiting) >= BATCH:
            found = network.probabilities(np.concatenate([w for w, _ in waiting]))
            start = 0
            for _, sizes in waiting:
                own = found[start : start + len(sizes)]
                yield (own * (sizes / sizes.sum())[:, None]).sum(0)
                start += len(sizes)
            waiting = []


def predict(network: Network | None, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Of each text of a batch the language, its score, and the score of the rejecting class."""
    known = [i for i, text in enumerate(texts) if network is not None and text and any(map(str.isalpha, text))]
    named, scores, strangeness = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    for i, mean in zip(known, means(network, [texts[i] for i in known]), strict=True):
        own = mean[: len(network.languages)]
        named[i], scores[i] = network.languages[int(own.argmax())], min(1.0, float(own.max()))
        strangeness[i] = float(mean[-1]) if network.rejecting else 0.0
    return named, scores, strangeness


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score): the learned language of each whole text and its probability.

    ``und`` with score 0 for a null text or one without a letter, and for all if nothing was
    learned. Ties go to the first language by name. Null ids and repeated rows are kept as they
    are; other columns are ignored, whatever their names. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            named, scores, _ = predict(network, batch.column(1).to_pylist())
            yield {"doc_id": batch.column(0), "lang_pred": named, "score": scores}

    return map_rows(docs.select(docs["doc_id"].cast("long"), "text"), task, PREDICTED)


def accepted(docs: DataFrame, network: Network | None, most_strange: float = 0.5) -> DataFrame:
    """The documents, all columns, that a rejecting network takes to be in one of its languages: no
    more than ``most_strange`` of their windows, weighted, go to the class of what is in none.

    Rows without a letter go, whatever else they hold. No shuffle and no join: rows pass as they are.
    """
    reach_package(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            named, _, strangeness = predict(network, batch.column(place).to_pylist())
            kept = [n != UNKNOWN and s <= most_strange for n, s in zip(named, strangeness, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
