"""Rows that the operators' tests share."""

import random

#: Columns of documents, then columns whose names operators also use inside or give out.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, keys string, "
    "base string, spans string, component_id string, kept string, n int, h int, key string, id string, item_id string"
)
FILL = ("en", "src", 1, 0.5, "i", "k", "b", "s", "c", "k", 1, 2, "k", "i", "x")

WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls read old books by candle light near rivers".split()


def sentence(seed, count):
    """Words that depend on the seed and hardly repeat as runs of five."""
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(97)}" for _ in range(count))
