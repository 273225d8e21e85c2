import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from reelframe.llm import pieces
from reelframe.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCRAPS = ["a", "b", " ", "  ", "the", "▁", "\n", "\t", "é", "日", "😀", "\x00", "ing", "s", "<s>", "<0x41>", "​", "�", "12", ". "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pieces.codec_for(PATH)


def test_random_texts_encode_as_in_the_library(codec, library):
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 30)))
        assert codec.encode(text).tolist() == library.encode(text)


def test_any_ids_decode_as_in_the_library(codec, library):
    rng = random.Random(6)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), 3 + 0xE2, 3 + 0x82, 3 + 0xAC]) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids)


def test_both_agendas_merge_alike(codec):
    rng = random.Random(7)
    for _ in range(1000):
        part = "".join(rng.choice("▁aeinrst") for _ in range(rng.randint(1, 40)))
        assert codec.by_scan(part) == codec.by_heap(part)


@pytest.mark.parametrize("text", ["a" * 200_000, "ab c" * 30_000, " " * 100_000, "日本" * 20_000, "\n" * 50_000])
def test_long_parts(codec, library, text):
    assert codec.encode(text).tolist() == library.encode(text)
    assert codec.decode(codec.encode(text)) == text


def test_a_memory_that_is_emptied_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_BYTES", 2000)
    small = pieces.Codec(pieces.Vocabulary(PATH))
    text = "some words that come again, some words that come once more and again " * 20
    assert small.encode(text).tolist() == library.encode(text)


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        parts = file.read()
    unigram = parts.replace(bytes([3 << 3, 2, 4 << 3]), bytes([3 << 3, 1, 4 << 3]), 1)
    assert unigram != parts
    (tmp_path / "unigram.model").write_bytes(unigram)
    with pytest.raises(ValueError, match="no merge vocabulary"):
        pieces.Vocabulary(str(tmp_path / "unigram.model"))


def test_query_equals_the_library(spark, small_tables, documents, library):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = LLM_QUERIES["op13_pieces"](spark, small_tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_no_document_differs_from_the_library(documents):
    assert pieces.disagreements(documents, PATH).collect() == []


def test_odd_rows(odd_docs, no_docs, library):
    rows = pieces.encode_decode(odd_docs, PATH).collect()
    wanted = sorted(((r.doc_id or 0), r.text or "") for r in odd_docs.collect())
    assert sorted(((r.doc_id or 0), r.decoded) for r in rows) == wanted
    assert all(r.ids == library.encode(r.decoded, add_eos=True) for r in rows)
    assert pieces.encode_decode(no_docs, PATH).collect() == []
