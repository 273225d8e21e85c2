import random

import public_tokenizers
import pytest
import tiktoken

from reelframe.llm import bpe
from reelframe.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.codec_for(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_encode_as_by_merging_and_decode_back(codec, reference):
    rng = random.Random(3)
    letters = "abcdeth nighéßäñ日本🙂語 \n\t0123's aaaa!?́퟿\x00"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text


def test_long_runs(codec, reference):
    for text in ("a" * 3000, "ab" * 2000, "é" * 1500, " " * 2000, "<|endoftext|>"):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_states_that_are_dropped_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 20)
    codec = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    codec.pieces.most = 4
    text = "unbelievable thorough antidisestablishment internationalization thorough " * 3
    assert codec.encode(text) == reference.encode_ordinary(text)


def test_decoder_waits_for_whole_characters(codec):
    ids = [codec.transducer.ranks[bytes([b])] for b in "🙂é".encode()]
    assert list(codec.decoder.decode(ids)) == ["", "", "", "🙂", "", "é"]
    assert codec.decode(ids[:2]) == "�"


def test_query_equals_the_library(spark, small_tables, documents, reference):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = LLM_QUERIES["op1_bpe"](spark, small_tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def by_heap(text):
    """Ids by merging pairs from a heap: the definition, but not in the square of a piece's length."""
    import heapq

    import regex

    ranks, ids = bpe.read_ranks(PATH), []
    for piece in regex.findall(PATTERN, text):
        data = piece.encode()
        parts, after, before = [data[i : i + 1] for i in range(len(data))], list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))
        heap = [(ranks[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        heapq.heapify(heap)
        while heap:
            _, at, pair = heapq.heappop(heap)
            right = after[at]
            if parts[at] is None or right >= len(parts) or parts[at] + parts[right] != pair:
                continue
            parts[at], parts[right], after[at] = pair, None, after[right]
            if after[at] < len(parts):
                before[after[at]] = at
            for left, other in ((before[at], at), (at, after[at])):
                if left >= 0 and other < len(parts) and (joined := parts[left] + parts[other]) in ranks:
                    heapq.heappush(heap, (ranks[joined], left, joined))
        ids += [ranks[part] for part in parts if part is not None]
    return ids


def test_one_piece_of_200_000_letters(codec):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdeéin日") for _ in range(200_000))
    assert codec.encode(text) == by_heap(text)


def test_states_that_are_dropped_inside_a_piece(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 30)
    codec = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    rng = random.Random(8)
    text = "".join(rng.choice("aeinrst") for _ in range(5000))
    assert codec.encode(text) == by_heap(text)
    assert len(codec.transducer.states) <= 31


def test_chunks_decode_like_single_tokens(codec):
    rng = random.Random(10)
    for _ in range(500):
        ids = [rng.randrange(50_000) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randint(0, 30))]
        text = "".join(codec.decoder.decode(ids))
        assert "".join(codec.decoder.chunks(ids, 3)) == codec.decode(ids) == text


def test_odd_rows(odd_docs, no_docs, reference):
    rows = bpe.encode_decode(odd_docs, PATH, PATTERN).collect()
    wanted = sorted(((r.doc_id or 0), r.text or "") for r in odd_docs.collect())
    assert sorted(((r.doc_id or 0), r.decoded) for r in rows) == wanted
    assert all(r.ids == (reference.encode_ordinary(r.decoded) if len(r.decoded) < 150_000 else by_heap(r.decoded)) for r in rows)
    assert bpe.encode_decode(no_docs, PATH, PATTERN).collect() == []


def test_memory_of_a_worker_is_bounded_and_changes_no_ids():
    import tracemalloc

    def word(k):
        return "".join(chr(97 + k // 26**p % 26) for p in range(5))

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = [" ".join(word(i * 7919 % 26**5) for i in range(j, j + 400)) for j in range(0, 400_000, 400)]
    fresh = [bpe.Codec(ranks, public_tokenizers.PATTERN).encode(text) for text in texts[-3:]]
    tracemalloc.start()
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    before = tracemalloc.get_traced_memory()[0]
    for text in texts:
        ids = codec.encode(text)
        assert codec.decode(ids) == text
    held = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert [codec.encode(text) for text in texts[-3:]] == fresh
    assert held < 60 * 2**20
