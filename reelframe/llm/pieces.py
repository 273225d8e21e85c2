"""SentencePiece vocabularies of the merge type: encoding by a score-ordered agenda, and decoding.

Encoding joins neighbouring symbols until no pair forms a piece: an agenda holds the adjacent pairs
that do, best score first and leftmost among equal scores; taking one up joins it, puts the pairs
with its new neighbours on the agenda, and leaves pairs with symbols that are gone to be passed over.

No merge crosses a border that lies inside no piece. So text is cut around characters that only
occur as pieces of their own, before each run of spaces if no piece has a space after another
character, and between letters and others if no piece has both; all of this is read off the
vocabulary. Each part has an agenda of its own, whose result is kept for the next time it is met.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows

#: Bytes that a task's memory of encoded parts may take, about.
MOST_BYTES = 192 * 2**20
#: Parts of more characters are not kept, and their agenda is a heap.
LONGEST_KEPT = 64
NO_RANK = 1 << 40

SPACE = "▁"
#: Kinds of pieces and the numbers of fields in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINING, NORMALIZING = 1, 2, 3
MERGES = 2

ENCODED = "doc_id long, ids array<int>, decoded string"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            length, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + length], at + length
        yield key >> 3, value


class Vocabulary:
    """What a model file says. Refused are models whose texts are rewritten before they are cut,
    other types than merges, pieces given by users, unused pieces, and those without byte pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        training = dict(fields(next(value for key, value in parts if key == TRAINING)))
        normalizing = dict(fields(next(value for key, value in parts if key == NORMALIZING)))
        entries = [dict(fields(value)) for key, value in parts if key == PIECES]
        self.pieces = [entry[1].decode() for entry in entries]
        self.scores = [struct.unpack("<f", entry.get(2, bytes(4)))[0] for entry in entries]
        self.kinds = [entry.get(3, NORMAL) for entry in entries]
        self.end = training.get(42, 2)
        self.unknown = training.get(44, " ⁇ ".encode()).decode()
        self.prefixed = bool(normalizing.get(3, 1))
        plain = not normalizing.get(2) and not normalizing.get(4, 1) and normalizing.get(5, 1)
        known = set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE} and self.kinds.count(BYTE) == 256
        if training.get(3, 1) != MERGES or training.get(24, 0) or not plain or not known or not training.get(35, 0):
            raise ValueError(f"{path} is no merge vocabulary with byte pieces over texts as they are")


class Parts(dict):
    """Ids of the parts of texts, as the bytes of 32-bit numbers, made when first asked for. Half of
    the bytes are for parts met of late; those met before are forgotten when that half is full again."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.taken = 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("i", self.make(part)).tobytes()
        if len(part) <= LONGEST_KEPT:
            self.taken += 256 + 4 * len(part) + len(ids)
            if self.taken > MOST_BYTES // 2:
                self.older = dict(self)
                self.clear()
                self.taken = 0
            self[part] = ids
        return ids


class Codec:
    """Encodes texts as the sentencepiece library does without sampling, and decodes ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.prefixed, self.end = vocabulary.prefixed, vocabulary.end
        ranks = {score: rank for rank, score in enumerate(sorted(set(vocabulary.scores), reverse=True))}
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.surfaces: list[bytes] = []
        self.kinds = vocabulary.kinds
        self.controls = {number for number, kind in enumerate(self.kinds) if kind == CONTROL}
        for number, (piece, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)):
            surface = b""
            if kind == NORMAL:
                self.ids[piece] = number
                self.ranks[piece] = ranks[vocabulary.scores[number]]
                surface = piece.replace(SPACE, " ").encode()
            elif kind == BYTE:
                surface = bytes([int(piece[3:5], 16)])
                self.byte_ids[surface[0]] = number
            elif kind == UNKNOWN:
                surface = vocabulary.unknown.encode()
            self.surfaces.append(surface)
        self.split = re.compile(self.cuts()).findall
        self.parts = Parts(self.merged)

    def cuts(self) -> str:
        """A pattern of the parts of a text that no piece crosses the borders of."""
        joined = set().union(*(piece for piece in self.ids if len(piece) > 1)) - {SPACE}
        kinds = [sorted(c for c in joined if c.isalpha()), sorted(c for c in joined if not c.isalpha())]
        if any(len({c.isalpha() for c in piece.replace(SPACE, "")}) > 1 for piece in self.ids):
            kinds = [sorted(joined)]
        runs = "|".join(f"[{re.escape(''.join(kind))}]+" for kind in kinds if kind)
        if not runs or any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            return f"[{re.escape(''.join(sorted(joined)))}{SPACE}]+|(?s:.)"
        return f"{SPACE}+(?:{runs})?|{runs}|(?s:.)"

    def merged(self, part: str) -> list[int]:
        """Ids of a part of a text."""
        symbols = self.by_scan(part) if len(part) <= LONGEST_KEPT else self.by_heap(part)
        found = list(map(self.ids.get, symbols))
        if None not in found:
            return found
        found = []
        for symbol in symbols:
            number = self.ids.get(symbol)
            found += [number] if number is not None else [self.byte_ids[byte] for byte in symbol.encode()]
        return found

    def by_scan(self, part: str) -> list[str]:
        """Symbols of a short part; the agenda is a list by place, searched for the best pair."""
        symbols, rank = list(part), self.ranks.get
        agenda = list(map(rank, map(add, symbols, symbols[1:]), repeat(NO_RANK)))
        while agenda and (best := min(agenda)) < NO_RANK:
            at = agenda.index(best)
            pair = symbols[at] + symbols[at + 1]
            symbols[at : at + 2] = (pair,)
            del agenda[at]
            if at:
                agenda[at - 1] = rank(symbols[at - 1] + pair, NO_RANK)
            if at < len(agenda):
                agenda[at] = rank(pair + symbols[at + 1], NO_RANK)
        return symbols

    def by_heap(self, part: str) -> list[str]:
        """Symbols of a long part; the agenda is a heap, in which pairs that are gone stay until met."""
        symbols: list[str | None] = list(part)
        ranks = self.ranks
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        after[-1] = -1
        pairs = map(add, symbols, symbols[1:])
        agenda = [(ranks[pair], at, pair) for at, pair in enumerate(pairs) if pair in ranks]
        heapify(agenda)
        while agenda:
            _, at, pair = heappop(agenda)
            right = after[at]
            if symbols[at] is None or right < 0 or symbols[at] + symbols[right] != pair:
                continue
            symbols[at], symbols[right] = pair, None
            after[at] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (longer := pair + symbols[beyond]) in ranks:
                    heappush(agenda, (ranks[longer], at, longer))
            left = before[at]
            if left >= 0 and (longer := symbols[left] + pair) in ranks:
                heappush(agenda, (ranks[longer], left, longer))
        return [symbol for symbol in symbols if symbol is not None]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text without an end id; none for the empty text."""
        if text:
            text = (SPACE if self.prefixed else "") + text.replace(" ", SPACE)
        # Most parts are known: looking them up and joining their ids runs without a Python loop.
        return np.frombuffer(b"".join(map(self.parts.__getitem__, self.split(text) if text else ())), np.int32)

    def decode(self, ids) -> str:
        """Text of some ids: control ids are left out, and so is the space before the first word."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        data = b"".join(map(self.surfaces.__getitem__, ids))
        start = 0
        if self.prefixed:
            first = next((number for number in ids if self.kinds[number] != CONTROL), None)
            start = int(first is not None and self.kinds[first] == NORMAL and self.surfaces[first][:1] == b" ")
        if self.controls.isdisjoint(ids[1:-1]):
            try:
                return data[start:].decode()
            except UnicodeDecodeError:
                pass
        return self._mended(ids)[start:]

    def _mended(self, ids: list[int]) -> str:
        """Text of ids whose bytes are no characters somewhere: each such byte is one U+FFFD."""
        found, run = [], b""
        for number in [*ids, self.end]:
            if self.kinds[number] == BYTE:
                run += self.surfaces[number]
                continue
            while run:
                length = next((n for n in range(1, 5) if _whole(run[:n])), 0)
                found.append(run[:length].decode() if length else "�")
                run = run[length or 1 :]
            found.append(self.surfaces[number].decode())
        return "".join(found)


def _whole(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


_codecs: dict[str, Codec] = {}


def codec_for(path: str) -> Codec:
    """The codec of this process for a model file, which is read once."""
    if path not in _codecs:
        _codecs[path] = Codec(Vocabulary(path))
    return _codecs[path]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text, with an end id, and decode the ids again: (doc_id, ids, decoded).

    The model file must be readable at ``path`` on every executor. A null text counts as empty: its
    only id is the end id, and it decodes to the empty text. A text of any length is encoded as a
    whole, in time n log n of its longest part. A null doc_id stays null; repeated rows give
    repeated rows; other columns are ignored, whatever their names. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        codec = codec_for(path)
        end = np.array([codec.end], np.int32)
        for batch in batches:
            lists = [np.append(codec.encode(text.as_py() or ""), end) for text in batch.column(1)]
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = np.concatenate(lists) if lists else end[:0]
            yield {
                "doc_id": batch.column(0),
                "ids": pa.ListArray.from_arrays(offsets, flat),
                "decoded": pa.array(map(codec.decode, lists), pa.string()),
            }

    return map_rows(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), task, ENCODED)


def disagreements(docs: DataFrame, path: str) -> DataFrame:
    """Ids of the documents whose token ids or decoded text differ from the sentencepiece library's.

    Meant for tests and for trying a new model file: every text is encoded twice.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        codec = codec_for(path)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            own = [codec.encode(text).tolist() for text in texts]
            wanted = library.encode(texts)
            differing = [a != b or codec.decode(a) != library.decode(b) for a, b in zip(own, wanted, strict=True)]
            yield {"doc_id": batch.column(0).filter(pa.array(differing, pa.bool_()))}

    return map_rows(docs.select(docs["doc_id"].cast("long"), "text"), task, "doc_id long")


def digests() -> list[Column]:
    """Counts of ids, SHA-256 of the ids in decimal, joined by spaces, and of the decoded text."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
