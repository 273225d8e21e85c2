"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly when every two neighbours are
the encoding of their joined bytes. So the last token of each prefix is settled by a short
window of earlier positions, and reading bytes from left to right needs no merging:

* a state is the set of open positions, each with the vocabulary-trie node that the bytes
  since then have reached, and the tokens up to that position which are not yet emitted;
* a byte moves every open position one trie edge on, drops those without one, closes the
  one token that fits its left neighbour, and emits what all open positions agree on.

An open position lives no longer than the longest token, which bounds the lookahead. States
and transitions are made when first met and kept; beyond ``MOST_STATES`` they are dropped
and made again, which costs time but changes nothing.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows

#: Sizes at which a task's memory of states, borders, pieces and decoding steps is cut back. Every
#: Python worker of an executor holds its own; at these sizes one stays near 80 MB on the documents
#: of sf0.1 (three times the sizes held about 250 MB), for about 2.5 times the encoding time.
MOST_STATES = 30_000
MOST_BORDERS = 100_000
MOST_PIECES = 100_000
MOST_STEPS = 60_000
#: Longer pieces are not remembered, so that what is remembered is bounded in bytes too.
LONGEST_KEPT = 64
#: Tokens that are decoded at a time.
CHUNK = 8192

NO_RANK = 1 << 40

ENCODED = "doc_id long, ids array<int>, decoded string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: join the neighbours of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == NO_RANK:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class Memory(dict):
    """A map of bounded size: at ``most`` entries the older half of what it knows is let go."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most // 2
        self.older: dict = {}

    def recall(self, key):
        """An entry that only the older half still holds, made recent again."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Transducer:
    """Encodes pieces of text, emitting each token once no later byte can change it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.edges: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.edges[node]:
                    self.edges[node][byte] = len(self.edges)
                    self.edges.append({})
                    self.token_at.append(None)
                node = self.edges[node][byte]
            self.token_at[node] = rank
        self.borders = Memory(MOST_BORDERS)
        self.rights: dict[int, tuple] = {}
        self.lefts: dict[int, tuple] = {}
        self.start_anew()

    def start_anew(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._number((None, ((0, ()),)))

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number

    def _edge_parts(self, token: int, right: bool) -> tuple:
        """The parts at one edge of a token while it is merged: (bytes, rank of the merge
        that takes the part up), the single byte first. None if merging makes other tokens."""
        known = (self.rights if right else self.lefts).get(token)
        if known is None:
            parts = [self.bytes_of[token][i : i + 1] for i in range(len(self.bytes_of[token]))]
            edge = parts[-1] if right else parts[0]
            found = []
            while len(parts) > 1:
                pairs = (self.ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False))
                rank, at = min((r, i) for i, r in enumerate(pairs))
                if rank == NO_RANK:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if parts[-1 if right else 0] != edge:
                    found.append((edge, rank))
                    edge = parts[-1 if right else 0]
            known = (*found, (edge, NO_RANK)) if len(parts) == 1 else ()
            (self.rights if right else self.lefts)[token] = known
        return known

    def _fits(self, left: int | None, token: int) -> bool:
        """Whether a token survives at the start, or beside the token on its left: no part at
        the left one's end may join a part at its own head before a merge takes either up."""
        heads = self._edge_parts(token, right=False)
        if left is None or not heads:
            return bool(heads)
        key = left << 32 | token
        known = self.borders.get(key)
        if known is None and (known := self.borders.recall(key)) is None:
            tails = self._edge_parts(left, right=True)
            i = j = 0
            known = True
            while known:
                (tail, tail_goes), (head, head_goes) = tails[i], heads[j]
                joined = self.ranks.get(tail + head, NO_RANK)
                if joined < tail_goes and joined <= head_goes and joined != NO_RANK:
                    known = False
                elif tail_goes == head_goes == NO_RANK:
                    break
                elif tail_goes <= head_goes:
                    i += 1
                else:
                    j += 1
            self.borders.keep(key, known)
        return known

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, positions = self.states[number]
        edges, token_at = self.edges, self.token_at
        alive, closed = [], None
        for node, pending in positions:
            node = edges[node].get(byte)
            if node is not None:
                alive.append((node, pending))
                if closed is None and (token := token_at[node]) is not None:
                    if self._fits(pending[-1] if pending else last, token):
                        closed = (*pending, token)
        if closed is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        agreed = len(closed)
        for _, pending in alive:
            agreed = min(agreed, len(pending))
            while pending[:agreed] != closed[:agreed]:
                agreed -= 1
        alive.append((0, closed))
        if agreed:
            last = closed[agreed - 1]
            alive = [(node, pending[agreed:]) for node, pending in alive]
        if all(pending for _, pending in alive):
            last = None
        return self._number((last, tuple(alive))), closed[:agreed]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        moves = self.moves
        found: list[int] = []
        number = 0
        for byte in piece:
            step = moves.get(number << 8 | byte)
            if step is None:
                step = moves[number << 8 | byte] = self._move(number, byte)
                if len(self.states) > MOST_STATES:
                    state = self.states[step[0]]
                    self.start_anew()
                    moves, step = self.moves, (self._number(state), step[1])
            number, out = step
            if out:
                found += out
        return (*found, *self.states[number][1][-1][1])


def unfinished(data: bytes) -> int:
    """How many bytes at the end belong to a character that is not complete."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte & 0b1100_0000 == 0b1000_0000:
            continue
        length = 4 if 0xF0 <= byte <= 0xF4 else 3 if 0xE0 <= byte <= 0xEF else 2 if 0xC2 <= byte <= 0xDF else 1
        return back if length > back else 0
    return 0


class Utf8Decoder:
    """Turns token ids into text as they come; a state is the bytes of an unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.steps: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        self.whole: list[str | None] = [None] * (max(bytes_of) + 1)
        for token, data in bytes_of.items():
            if not unfinished(data) and (data[0] & 0b1100_0000) != 0b1000_0000:
                self.whole[token] = data.decode("utf-8", "replace")

    def step(self, state: bytes, token: int) -> tuple[str, bytes]:
        known = self.steps.get((state, token))
        if known is None:
            if len(self.steps) >= MOST_STEPS:
                self.steps.clear()
            data = state + self.bytes_of[token]
            cut = len(data) - unfinished(data)
            known = self.steps[state, token] = (data[:cut].decode("utf-8", "replace"), data[cut:])
        return known

    def decode(self, ids) -> Iterator[str]:
        """Text token by token; what is unfinished at the end becomes a replacement character."""
        state, whole, step = b"", self.whole, self.step
        for token in ids:
            if not state and (text := whole[token]) is not None:
                yield text
            else:
                text, state = step(state, token)
                yield text
        if state:
            yield state.decode("utf-8", "replace")

    def chunks(self, ids: list[int], size: int = CHUNK) -> Iterator[str]:
        """The same text, many tokens at a time: the same state machine over bytes, run by Python's own
        incremental decoder, which keeps an unfinished character from one chunk to the next."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), size):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[at : at + size])))
        yield machine.decode(b"", final=True)


class Pieces(Memory):
    """Ids of pieces of text, as the bytes of 32-bit numbers, made when first asked for."""

    def __init__(self, most: int, encode: Callable[[bytes], tuple[int, ...]]):
        super().__init__(most)
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        known = self.older.get(piece)
        if known is None:
            known = array("i", self.encode(piece.encode())).tobytes()
        return self.keep(piece, known) if len(piece) <= LONGEST_KEPT else known


class Codec:
    """A vocabulary with the pattern that splits text before merging."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.decoder = Utf8Decoder(self.transducer.bytes_of)
        self.pieces = Pieces(MOST_PIECES, self.transducer.encode)

    def numbers(self, text: str) -> np.ndarray:
        """Token ids; known pieces are looked up and joined without a Python loop."""
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.numbers(text).tolist()

    def decode(self, ids) -> str:
        return "".join(self.decoder.chunks(ids.tolist() if isinstance(ids, np.ndarray) else ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec_for(ranks_path: str, pattern: str) -> Codec:
    """The codec of this process for a rank file, which is read once."""
    if (ranks_path, pattern) not in _codecs:
        _codecs[ranks_path, pattern] = Codec(read_ranks(ranks_path), pattern)
    return _codecs[ranks_path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode every text and decode the ids again: (doc_id, ids, decoded).

    The rank file must be readable at ``ranks_path`` on every executor. A null or empty text
    has no ids and decodes to the empty text; a null doc_id stays null; repeated rows give
    repeated rows; other columns are ignored, whatever their names. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        codec = codec_for(ranks_path, pattern)
        for batch in batches:
            lists = [codec.numbers(text.as_py() or "") for text in batch.column(1)]
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            yield {
                "doc_id": batch.column(0),
                "ids": pa.ListArray.from_arrays(offsets, flat),
                "decoded": pa.array([codec.decode(ids) for ids in lists], pa.string()),
            }

    return map_rows(docs.select(docs["doc_id"].cast("long"), "text"), task, ENCODED)


def digests() -> list[Column]:
    """Counts of ids, SHA-256 of the ids in decimal, joined by commas, and of the decoded bytes."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
