"""Byte-level BPE by a transducer, and decoding by a UTF-8 state machine.

A token sequence is the BPE encoding of its bytes exactly if every neighbouring pair is: the pair's
own bytes encode to that pair. So encoding is a finite-state relation over the tokens' bytes, with
the token before as the only memory. :class:`MergeTransducer` determinises it lazily: a state holds
every way to cut the bytes read since the last decided token, and reading a byte emits the tokens on
which all ways that are left agree. Tokens have a bounded length, so a decision is at most that many
bytes and one token behind.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lakeloom.llm.pieces import FORGET, PIECES_KEPT, Kept, PieceEncoder, answers, chunks, encode

#: States and pairs that a worker keeps; beyond that it starts anew.
STATES_KEPT, PAIRS_KEPT = 160_000, 250_000

#: Chunks and pieces that a worker keeps; a piece costs more here than with a compiled library.
ENCODED_KEPT = (1_000_000, 200_000)

_NEVER = float("inf")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(ranks: dict[bytes, int], word: bytes, until: int = 1) -> list:
    """Encode by the definition: join the neighbours of the lowest rank, leftmost first.

    With ``until`` above 1 the joining ends at that many parts, which are returned as bytes.
    """
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > until:
        joined = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
        best = min((r for r in joined if r >= 0), default=None)
        if best is None:
            break
        at = joined.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts] if until == 1 else parts


class State(dict):
    """Byte to (next state, packed tokens emitted); ``ways`` are (undecided tokens, trie node), in the
    order of where the token that is being read began."""

    __slots__ = ("last", "ways", "rest")


class MergeTransducer:
    """Words (bytes) to packed ids by the merges of ``ranks``."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.trie[node]:
                    self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = self.trie[node][byte]
            self.token[node] = rank
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.bytes}
        self._halves = Kept(lambda token: merge(ranks, token, 2), PIECES_KEPT)
        self.spines = Kept(self._spines, PIECES_KEPT)
        self.pairs = Kept(lambda pair: self.fits(*pair), PAIRS_KEPT)
        self._restart()

    def _restart(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self._state(-1, (((), 0),))

    def _state(self, last: int, ways: tuple) -> State:
        found = self.states.get((last, ways))
        if found is None:
            found = State()
            found.last, found.ways = last, ways
            found.rest = None
            self.states[(last, ways)] = found
        return found

    def _spines(self, token: int) -> tuple[list[tuple[bytes, float]], list[tuple[bytes, float]]]:
        """Parts of ``token`` at its left and at its right end, each with the rank that consumes it."""
        left = right = self.bytes[token]
        lefts, rights = [(left, _NEVER)], [(right, _NEVER)]
        while len(left) > 1:
            consumed, left = self.ranks[left], self._halves[left][0]
            lefts.append((left, consumed))
        while len(right) > 1:
            consumed, right = self.ranks[right], self._halves[right][1]
            rights.append((right, consumed))
        return lefts, rights

    def fits(self, before: int, token: int) -> bool:
        """Whether the boundary between the tokens survives all merges (-1: begin a word).

        It does not if a part at the right end of the one and a part at the left end of the other
        are joined before either is consumed; of two joins of one rank the left one comes first.
        """
        if before < 0:
            return merge(self.ranks, self.bytes[token]) == [token]
        ranks = self.ranks
        for left, right_consumed in self.spines[token][0]:
            for right, left_consumed in self.spines[before][1]:
                rank = ranks.get(right + left)
                if rank is not None and rank < left_consumed and rank <= right_consumed:
                    return False
        return True

    def _step(self, state: State, byte: int) -> tuple[State, bytes]:
        trie, token_of, pairs, last = self.trie, self.token, self.pairs, state.last
        ways, ended = [], None
        for undecided, node in state.ways:
            node = trie[node].get(byte)
            if node is None:
                continue
            below = trie[node]
            if below:
                ways.append((undecided, node))
            # The bytes read so far have one encoding, so only one way can end a token here.
            if ended is None and token_of[node] >= 0 and pairs[undecided[-1] if undecided else last, token_of[node]]:
                ended = (*undecided, token_of[node])
        if ended is not None:
            ways.append((ended, 0))
        # What all ways agree on is decided; the one that began first has the fewest tokens.
        low, agreed = ways[0][0], 0
        while agreed < len(low) and all(len(u) > agreed and u[agreed] == low[agreed] for u, _ in ways):
            agreed += 1
        emitted = b""
        if agreed:
            last = low[agreed - 1]
            emitted = b"".join([self.packed[t] for t in low[:agreed]])
            ways = [(undecided[agreed:], node) for undecided, node in ways]
        # The last decided token only matters where nothing undecided follows it.
        if len(low) > agreed:
            last = None
        state[byte] = step = (self._state(last, tuple(ways)), emitted)
        return step

    def __call__(self, word: bytes) -> bytes:
        if len(self.states) >= STATES_KEPT:
            self._restart()
        state, out = self.start, []
        for byte in word:
            state, emitted = state.get(byte) or self._step(state, byte)
            if emitted:
                out.append(emitted)
        if state.rest is None:
            ended = [undecided for undecided, node in state.ways if node == 0]
            state.rest = b"".join(self.packed[t] for t in ended[0])
        out.append(state.rest)
        return b"".join(out)


@lru_cache(maxsize=2)
def transducer_encoder(ranks_path: str, pattern: str) -> PieceEncoder:
    transduce = MergeTransducer(read_ranks(ranks_path))
    findall = regex.compile(pattern).findall

    def split(chunk: str) -> list[str]:
        plain = chunk[:1] == " " and chunk.isascii() and chunk[1:].isalpha()
        return [chunk] if plain else findall(chunk)

    return PieceEncoder(chunks, split, lambda piece: transduce(piece.encode()), kept=ENCODED_KEPT)


def encode_bpe(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: ids of every whole text as packed little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded on its own, without special tokens. NULL and empty texts
    have no ids. Rows are independent: repeated rows and a NULL ``doc_id`` stay, other columns are
    ignored. No shuffle; memory is a slice of a batch and the bounded tables of a worker.
    """
    return encode(docs, lambda: transducer_encoder(ranks_path, pattern))


# -- decoding ------------------------------------------------------------------------------------

# States: 0 between characters, 1 to 3 that many continuation bytes are due, then the second bytes
# with a narrower range (after E0, ED, F0, F4), and 8 for an error, which stays.
_ERROR = 8


def utf8_table() -> np.ndarray:
    """Next state by [state, byte], by the well-formed byte sequences of the Unicode standard."""
    table = np.full((9, 256), _ERROR, np.uint8)
    table[0, :0x80] = 0
    table[0, 0xC2:0xE0] = 1
    table[0, 0xE1:0xF0] = 2
    table[0, 0xF1:0xF4] = 3
    table[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    table[1, 0x80:0xC0] = 0
    table[2, 0x80:0xC0] = 1
    table[3, 0x80:0xC0] = 2
    table[4, 0xA0:0xC0] = 1
    table[5, 0x80:0xA0] = 1
    table[6, 0x90:0xC0] = 2
    table[7, 0x80:0x90] = 2
    return table


class StreamDecoder:
    """Ids to bytes and text, chunk by chunk.

    Each token acts on the states of the UTF-8 machine as a whole, by a table over tokens. A chunk
    gives out the text up to the last token that ends between characters and keeps the rest.
    """

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        table = utf8_table()
        acts = np.tile(np.arange(9, dtype=np.uint8), (len(tokens), 1))
        for n, token in enumerate(tokens):
            if not token.isascii():
                for byte in token:
                    acts[n] = table[acts[n], byte]
            else:
                acts[n, 1:] = _ERROR
        self.whole = acts[:, 0] == 0
        self.acts = [row.tobytes() for row in acts]
        self.state, self.kept = 0, b""

    def feed(self, ids: np.ndarray) -> str:
        """The text that is complete after ``ids``."""
        broken = np.flatnonzero(~self.whole[ids])
        # Between broken tokens the machine rests in state 0, and a whole token is an error in any other.
        state, cut, due = self.state, 0, 0
        for at, token in zip(broken.tolist(), ids[broken].tolist()):
            if state == 0:
                cut = at
            elif at != due:
                state = _ERROR
            state = self.acts[token][state]
            due = at + 1
            if state == _ERROR:
                break
        if state == _ERROR or (state and due < len(ids)):
            raise UnicodeDecodeError("utf-8", b"", 0, 1, "ids do not spell UTF-8")
        if state == 0:
            cut = len(ids)
        self.state = state
        text = self.kept + self._spelt(ids[:cut]) if cut else b""
        self.kept = self._spelt(ids[cut:]) if cut else self.kept + self._spelt(ids)
        return text.decode()

    def _spelt(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after the other."""
        sizes = self.sizes[ids]
        stops = np.cumsum(sizes)
        if not len(stops):
            return b""
        places = np.repeat(self.starts[ids] - (stops - sizes), sizes)
        places += np.arange(stops[-1])
        return self.bytes[places].tobytes()

    def close(self) -> None:
        """End of a stream; an unfinished character is an error."""
        state, self.state, self.kept = self.state, 0, b""
        if state:
            raise UnicodeDecodeError("utf-8", b"", 0, 1, "ids end within a character")


@lru_cache(maxsize=2)
def stream_decoder(ranks_path: str) -> StreamDecoder:
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return StreamDecoder(tokens)


FORGET += [transducer_encoder.cache_clear, stream_decoder.cache_clear]


def decoding(ranks_path: str, chunk_ids: int = 65_536):
    """Batches of (``doc_id``, ``ids``) to batches of (``doc_id``, ``ids``, ``text``)."""

    def one(decoder: StreamDecoder, packed: bytes | None) -> str | None:
        if packed is None:
            return None
        ids = np.frombuffer(packed, "<u4")
        texts = [decoder.feed(ids[i : i + chunk_ids]) for i in range(0, len(ids), chunk_ids)]
        decoder.close()
        return "".join(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = stream_decoder(ranks_path)
        for part in answers(batches, encodes=True):
            texts = [one(decoder, packed) for packed in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    return run


def decode_bpe(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``: the text that the packed ids spell.

    A document's ids go through the machine in chunks. NULL ids give a NULL text. Ids that do not
    spell UTF-8, which :func:`encode_bpe` never makes, are an error.
    """
    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(
        decoding(ranks_path), f"doc_id {kind}, ids binary, text string"
    )


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """:func:`encode_bpe` and :func:`decode_bpe` in one worker: ``doc_id, ids, text``."""
    return encode(
        docs,
        lambda: transducer_encoder(ranks_path, pattern),
        then=decoding(ranks_path),
        schema="ids binary, text string",
    )
