"""Texts to token ids by way of the pieces that a tokenizer treats on their own.

A byte-level tokenizer never joins a character that is not white space to white space after it, so a
text may be cut there and each chunk encoded alone. Chunks repeat, so their ids are kept in a
bounded table in each worker; what is encoded again after the table was emptied comes out the same.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

# The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"

_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WORD = re.compile(f"[^{WHITE}]+")
_RARE_WHITE = [c for c in map(chr, range(0x85, 0x3001)) if re.match(f"[{WHITE}]", c)]
_DOUBLE = ("  ", "\n\n", " \n", "\n ")

#: Entries of a worker's tables; about 200 bytes each. A chunk of one piece is in the first alone.
CHUNKS_KEPT, PIECES_KEPT = 540_000, 60_000

#: Characters of text that are turned into ids between two answers of a worker.
ANSWER_CHARS = 4_000_000


def chunks(text: str) -> list[str]:
    """``text`` cut ahead of each run of white space that follows another character."""
    plain = not any(c in text for c in "\0\t\r\x0b\x0c") and not any(d in text for d in _DOUBLE)
    if plain and (text.isascii() or not any(c in text for c in _RARE_WHITE)):
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return _CHUNK.findall(text)


def words(text: str) -> list[str]:
    """``text`` without its white space, for tokenizers that drop it."""
    # Python splits at these separators as well, which are not white space here.
    return _WORD.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


class Kept(dict):
    """A table that makes missing values, in two generations: when it is full, what was used since
    the last time is kept for another round and the rest is forgotten."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most // 2, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Texts to packed little-endian ids.

    ``cut`` cuts a text into chunks, ``split`` a chunk into pieces (None: leave the chunk to
    ``whole``), and ``ids`` gives the packed ids of one piece. Strings of ``added`` are cut out first
    and have the packed ids given there; what is between them is encoded as texts of their own.
    """

    def __init__(
        self,
        cut: Callable,
        split: Callable,
        ids: Callable,
        whole: Callable | None = None,
        kept: tuple[int, int] = (CHUNKS_KEPT, PIECES_KEPT),
        added: dict[str, bytes] | None = None,
    ):
        self.chunks = Kept(self._chunk, kept[0])
        self.pieces = Kept(ids, kept[1])
        self.cut, self.split, self.whole = cut, split, whole
        self.added = added or {}
        # The longest of those that begin at one place counts.
        self.between = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def _chunk(self, chunk: str) -> bytes:
        split = self.split(chunk)
        if split is None:
            return self.whole(chunk)
        if len(split) == 1:
            return self.pieces.make(split[0])
        return b"".join(map(self.pieces.__getitem__, split))

    def __call__(self, text: str | None) -> bytes:
        if text and any(string in text for string in self.added):
            parts = self.between.split(text)
            return b"".join(self.added[p] if n % 2 else self._plain(p) for n, p in enumerate(parts))
        return self._plain(text)

    def _plain(self, text: str | None) -> bytes:
        return b"".join(map(self.chunks.__getitem__, self.cut(text))) if text else b""


# Letters below this are classed and lower-cased alike by every Unicode version; others are left to
# the tokenizer as a whole chunk.
_PLAIN_END = "ƀ"


def _plain(chunk: str) -> bool:
    return chunk.isascii() or (max(chunk) < _PLAIN_END and "İ" not in chunk)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


# What ends a word in the rank tables of vocabularies that mark the last character of a word.
_END = "\0"


def rank_encoding(tokenizer: Tokenizer, pattern: str) -> tiktoken.Encoding | None:
    """The byte-pair model of a ``tokenizers`` file as ranks, for encoding short texts at a third of the cost.

    Joining pairs by their place in the list of merges is joining by rank where the ids rise along that
    list. A mark at a word's end becomes a byte of its own, :data:`_END`, which joins the last character
    before anything else does. None for other models.
    """
    model = json.loads(tokenizer.to_str())["model"]
    suffix = model.get("end_of_word_suffix") or ""
    plain = not any(model.get(option) for option in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix"))
    if model.get("type") != "BPE" or not plain:
        return None
    letters = {letter: byte for byte, letter in byte_letters().items()}

    def spelt(token: str) -> bytes:
        ends = suffix and token.endswith(suffix)
        bare = token.removesuffix(suffix) if ends else token
        return bytes(letters[letter] for letter in bare) + (_END.encode() if ends else b"")

    joined = ["".join(pair if isinstance(pair, list) else pair.split(" ")) for pair in model["merges"]]
    vocabulary = model["vocab"]
    rising = [vocabulary[token] for token in joined]
    base = [vocabulary[letter + end] for letter in letters for end in {"", suffix}]
    if rising != sorted(set(rising)) or max(base) >= min(rising, default=len(vocabulary)):
        return None
    ranks = {spelt(token): vocabulary[token] for token in [*joined, *(letter + end for letter in letters for end in {"", suffix})]}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def library_encoder(path: str, kind: str = "I", added: bool = False) -> PieceEncoder:
    """The tokenizer of a ``tokenizers`` file.

    ``kind`` is the array type of the packed ids, ``I`` for 32 and ``H`` for 16 bits. With ``added``
    the strings of the file's added tokens become these tokens, as the library does by default;
    else they are ordinary text.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    model, letters = tokenizer.model, byte_letters()
    tokens = tokenizer.get_added_tokens_decoder() if added else {}
    if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values()):
        raise ValueError(f"{path}: an added token is not matched as it stands")
    most = (1 << (8 * array(kind).itemsize)) - 1
    if tokenizer.get_vocab_size() - 1 > most:
        raise ValueError(f"{path}: ids above {most:,} do not fit")
    strings = {t.content: array(kind, [n]).tobytes() for n, t in tokens.items()}

    def whole(chunk: str) -> bytes:
        return array(kind, tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def ids(piece: str) -> bytes:
        spelt = piece.encode().decode("latin-1").translate(letters)
        return array(kind, [token.id for token in model.tokenize(spelt)]).tobytes()

    if tokenizer.normalizer is None:
        # Fixed value: the pattern of the byte-level pre-tokenizer.
        words_of = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranked, pattern = rank_encoding(tokenizer, words_of), regex.compile(words_of)
        if ranked:

            def by_rank(chunk: str) -> bytes:
                return array(kind, ranked.encode_ordinary(chunk)).tobytes() if _plain(chunk) else whole(chunk)

            return PieceEncoder(chunks, lambda chunk: None if chunk else [], ids, by_rank, (320_000, 1), strings)

        def split(chunk: str) -> list[str] | None:
            if not chunk or not _plain(chunk):
                return None if chunk else []
            return [chunk] if chunk[0] == " " and chunk[1:].isalpha() else pattern.findall(chunk)

        return PieceEncoder(chunks, split, ids, whole, added=strings)

    # Fixed value: the pattern of the lower-casing pre-tokenizer.
    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    ranked = rank_encoding(tokenizer, "(?s).+")

    def ended(piece: str) -> bytes:
        return array(kind, ranked.encode_ordinary(piece + _END)).tobytes() if _END not in piece else ids(piece)

    def split_lower(chunk: str) -> list[str] | None:
        if not _plain(chunk):
            return None
        lowered = chunk.lower()
        return [lowered] if lowered.isalpha() else pattern.findall(lowered)

    return PieceEncoder(words, split_lower, ended if ranked else ids, whole, (740_000, PIECES_KEPT), strings)


#: How a worker lets go of the encoders that it keeps from task to task.
FORGET: list[Callable] = [library_encoder.cache_clear]


def let_go() -> None:
    """Free what the worker's encoders hold, and what Arrow keeps of earlier work."""
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()


def answers(
    batches: Iterator[pa.RecordBatch], chars: int = ANSWER_CHARS, encodes: bool = False
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``chars`` bytes of its widest columns.

    Work that ``encodes`` nothing has the worker's encoders with their tables go first.
    """
    if not encodes:
        let_go()
    for batch in batches:
        rows = max(1, int(batch.num_rows * chars / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encoding(encoder: Callable[[], PieceEncoder], end: bytes = b"") -> Callable:
    """Batches of (key, text) to batches of (``doc_id``, ``ids``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder()
        # The tables hold millions of small objects and no cycles; looking for some takes longer
        # than the work.
        gc.disable()
        try:
            for part in answers(batches, encodes=True):
                packed = [of(text) + end for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary())], ["doc_id", "ids"]
                )
        finally:
            gc.enable()

    return run


def encode(
    docs: DataFrame, encoder: Callable[[], PieceEncoder], end: bytes = b"", then: Callable | None = None, schema: str = ""
) -> DataFrame:
    """``doc_id, ids``: the packed ids of every whole text followed by ``end``; NULL is empty.

    ``encoder`` is called in the worker, so that tokenizers are loaded there once and not sent.
    ``then`` goes on with the batches in the same worker and makes ``schema`` after ``doc_id``.
    """
    kind = dict(docs.dtypes)["doc_id"]
    first = encoding(encoder, end)
    run = (lambda batches: then(first(batches))) if then else first
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {schema or 'ids binary'}")
