"""Byte-pair encoding and decoding.

The encoder walks a piece of text once and keeps a stack of tokens. An Aho-Corasick automaton gives the longest token at
each place; a token may follow another only if that pair is what the merges themselves would leave (pair compatibility);
otherwise a shorter token is tried, and when there is none, the last token is taken back and marked. Each place is left
for good at most once, so the work is linear. The result is exactly that of applying the merges in rank order.

Decoding cuts each token's bytes out of one long byte string by a table of offsets.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import HELD_LENGTH, numbered, place_of, rows

#: Fixed value: how byte-level BPE of this family cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, pieces of longer chunks and pairs that a worker remembers (words and pieces in each of two generations).
WORDS_HELD, PIECES_HELD, PAIRS_HELD = 200_000, 10_000, 100_000
#: Texts are decoded in runs of about so many tokens, which bounds memory.
DECODE_TOKENS = 1_000_000


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by its rule: visible Latin-1 bytes stand for themselves, the rest for U+0100 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE file (tokenizer.json): merges, longest matches, pair compatibility, offsets.

    Tokens are numbers below size; what is known of each is kept in lists by token, and a pair is the number left * size + right.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.specials = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        n = self.size = 1 + max([*vocab.values(), *self.specials.values()])
        bytes_of: list[bytes] = [b""] * n
        for token, i in vocab.items():
            bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.specials.items():
            bytes_of[i] = token.encode()
        # rank: bytes first, then merged tokens in merge order; ids may be in another order. -1: no token of merges
        self.byte_id = {bytes_of[i][0]: i for i in vocab.values() if len(bytes_of[i]) == 1}
        self.pair: dict[int, int] = {}
        self.rank, self.first, self.second = [-1] * n, list(range(n)), list(range(n))
        ranked = sorted(self.byte_id.values())
        for k, i in enumerate(ranked):
            self.rank[i] = k
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made, left, right = vocab[left + right], vocab[left], vocab[right]
            self.pair[left * n + right] = made
            if self.rank[made] < 0:
                self.rank[made] = len(ranked)
                ranked.append(made)
                self.first[made], self.second[made] = left, right
        self.ranks = len(ranked)
        self.automaton = ahocorasick.Automaton()
        for i in ranked:
            self.automaton.add_word(bytes_of[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.length = [len(b) for b in bytes_of]
        known = {bytes_of[i]: i for i in ranked}
        self.shorter: list[int | None] = [None] * n
        for b, i in known.items():
            self.shorter[i] = next((known[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in known), None)
        self.fits_known: dict[int, bool] = {}
        # tokens that encode to themselves alone; the others are never whole pieces
        self.known = {b: i for b, i in known.items() if self.first[i] == i or self.fits_inside(i)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int32)
        self.blob = np.frombuffer(b"".join(bytes_of), np.uint8)

    def fits_inside(self, token: int) -> bool:
        """Whether the merges make this token of its own bytes: they leave its last two parts standing until they join them."""
        return self.fits(self.first[token], self.second[token], self.rank[token])

    def fits(self, left: int, right: int, but: int | None = None) -> bool:
        """Whether the merges leave this pair standing: no merge across the border comes before the merges that made both sides.

        but: the rank of a merge of just this pair, which is then left out.
        """
        n = self.size
        key = left * n + right
        rank, first, second, pair = self.rank, self.first, self.second, self.pair
        limit, good = self.ranks, True
        while True:
            made = pair.get(left * n + right)
            if made is not None and rank[made] < limit and rank[made] != but:
                good = False
                break
            # undo the later of the two merges on its side of the border
            if rank[left] > rank[right]:
                limit, inner = rank[left], second[left]
                if inner == left:  # a single byte: then the other side must be undone
                    if first[right] == right:
                        break
                    limit, right = rank[right] + 1, first[right]
                else:
                    left = inner
            else:
                inner = first[right]
                limit = rank[right] + 1
                if inner == right:
                    if second[left] == left:
                        break
                    limit, left = rank[left], second[left]
                else:
                    right = inner
        if but is None:
            if len(self.fits_known) >= PAIRS_HELD:
                self.fits_known.clear()
            self.fits_known[key] = good
        return good

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece, which no token may leave."""
        if (whole := self.known.get(piece)) is not None:
            return [whole]  # a token that the merges make is what they make of its bytes
        n = len(piece)
        length, size = self.length, self.size
        longest: list[int] = [self.byte_id[b] for b in piece]
        # matches come by their ends, longest first; of those with one start the last is the longest
        for end, i in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length[i] + 1] = i
        fits_known, fits, shorter = self.fits_known, self.fits, self.shorter
        out: list[int] = []
        closed: set[int] = set()
        at, token = 0, longest[0] if n else None
        while token is not None:
            end = at + length[token]
            if end not in closed:
                if out:
                    good = fits_known.get(out[-1] * size + token)
                    if good is None:
                        good = fits(out[-1], token)
                else:
                    good = True
                if good:
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else None
                    continue
            token_less = shorter[token]
            if token_less is not None:
                token = token_less
                continue
            closed.add(at)
            token = out.pop()  # it led nowhere: its end is closed, so a shorter one follows
            at -= length[token]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, cut from one byte string by the offset table."""
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths, dtype=np.int32)
        index = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        index += np.repeat(starts - ends + lengths, lengths)
        return self.blob[index].tobytes()


class _Recent(dict):
    """A bounded memory of two generations: what was used lately outlives what was not. Long keys are not remembered."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        if len(key) > HELD_LENGTH:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@functools.lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary of a file, built once in each worker process and used by all of its tasks."""
    return Vocabulary(path)


def chunk_encoder(vocabulary: Vocabulary) -> _Recent:
    """Ids (little-endian bytes) by word, for the word with a space before it. Such chunks never share a piece, so each is encoded alone."""
    find = regex.compile(PIECES).findall

    def one(piece: str) -> bytes:
        return array("I", vocabulary.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()

    pieces = _Recent(one, PIECES_HELD)

    def make(chunk: str) -> bytes:
        found = find(chunk)
        return one(chunk) if len(found) == 1 else b"".join([pieces[x] for x in found])

    def of_word(word: str) -> bytes:
        # letters with a space before them are one piece
        return one(" " + word) if word.isascii() and word.isalpha() else make(" " + word)

    made = _Recent(of_word, WORDS_HELD)
    made.vocabulary, made.chunk = vocabulary, make
    return made


#: What either library takes for white space.
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_RUNS = [x for c in _SPACES for x in dict.fromkeys((c + " ", " " + c))]
_EDGE = re.compile(r"(?<=[^\s]) (?=[^\s])")


def encode(text: str, chunks: _Recent) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers; the strings of special tokens become those tokens."""
    cut = chunks.vocabulary.cut
    specials = chunks.vocabulary.specials
    if cut is not None and any(x in text for x in specials):
        parts = cut.split(text)
        return b"".join(np.array([specials[x]], "<u4").tobytes() if x in specials else encode(x, chunks) for x in parts)
    if not text:
        return b""
    # A single space between two visible characters always begins a piece.
    parts = _EDGE.split(text) if any(x in text for x in _RUNS) else text.split(" ")
    return chunks.chunk(parts[0]) + b"".join(map(chunks.__getitem__, parts[1:]))


def bpe_encode(docs: DataFrame, path: str, decode: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, token_ids array<int>, n_tokens) for each row, and with decode also text, which is what the ids decode to.

    Null text: as empty, no tokens. Equal rows: equal results, each row kept. No rows: an empty table. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_encoder(vocabulary_of(path))
        for batch in rows(batches, 64):
            ids = [np.frombuffer(encode(t or "", chunks), "<u4").view("<i4") for t in batch.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            texts = [pa.array([chunks.vocabulary.decode(x).decode("utf-8", "replace") for x in ids], pa.string())] if decode else []
            yield pa.record_batch([batch.column(0), lists, pa.array(np.diff(ends).astype(np.int64)), *texts], names)

    names = [id_column, "token_ids", "n_tokens", *([text_column] if decode else [])]
    texts = numbered(docs).select(place_of(docs, id_column), place_of(docs, text_column))
    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(run, f"`{id_column}` {kind}, token_ids array<int>, n_tokens long" + f", `{text_column}` string" * decode)


def bpe_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the encoder and decoder of bpe_encode, with digests instead of the long columns.

    Null text: as empty, 0 tokens and the digests of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_encoder(vocabulary_of(path))
        vocabulary = chunks.vocabulary
        for batch in rows(batches, 256):
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode(text or "", chunks)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                numbers, back = np.frombuffer(ids, "<u4"), b""
                if len(numbers) <= DECODE_TOKENS:
                    back = vocabulary.decode(numbers)
                else:
                    back = b"".join(vocabulary.decode(numbers[i : i + DECODE_TOKENS]) for i in range(0, len(numbers), DECODE_TOKENS))
                # decoders give text: bytes that are no UTF-8 become U+FFFD
                of_text.append(hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names)

    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = numbered(docs).select(place_of(docs, id_column), place_of(docs, text_column))
    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
