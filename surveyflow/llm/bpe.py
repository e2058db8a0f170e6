"""Byte-level BPE: exact merges in linear time by backtracking over longest matches.

Bytes are read as Latin-1 characters, so that pyahocorasick finds every vocabulary token in a text
in one pass. Encoding takes the longest token at each place; a token is accepted when it can stand
next to its left neighbour, that is, when plain merging would not have joined them otherwise. That
test is remembered for each pair. A place from which nothing can follow is never tried twice.

Edge cases: a null text encodes as the empty one; null ids decode to null; an id outside the
vocabulary raises; repeated rows are encoded alike; an empty table gives an empty result. Only key
and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from surveyflow.llm.common import held, in_batches, slices, texts

#: Bounds of what a Python worker remembers: pieces, their characters, and pairs of tokens.
MOST_PIECES, LONGEST_PIECE, MOST_PAIRS = 500_000, 48, 500_000
#: A space that may belong to a run of white space; elsewhere a text can be cut before a space.
RUN = re.compile(r" (?=\s|\Z)")


class Memo(dict):
    """A dictionary that makes missing values and is emptied when full."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


#: Fixed value: the splitting pattern for which a run of letters after a space is a piece by itself.
LETTER_RUNS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class PieceCoder:
    """Packed little-endian ids of whole texts, put together from those of their pieces.

    A text is cut before every space that a visible character follows; no match of a pattern with
    optional leading spaces crosses such a cut. Texts with other spaces are cut by ``slow``. With
    ``piece``, a part of letters alone is known to be one piece, and so is a mark behind it.
    """

    def __init__(self, chunk, slow, piece=None, most: int = MOST_PIECES, memo: type[Memo] = Memo):
        self.first = Memo(chunk, most // 20, LONGEST_PIECE)
        self.later = memo(self._part, most, LONGEST_PIECE)
        self.chunk, self.slow, self.piece = chunk, slow, piece
        self.marks = {mark: chunk(mark) for mark in ",."} if piece else {}

    def _part(self, part: str) -> bytes:
        if self.piece:
            if part.isalpha():
                return self.piece(" " + part)
            if part[-1] in self.marks and part[:-1].isalpha():
                return self.later[part[:-1]] + self.marks[part[-1]]
        return self.chunk(" " + part)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if RUN.search(text):
            return self.slow(text)
        head, *rest = text.split(" ")
        return (self.first[head] if head else b"") + b"".join(map(self.later.__getitem__, rest))


class Vocabulary:
    """Ranks of byte strings, and what encoding and decoding derive from them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.bytes_of = {rank: raw for raw, rank in ranks.items()}
        self.size = {rank: len(raw) for raw, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for raw, rank in ranks.items():
            self.automaton.add_word(raw.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = {
            rank: next((ranks[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in ranks), None)
            for raw, rank in ranks.items()
        }
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for raw, rank in sorted(ranks.items(), key=lambda item: item[1]):
            self._find_halves(raw, rank)
        self.seams: dict[tuple[int, int], bool] = {}
        self.pieces = Memo(self._piece, MOST_PIECES // 8, LONGEST_PIECE)
        self.coder = PieceCoder(self._chunk, self._chunk, self._piece if pattern == LETTER_RUNS else None)

    def _find_halves(self, raw: bytes, rank: int) -> None:
        """The two tokens whose merge makes this one; a token that merging never makes has none."""
        left = self.shorter[rank]
        while left is not None:
            right = self.ranks.get(raw[self.size[left] :])
            if right is not None and left < rank and right < rank and self._can_meet(left, right):
                self.joined[left, right] = rank
                self.halves[rank] = (left, right)
                return
            left = self.shorter[left]

    def _can_meet(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side.

        Merges are undone at the seam, latest first. A merge over the seam that ranks before the
        one just undone would have come first, and then these two tokens would not both exist.
        """
        bound = 1 << 62
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < bound:
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                bound, left = left, a[1]
            else:
                bound, right = right + 1, b[0]

    def _fits(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.seams.get(pair)
        if known is None:
            if len(self.seams) >= MOST_PAIRS:
                self.seams.clear()
            known = self.seams[pair] = self._can_meet(left, right)
        return known

    def encode_piece(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        text = raw.decode("latin-1")
        greedy = [token for _, token in self.automaton.iter_long(text)]
        if all(map(self._fits, greedy, greedy[1:])):  # the longest tokens stand together: no backtracking
            return greedy
        size, shorter = self.size, self.shorter
        longest: list[int] = [0] * len(raw)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - size[token]] = token
        dead = bytearray(len(raw) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + size[token]
            if not dead[end] and (not out or self._fits(out[-1], token)):
                out.append(token)
                at = end
                if at == len(raw):
                    return out
                token = longest[at]
            elif shorter[token] is not None:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]

    def _piece(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}i", *ids)

    def _chunk(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.coder.packed(text), "<i4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a rank file, kept by a Python worker until it works for another operator."""

    def read() -> Vocabulary:
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)

    return held(("ranks", path, pattern), read)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text; rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in slices(batches):
            packed = [words.coder.packed(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype("i4")
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
            ids = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows = texts(df, key, text)
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("ids", ArrayType(IntegerType()))])
    return in_batches(rows).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids in the column ``out`` (replaced if there is one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in slices(batches):
            column = batch.column(names.index(ids))
            values, ends = column.flatten().to_numpy(), np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
            decoded = [
                words.decode(values[a:b].tolist()) if known else None
                for a, b, known in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(decoded, pa.binary())], [*(names[i] for i in kept), out])

    names = df.columns
    kept = [i for i, name in enumerate(names) if name != out]
    return in_batches(df).mapInArrow(run, StructType([*(df.schema.fields[i] for i in kept), StructField(out, BinaryType())]))
