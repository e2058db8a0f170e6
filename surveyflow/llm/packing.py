"""Packing of tokenized documents into sequences by vector best fit.

``pieces`` tokenizes whole texts and cuts the long ones. ``pack`` deals the pieces out by hash and
packs each share as a stream in groups of bounded size, longest first: of all open sequences that
have room for a piece in every respect (tokens, documents, attention cost), the one with the best
weighted fit takes it. A group leaves about one sequence half full, so the loss is a small fraction
of a percent, and no task ever holds more than a group.

Edge cases: a null or empty text is the end token alone; repeated rows are packed once each; an
empty table gives an empty result. Only key and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from surveyflow.functions.cells import quoted
from surveyflow.llm.bpe import LETTER_RUNS, LONGEST_PIECE, Memo, PieceCoder
from surveyflow.llm.common import held, in_batches, slices, texts

CAPACITY = 2048
#: Bound of the pieces a Python worker remembers, some 200 bytes each.
MOST_PIECES = 1_800_000
#: Pieces packed together; shares of the input per task are about four times as large.
GROUP = 16384
#: Share of tokens, documents and attention cost in the fit.
WEIGHTS = (1.0, 0.01, 0.01)


class Recent(Memo):
    """A memo in two halves: what is still asked for moves from the older half to the newer one, the rest goes."""

    def __init__(self, make, most: int, longest: int):
        super().__init__(make, most // 2, longest)
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class RunOfSpaces(Exception):
    """A part that a text must not be cut before."""


class Parts(PieceCoder):
    """As its base, but runs of white space show up as parts that no memo holds, not by a search of every text."""

    def _part(self, part: str) -> bytes:
        if not part or part[0].isspace() or "\x1c" <= part[0] <= "\x1f":
            raise RunOfSpaces
        return super()._part(part)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        rest = text.split(" ")
        head = rest.pop(0)
        try:
            return (self.first[head] if head else b"") + b"".join(map(self.later.__getitem__, rest))
        except RunOfSpaces:
            return self.slow(text)


class Tokens:
    """A tokenizer file's ids, with pieces remembered.

    Cutting before a space changes nothing for a byte-level pre-tokenizer, except where a special
    token's string stands in the text; such texts, and those with runs of spaces, go in whole, as
    do all texts of other kinds of tokenizers.
    """

    def __init__(self, path: str, remember: int = MOST_PIECES):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        split = self.tokenizer.pre_tokenizer
        bytewise = isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        self.known = bytewise and self.tokenizer.normalizer is None
        self.split, self.model = getattr(split, "pre_tokenize_str", None), self.tokenizer.model
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in visible]
        #: The character that stands for each byte.
        self.shown = "".join(chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256))
        self.pieces, self.plain = (Memo(make, remember // 16, LONGEST_PIECE) for make in (self.piece, self.letters))
        self.runs = regex.compile(LETTER_RUNS)
        self.coder = Parts(self.chunk, self.whole, self.letters, remember, Recent) if self.known else None

    def piece(self, piece: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()

    def letters(self, piece: str) -> bytes:
        return self.piece(charmap_decode(piece.encode(), "strict", self.shown)[0])

    def chunk(self, text: str) -> bytes:
        if text.isascii():  # the splitter's own pattern, without its offsets; categories of ASCII never change
            return b"".join(map(self.plain.__getitem__, self.runs.findall(text)))
        return b"".join([self.pieces[piece] for piece, _ in self.split(text)])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def packed(self, text: str | None) -> bytes:
        if text and (not self.known or any(s in text for s in self.special)):
            return self.whole(text)
        return self.coder.packed(text) if text else b""


def tokens(path: str, remember: int = MOST_PIECES) -> Tokens:
    """A tokenizer, kept by a Python worker until it works for another operator."""
    return held(("tokenizer", path, remember), lambda: Tokens(path, remember))


def pieces(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    remember: int = MOST_PIECES,
) -> DataFrame:
    """doc_id, piece, start, length and ids (packed unsigned 32-bit, little-endian) of every document.

    A document is its ids and ``end_id``. One longer than ``capacity`` is cut into pieces of just
    that length, the first being the shorter one. ``tokenizer``: path of a tokenizer file.
    ``remember``: pieces that a worker keeps, more for speed and fewer for memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, last = tokens(tokenizer, remember), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            row, number, start, length, ids = [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                packed = coder.packed(t) + last
                n = len(packed) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row.append(i)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(packed[4 * a : 4 * b])
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    rows = texts(df, key, text)
    fields = [("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids", BinaryType())]
    return in_batches(rows).mapInArrow(run, StructType([rows.schema["doc_id"], *(StructField(n, t) for n, t in fields)]))


def best_fit(
    lengths: np.ndarray, limits: tuple[int, int, int], weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences.

    ``limits``: most tokens, documents and attention cost (sum of squared lengths) of a sequence.
    ``rule``: ``norm`` takes the sequence whose residual is smallest afterwards, ``dot`` the one
    whose residual before is best aligned with the piece; earlier sequences win ties.
    """
    limit = np.array(limits, "f8")
    scale = np.array(weights) / limit**2
    where, offset = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    free = np.empty((3, 1024))
    names = np.empty(1024, "i8")
    opened = used = 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min(initial=limits[0]))
    for at, i in enumerate(order.tolist()):
        n = int(lengths[i])
        need = np.array([n, 1, n * n], "f8")
        room = free[:, :opened]
        fits = (room[0] >= n) & (room[1] >= 1) & (room[2] >= need[2])
        if rule == "norm":
            left = room - need[:, None]
            cost = scale @ (left * left)
        else:
            cost = -((scale * need) @ room)
        best = int(np.where(fits, cost, np.inf).argmin()) if opened else -1
        if best < 0 or not fits[best]:
            if opened == free.shape[1]:
                free, names = np.concatenate([free, np.empty_like(free)], 1), np.concatenate([names, np.empty_like(names)])
            best, names[opened] = opened, used
            free[:, opened] = limit
            opened, used = opened + 1, used + 1
        where[i], offset[i] = names[best], limits[0] - free[0, best]
        free[:, best] -= need
        if free[0, best] < least or free[1, best] < 1:  # full: keep the others in their order
            free[:, best : opened - 1] = free[:, best + 1 : opened].copy()
            names[best : opened - 1] = names[best + 1 : opened].copy()
            opened -= 1
    return where, offset, used


def pack(
    df: DataFrame,
    length: str = "length",
    capacity: int = CAPACITY,
    most_documents: int | None = None,
    most_attention: int | None = None,
    group: int = GROUP,
    rule: str = "norm",
) -> DataFrame:
    """``df`` (small rows, of lengths up to ``capacity``) with sequence_id and offset.

    Limits on documents and attention cost default to what the tokens allow. Columns of these two
    names are replaced. ``df`` is read twice and should be a stored table.
    """
    limits = (capacity, most_documents or capacity, most_attention or capacity**2)
    rows = df.drop("sequence_id", "offset")
    shares = max(1, -(-rows.count() // (4 * group)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33

        def packed(group_rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            part = pa.Table.from_batches(group_rows).combine_chunks()
            where, offset, used = best_fit(part.column(length).to_numpy(), limits, rule=rule)
            part = part.append_column("sequence_id", pa.array(where + number)).append_column("offset", pa.array(offset))
            number += used
            yield from part.to_batches()

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = group - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in waiting) == group:
                    yield from packed(waiting)
                    waiting = []
        if waiting:
            yield from packed(waiting)

    columns = [quoted(c) for c in rows.columns]
    dealt = rows.repartition(shares, F.xxhash64(*columns)).sortWithinPartitions(*columns)
    schema = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return in_batches(dealt).mapInArrow(run, schema)


