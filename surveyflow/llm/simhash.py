"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint keeps the bits that most of a text's word shingles set in their hash. Fingerprints
within ``RADIUS`` bits agree in at least two of six blocks, so fifteen keys of two blocks each bring
every such pair together. Within a key the fingerprints are stored as vertical bit planes, 64 to a
word: a shift by d compares every one with its d-th neighbour, carry-save counters add up 64
distances at once, and words whose lanes all exceed the radius are abandoned. Lanes that are already
connected need no comparison, so a dense group costs few shifts, and only a star of edges leaves it.

Edge cases: equal fingerprints are one node, whatever their number; a null text and one without
words have fingerprint zero and link like any other; null ids never become a component's id unless
it has no other; repeated rows are kept; an empty table gives an empty result. Only key and text are
read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import held, in_batches, stored, texts
from surveyflow.llm.components import components

WORDS = 4
RADIUS = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
SEED = 42
#: Fingerprints of one key that are compared as one group; larger groups are split into pairs of parts.
PART = 4096
#: Rows compared at a time, and shingles whose bits are counted at a time.
ROWS, SHINGLES = 65536, 65536
PLANES = 8


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of a text's lower-cased (A-Z) word shingles."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False)) if len(parts) >= words else [b" ".join(parts)]
    hashed = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashed), SHINGLES):
        some = hashed[at : at + SHINGLES]
        ones += np.unpackbits(some.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, with_text_id: bool = False) -> DataFrame:
    """doc_id and fingerprint (long, two's complement) of every row, and if asked for the hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("simhash", dict)
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], "u8").view("i8")
            more = batch.columns[2:]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), *more], ["doc_id", "fingerprint", "text_id"][: 2 + len(more)])

    rows = texts(df, key, text)
    fields = [rows.schema["doc_id"], StructField("fingerprint", LongType())]
    if with_text_id:
        rows = rows.withColumn("text_id", F.xxhash64("text"))
        fields.append(StructField("text_id", LongType()))
    return in_batches(rows).mapInArrow(run, StructType(fields))


def keyed(prints: DataFrame) -> DataFrame:
    """(key, fingerprint): fifteen keys each, of two blocks and the number of the pair."""
    shift, blocks = 0, []
    for width in BLOCKS:
        blocks.append((F.shiftrightunsigned("fingerprint", shift).bitwiseAND(F.lit((1 << width) - 1)), width))
        shift += width
    keys = [
        F.shiftleft(F.shiftleft(F.lit(number).cast("long"), 11).bitwiseOR(a), 11).bitwiseOR(b)
        for number, ((a, _), (b, _)) in enumerate(combinations(blocks, 2))
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fingerprint")


class Planes:
    """Vertical bit planes of a run of fingerprints and the distances between shifted copies."""

    def __init__(self, prints: np.ndarray):
        self.words = -(-len(prints) // 64)
        bits = np.zeros((64 * (2 * self.words + 1), 64), "u1")
        bits[: len(prints)] = np.unpackbits(prints.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(bits, axis=0, bitorder="little")
        self.planes = np.ascontiguousarray(packed.T).view("<u8")

    def close(self, shift: int, lanes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
        """Places i of ``lanes`` (booleans) where the fingerprints at i and i + shift are within the radius."""
        wanted = np.zeros(64 * self.words, bool)
        wanted[: len(lanes)] = lanes
        alive = np.packbits(wanted, bitorder="little").view("<u8")
        at = np.flatnonzero(alive)
        alive = alive[at]
        far, near = divmod(shift, 64)
        count = [np.zeros(len(at), "<u8") for _ in range(3)]
        over = np.zeros(len(at), "<u8")
        for plane in range(0, 64, PLANES):
            low = self.planes[plane : plane + PLANES, at + far]
            if near:
                high = self.planes[plane : plane + PLANES, at + far + 1]
                low = (low >> np.uint64(near)) | (high << np.uint64(64 - near))
            differ = self.planes[plane : plane + PLANES, at] ^ low
            for four in range(0, PLANES, 4):  # carry-save: four planes go in, one carry of weight four comes out
                a, b, c, d = differ[four : four + 4]
                ones, carry = _add(count[0], a, b)
                count[0], more = _add(ones, c, d)
                count[1], carry = _add(count[1], carry, more)
                over |= count[2] & carry
                count[2] = count[2] ^ carry
            alive &= ~(over | _more_than(count, radius))
            left = np.flatnonzero(alive)
            if len(left) < len(at):
                at, alive, over = at[left], alive[left], over[left]
                count = [c[left] for c in count]
            if not len(at):
                break
        word, lane = np.nonzero(np.unpackbits(alive.view("u1").reshape(-1, 8), axis=1, bitorder="little"))
        return at[word] * 64 + lane


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bits in every lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _more_than(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose three-bit count exceeds ``radius`` (0 to 7)."""
    more, same = np.zeros_like(count[0]), np.full_like(count[0], np.iinfo("u8").max)
    for bit in (2, 1, 0):
        if radius >> bit & 1:
            same = same & count[bit]
        else:
            more = more | (same & count[bit])
            same = same & ~count[bit]
    return more


def link_groups(group: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows in order of ``group``: the row that stands for each row's component within its group."""
    n = len(prints)
    root = np.arange(n)
    if n < 2:
        return root
    edge = np.flatnonzero(np.diff(group)) + 1
    ends = np.repeat(np.r_[edge, n], np.diff(np.r_[0, edge, n]))
    after = ends - np.arange(n) - 1  # rows of the group that follow
    planes, joined, parent = Planes(prints), False, list(range(n))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for shift in range(1, int(after.max()) + 1):
        lanes = after >= shift
        if joined:
            lanes[: n - shift] &= root[: n - shift] != root[shift:]
        if not lanes.any():
            if joined and not _open(group, root, after, shift):
                break
            continue
        found = planes.close(shift, lanes, radius)
        for i in found.tolist():
            a, b = top(i), top(i + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(found):
            joined = True
            root = np.array(parent)
            while not np.array_equal(up := root[root], root):
                root = up
            parent = root.tolist()
    return root


def _open(group: np.ndarray, root: np.ndarray, after: np.ndarray, shift: int) -> bool:
    """Whether a group that reaches beyond ``shift`` still has more than one component."""
    reach = after >= shift
    first = np.searchsorted(group, group[reach])
    return bool((root[reach] != root[first]).any())


def links(prints: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Edges (a, b) that connect just those distinct fingerprints which chains of links connect.

    ``prints``: distinct fingerprints, a stored table. Keys with more than ``part`` fingerprints are
    few; they are counted first and their groups dealt out as pairs of parts.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("the keys find pairs within 4 bits")
    keys = keyed(prints)
    hot = stored(keys.groupBy("key").count().filter(F.col("count") > part), "hot-keys")
    parts = F.ceil(F.coalesce("count", F.lit(1)) / part).cast("int")
    own, other = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"), F.col("other")
    dealt = (
        keys.join(hot, "key", "left")
        .withColumn("parts", parts)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least(own, other).alias("p"), F.greatest(own, other).alias("q"), "fingerprint")
        .repartition("key", "p", "q")
        .sortWithinPartitions("key", "p", "q", "fingerprint")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: np.ndarray) -> pa.RecordBatch:
            change = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)]
            group = np.cumsum(change)
            several = np.bincount(group)[group] > 1
            group, prints = group[several], np.ascontiguousarray(rows[several, 3])
            root = link_groups(group, prints.view("u8"), radius)
            tied = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays([pa.array(prints[root[tied]]), pa.array(prints[tied])], ["a", "b"])

        held = np.empty((0, 4), "i8")
        for batch in batches:
            rows = np.stack([c.to_numpy().astype("i8") for c in batch.columns], 1)
            held = np.concatenate([held, rows])
            if len(held) >= ROWS:
                cut = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(1))
                if len(cut):
                    yield linked(held[: cut[-1] + 1])
                    held = held[cut[-1] + 1 :]
        if len(held):
            yield linked(held)

    return in_batches(dealt).mapInArrow(run, "a long, b long")


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """(fingerprint, component, component_id): a fingerprint that stands for the component, and the smallest id in it.

    ``prints``: fingerprint and ``least``, the smallest id that has it.
    """
    tied = components(links(stored(prints.select("fingerprint"), "distinct"), radius), "simhash")
    tied = tied.withColumnRenamed("node", "fingerprint")
    members = tied.union(tied.select(F.col("component").alias("fingerprint"), "component").distinct())
    members = members.join(prints, "fingerprint")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = members.join(smallest, "component").select("fingerprint", "component", "component_id")
    named = prints.join(named, "fingerprint", "left")
    return named.select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"), F.coalesce("component_id", "least").alias("component_id")
    )


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id that links reach."""
    rows = stored(fingerprints(df, key, text, words), "fingerprints")
    named = _named(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), radius).drop("component")
    named = stored(named, "named")  # a plain join of two tables: Spark can split a fingerprint that very many rows share
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``df`` with one row of each component: that of the smallest id, a null id last, then of the least text hash.

    Rows equal in id and text are one; which of them stays is open where further columns differ.
    """
    rows = stored(fingerprints(df, key, text, words, with_text_id=True), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id"))
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), best.alias("best"))
    prints = stored(prints, "prints")
    named = _named(prints.select("fingerprint", "least"), radius)
    first = prints.join(named, "fingerprint").groupBy("component").agg(F.min("best").alias("best"))
    first = stored(first.select(F.col("best.doc_id").alias("_key"), F.col("best.text_id").alias("_text")).distinct(), "firsts")
    own = df.withColumn("_own", F.xxhash64(quoted(text).cast("string")))
    kept = own.join(first, quoted(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_text")), "left_semi")
    return kept.dropDuplicates([key, "_own"]).drop("_own")
