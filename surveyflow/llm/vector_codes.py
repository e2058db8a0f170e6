"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

Vectors are made whole numbers and cut into equal parts. Every task gathers its rows into slabs and,
for each part position, sorts the slab's points along a Hilbert curve and cuts them into flat blocks
that store their box (least and greatest coordinates), sums and count. The blocks are written once.

A round reads them with the present codebook. The least distance of an entry to a box, and the
greatest one, bound all distances to the block's points: an entry further than some other entry's
greatest distance cannot be nearest to any of them. What is left is the block's shortlist. A shortlist
of one entry takes the block's stored sums without a look at its points; the others are evaluated
against their shortlist alone, blocks of like shortlist length together, in exact whole numbers.
Tasks hand on one sum per entry and coordinate, so what is shuffled and collected is of the codebooks' size.

Defined results: vectors that are null or hold null or non-finite components are dropped; shorter
vectors count as filled up with zeros to the longest one's parts; fewer rows than entries give as many
entries as rows; among rows of one id the least vector comes first as a seed, null ids come last; equal
rows are coded each; an empty table gives an empty result. Components beyond ``largest`` raise, as
squared distances would no longer fit a long (some 2^26 at 64 components). Only key, vector and label are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import in_batches, narrow_side, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows of a slab and points of a block.
SLAB, BLOCK = 16_384, 64
#: Distances held at a time by the kernel.
KERNEL = 1 << 20
#: Bits a coordinate has on the Hilbert curve.
CURVE_BITS = 10
#: Labels up to this number are joined back by broadcast.
FEW_LABELS = 1_000_000

SLAB_SCHEMA = "ids array<long>, labels array<string>, sizes array<int>, points array<binary>, orders array<binary>, boxes array<binary>"


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label (as text) and v, the components as floor(scale * x), of usable rows."""
    v = quoted(vector).cast("array<double>")
    usable = v.isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("long"))
    return df.filter(usable).select(
        quoted(key).cast("long").alias("vec_id"), quoted(label).cast("string").alias("label"), whole.alias("v")
    )


def largest(length: int) -> int:
    """Greatest whole component: ``length`` squared differences of four times this add up within a long."""
    return min(int((2**63 / max(length, 1)) ** 0.5 / 4) - 1, 2**31 - 1)


def hilbert_order(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Positions of the points (rows of whole numbers) in the order of a Hilbert curve over their box."""
    rows, width = points.shape
    if not rows or not width:
        return np.arange(rows)
    low = points.min(0)
    spread = np.maximum(points.max(0) - low, 1).astype(np.float64)
    axes = ((points - low) / spread * ((1 << bits) - 1)).astype(np.int64).T.copy()
    # From the coarsest bit on, each axis inverts or exchanges the finer bits of the first one.
    bit = 1 << (bits - 1)
    while bit > 1:
        finer = bit - 1
        for axis in axes:
            inverted = (axis & bit) != 0
            swapped = np.where(inverted, 0, (axes[0] ^ axis) & finer)
            axes[0] = np.where(inverted, axes[0] ^ finer, axes[0] ^ swapped)
            axis ^= swapped
        bit >>= 1
    for at in range(1, width):
        axes[at] ^= axes[at - 1]
    flips, bit = np.zeros(rows, np.int64), 1 << (bits - 1)
    while bit > 1:
        flips = np.where(axes[-1] & bit, flips ^ (bit - 1), flips)
        bit >>= 1
    axes ^= flips
    digits = [((axes >> b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)]
    words = np.packbits(np.concatenate(digits), axis=0)  # one column of big-endian bytes a point
    return np.lexsort(words[::-1])


def _boxes(points: np.ndarray) -> np.ndarray:
    """(blocks, 3, width): least, greatest and sum of the coordinates of each block of sorted points."""
    starts = np.arange(0, len(points), BLOCK)
    return np.stack([f.reduceat(points, starts, axis=0) for f in (np.minimum, np.maximum, np.add)], axis=1)


def slabs(df: DataFrame, parts: int, width: int) -> DataFrame:
    """Rows (vec_id, label, v) as slabs of sorted blocks, one row a slab; ``width`` coordinates a part."""
    length = parts * width
    most = largest(length)

    def slab(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        v = table.column("v").combine_chunks()
        sizes = np.diff(v.offsets.to_numpy())
        flat = v.flatten().to_numpy(zero_copy_only=False)
        if flat.size and max(abs(int(flat.min())), abs(int(flat.max()))) > most:
            raise ValueError(f"a whole component exceeds {most}: squared distances would not fit a long")
        matrix = np.zeros((len(sizes), length), np.int64)
        matrix[np.arange(length) < sizes[:, None]] = flat
        points, orders, boxes = [], [], []
        for part in range(parts):
            own = matrix[:, part * width : (part + 1) * width]
            order = hilbert_order(own)
            own = own[order]
            points.append(own.astype(np.int32).tobytes())
            orders.append(order.astype(np.uint16).tobytes())
            boxes.append(_boxes(own).tobytes())
        return pa.RecordBatch.from_pydict(
            {
                "ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
                "sizes": pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
                "points": pa.array([points], pa.list_(pa.binary())),
                "orders": pa.array([orders], pa.list_(pa.binary())),
                "boxes": pa.array([boxes], pa.list_(pa.binary())),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                free = SLAB - sum(b.num_rows for b in held)
                held.append(batch.slice(0, free))
                batch = batch.slice(free)
                if sum(b.num_rows for b in held) == SLAB:
                    yield slab(held)
                    held = []
        if held:
            yield slab(held)

    return in_batches(df).mapInArrow(run, SLAB_SCHEMA)


def shortlists(boxes: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(blocks, entries) truth: entries that can be nearest, ties included, to some point of the block's box.

    Two tests by distances of boxes: an entry goes if its least distance exceeds the greatest one of
    another entry, or if at every corner, so in the whole box, the entry nearest to the middle is nearer.
    """
    low, high = boxes[:, 0, None, :], boxes[:, 1, None, :]
    outside = np.maximum(np.maximum(low - entries, entries - high), 0)
    furthest = np.maximum(np.abs(entries - low), np.abs(high - entries))
    least, greatest = (outside * outside).sum(-1), (furthest * furthest).sum(-1)
    from_middle = low + high - 2 * entries
    centre = entries[(from_middle * from_middle).sum(-1).argmin(1)][:, None, :]
    # Distance to the centre's entry less that to this one grows linearly along each axis.
    slope, across = 2 * (entries - centre), (centre * centre - entries * entries).sum(-1)
    lead = np.maximum(slope * low, slope * high).sum(-1) + across
    return (least <= greatest.min(1)[:, None]) & (lead >= 0)


def _kernel(points: np.ndarray, entries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of blocks of points, each block against its own candidates.

    points (blocks, points, width), candidates (blocks, listed) ascending, so the first least one has the lowest index.
    """
    listed = entries[candidates]
    total = np.zeros((len(points), points.shape[1], candidates.shape[1]), np.int64)
    for axis in range(points.shape[2]):
        difference = points[:, :, None, axis] - listed[:, None, :, axis]
        total += difference * difference
    best = total.argmin(2)
    return np.take_along_axis(candidates, best, 1), np.take_along_axis(total, best[:, :, None], 2)[:, :, 0]


def nearest(points: np.ndarray, boxes: np.ndarray, entries: np.ndarray, skip_single: bool) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of all sorted points of one part.

    With ``skip_single``, points of blocks with one candidate are not looked at: entry -1 says so.
    """
    lists = shortlists(boxes, entries)
    lengths = lists.sum(1)
    entry, error = np.full(len(points), -1, np.int64), np.zeros(len(points), np.int64)
    # Indices of the listed entries first, in ascending order; shorter lists repeat their last one.
    ranked = np.argsort(~lists, axis=1, kind="stable")
    classes = 1 << np.ceil(np.log2(lengths)).astype(int)
    last = len(lists) - 1
    short = len(points) - last * BLOCK < BLOCK
    for size in np.unique(classes):
        if size == 1 and skip_single:
            continue
        own = np.flatnonzero(classes == size)
        at = np.minimum(np.arange(min(size, lists.shape[1])), lengths[own, None] - 1)
        candidates = np.take_along_axis(ranked[own], at, 1)
        step = max(1, KERNEL // (BLOCK * candidates.shape[1]))
        groups = [(own[i : i + step], candidates[i : i + step]) for i in range(0, len(own), step)]
        if short and own[-1] == last:  # the last block has fewer points
            groups[-1] = (groups[-1][0][:-1], groups[-1][1][:-1])
            groups.append((own[-1:], candidates[-1:]))
        for blocks, listed in groups:
            if not len(blocks):
                continue
            where = (blocks[:, None] * BLOCK + np.arange(BLOCK)).reshape(len(blocks), -1)
            where = where[:, where[0] < len(points)]
            entry[where], error[where] = _kernel(points[where], entries, listed)
    return entry, error


def _parts(batch: pa.RecordBatch, row: int, width: int):
    """(points, order, boxes) of every part of one slab."""
    columns = [batch.column(name)[row].as_py() for name in ("points", "orders", "boxes")]
    for points, order, boxes in zip(*columns, strict=True):
        yield (
            np.frombuffer(points, np.int32).reshape(-1, width).astype(np.int64),
            np.frombuffer(order, np.uint16),
            np.frombuffer(boxes, np.int64).reshape(-1, 3, width),
        )


def round_sums(kept: DataFrame, codebooks: np.ndarray) -> dict[int, int]:
    """Sums of one assignment: a value per (part, entry, coordinate or count), numbered in that order."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for part, (points, _, boxes) in enumerate(_parts(batch, row, width)):
                    own = sums[part]
                    entry, _ = nearest(points, boxes, codebooks[part], skip_single=True)
                    seen = np.flatnonzero(entry >= 0)
                    np.add.at(own[:, :width], entry[seen], points[seen])
                    own[:, width] += np.bincount(entry[seen], minlength=entries)
                    lists = shortlists(boxes, codebooks[part])
                    alone = np.flatnonzero(lists.sum(1) == 1)
                    only = lists[alone].argmax(1)
                    np.add.at(own[:, :width], only, boxes[alone, 2])
                    counts = np.minimum(BLOCK, len(points) - alone * BLOCK)
                    np.add.at(own[:, width], only, counts)
        flat = sums.ravel()
        there = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(flat[there])], names=["cell", "value"])

    totals = in_batches(kept).select("points", "orders", "boxes").mapInArrow(run, "cell long, value long")
    totals = totals.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {r["cell"]: int(r["value"]) for r in totals.collect()}


def moved(codebooks: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """Each entry at the floor of its points' mean; unused entries stay."""
    parts, entries, width = codebooks.shape
    result = codebooks.copy()
    for part in range(parts):
        for entry in range(entries):
            first = (part * entries + entry) * (width + 1)
            count = sums.get(first + width, 0)
            if count:
                result[part, entry] = [sums.get(first + axis, 0) // count for axis in range(width)]
    return result


def coded(kept: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every row: the final assignment."""
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                codes, errors = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for part, (points, order, boxes) in enumerate(_parts(batch, row, width)):
                    entry, error = nearest(points, boxes, codebooks[part], skip_single=False)
                    codes[order, part] = entry
                    errors[order] += error
                text = codes.tobytes().hex()
                step = 2 * parts
                code = [text[i : i + step] for i in range(0, len(text), step)]
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("labels")[row].values, pa.array(code), pa.array(errors)],
                    names=["vec_id", "label", "code", "error"],
                )

    return in_batches(kept).mapInArrow(run, "vec_id long, label string, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for x in codebooks.ravel().tolist()).encode()).hexdigest()


def fit(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The stored slabs of rows (vec_id, label, v), and the codebooks (part, entry, coordinate)."""
    longest = df.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    seeds = df.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    codebooks = np.zeros((len(seeds), parts * width), np.int64)
    for at, seed in enumerate(seeds):
        codebooks[at, : len(seed["v"])] = seed["v"]
    codebooks = codebooks.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    kept = stored(slabs(df, parts, width), "vector-slabs")
    for _ in range(rounds if len(seeds) else 0):
        codebooks = moved(codebooks, round_sums(kept, codebooks))
    return kept, codebooks


def encode(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row.

    ``label_error`` is added up before it is joined back, so a label of very many rows is one number.
    """
    kept, codebooks = fit(whole_vectors(df, key, vector, label, scale), parts, entries, rounds)
    rows = stored(coded(kept, codebooks), "vector-codes")
    errors = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    return rows.join(narrow_side(errors, FEW_LABELS), same, "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
