"""Exact top-k inner products in three phases with a uniform threshold.

The components of the vectors are split into segments; a block of rows lists its partial scores by
each segment. Phase one takes the best entries of every list, resolves them and keeps their scores:
the k-th best of all blocks is a cutoff no true answer falls below. Phase two gives each query its
cutoff and collects all entries whose partial score by some segment reaches that segment's part of
it; an entry below every part cannot reach the sum. Phase three resolves the missing partial scores
of these entries exactly and keeps what reaches the cutoff, and the best k are ranked.

Queries and rows meet in blocks of bounded size. Every block of queries goes through every block of
rows, so the work is the product of both, while what leaves a pair of blocks is about k rows a query.

Edge cases: null vectors and those with null or non-finite components take no part; shorter vectors
count as filled up with zeros; equal scores go to the smaller id; all rows of a query's own id are
left out; repeated rows are ranked each, repeated queries once (the least vector of an id); an empty
table gives an empty result. Components so large that a score might not fit a long raise, and never
wrap. Only id and vector are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import in_batches, stored

K = 20
SCALE = 64
SEGMENTS = 4
#: Rows and queries of a block, and queries whose scores are worked on together.
ROWS, QUERIES, TOGETHER = 8192, 4096, 256
#: Row blocks of a cell of the grid where queries and rows meet, and partitions of the grid.
GROUP, MOST_CELLS = 2, 10_000
#: Up to this absolute score double precision is exact for whole numbers.
EXACT = 1 << 53

BLOCK = "number long, rows long, width long, ids binary, vectors binary, cutoffs binary"


def whole_numbers(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and v, the vector's components as floor(scale * x), of usable rows."""
    v = quoted(vector)
    usable = v.isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return df.filter(usable & quoted(key).isNotNull()).select(quoted(key).cast("long").alias("vec_id"), whole.alias("v"))


def blocks(df: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, v and, for queries, cutoff) packed into blocks of up to ``size`` in place."""
    has_cutoff = "cutoff" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(part: pa.Table) -> pa.RecordBatch:
            v = part.column("v").combine_chunks()
            sizes = np.diff(v.offsets.to_numpy())
            width = int(sizes.max(initial=0))
            dense = np.zeros((len(v), width), "i8")
            dense[np.arange(width) < sizes[:, None]] = v.flatten().to_numpy()
            ids = part.column("vec_id").to_numpy().astype("i8")
            cutoffs = part.column("cutoff").to_numpy().astype("i8").tobytes() if has_cutoff else b""
            number = int(ids[0]) if len(ids) else 0
            most = max(abs(int(dense.min(initial=0))), abs(int(dense.max(initial=0))))
            if most * most * max(width, 1) >= 1 << 63:
                raise ValueError(f"a whole component of {most} is too large: scores would not fit a long")
            kind = next(t for t in ("i2", "i4", "i8") if most <= np.iinfo(t).max)
            values = [number, len(v), width, ids.tobytes(), dense.astype(kind).tobytes(), cutoffs]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], ["number", "rows", "width", "ids", "vectors", "cutoffs"])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield block(whole.slice(0, size).combine_chunks())
                held = whole.slice(size).to_batches()
                n -= size
        if n:
            yield block(pa.Table.from_batches(held))

    return in_batches(df).mapInArrow(run, BLOCK)


def _pairs(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Every block of queries with every block of rows, met on a grid of query blocks and row groups.

    ``queries`` and ``rows`` are stored tables. Block numbers of queries, one for thousands of
    queries, go into the plan. Each cell has a partition of its own, however few bytes it holds:
    the work in it is the product of its blocks.
    """
    numbers = sorted(r.number for r in queries.select("number").collect())
    groups = max(1, -(-rows.count() // GROUP))
    cells = max(1, min(MOST_CELLS, len(numbers) * groups))
    named = [f"row_{c}" for c in rows.columns]
    here = F.pmod(F.xxhash64("row_number"), F.lit(groups)).cast("int")
    dealt = rows.toDF(*named).select(*named, here.alias("group"), F.explode(F.array(*map(F.lit, numbers)).cast("array<long>")).alias("number"))
    asked = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt, asked = dealt.repartition(cells, "number", "group"), asked.repartition(cells, "number", "group")
    return dealt.join(asked, ["number", "group"]).select(*named, *queries.columns)


def _matrix(batch: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    n, width = batch[f"{prefix}rows"][i].as_py(), batch[f"{prefix}width"][i].as_py()
    ids = np.frombuffer(batch[f"{prefix}ids"][i].as_buffer(), "i8")
    packed = batch[f"{prefix}vectors"][i].as_buffer()
    return ids, np.frombuffer(packed, f"i{packed.size // max(1, n * width) or 8}").reshape(n, width)


class Lists:
    """Partial scores, by segment, of a block of rows for some queries."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, segments: int = SEGMENTS):
        width = min(queries.shape[1], rows.shape[1])
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * width
        kind = "f8" if most < EXACT else "i8"
        self.cuts = np.linspace(0, width, segments + 1).astype(int)
        self.queries, self.rows = queries[:, :width].astype(kind), rows[:, :width].astype(kind)

    def partial(self, some: slice, segment: int) -> np.ndarray:
        a, b = self.cuts[segment], self.cuts[segment + 1]
        return self.queries[some, a:b] @ self.rows[:, a:b].T

    def resolve(self, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return (self.queries[q] * self.rows[r]).sum(1).astype("i8")


def _pair_blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            (row_ids, rows), (ids, queries) = _matrix(batch, i, "row_"), _matrix(batch, i, "")
            cutoffs = np.frombuffer(batch["cutoffs"][i].as_buffer(), "i8")
            yield ids, row_ids, Lists(queries, rows), cutoffs


def cutoffs(pairs: DataFrame, k: int = K) -> DataFrame:
    """Phase one: query_id and cutoff, the k-th best of the scores every block of rows reports.

    No cutoff for a query with fewer than k candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, row_ids, lists, _ in _pair_blocks(batches):
            best = min(k + 1, len(row_ids))  # one more: the query's own row may be among them
            for at in range(0, len(ids), TOGETHER):
                some = slice(at, min(at + TOGETHER, len(ids)))
                tops = [np.argpartition(lists.partial(some, s), -best, axis=1)[:, -best:] for s in range(SEGMENTS)]
                entry = np.sort(np.concatenate(tops, axis=1), axis=1)
                fresh = np.c_[np.ones(len(entry), bool), np.diff(entry, axis=1) > 0] & (row_ids[entry] != ids[some, None])
                q, place = np.nonzero(fresh)
                score = lists.resolve(q + at, entry[q, place])
                order = np.lexsort((-score, q))
                rank = np.arange(len(q)) - np.r_[0, np.cumsum(np.bincount(q, minlength=some.stop - at))][q[order]]
                first = order[rank < k]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + q[first]]), pa.array(score[first])], ["query_id", "score"])

    scores = in_batches(pairs).mapInArrow(run, "query_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))


def entries(pairs: DataFrame) -> DataFrame:
    """Phases two and three: query_id, vec_id and score of all rows that reach their query's cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, row_ids, lists, cutoff in _pair_blocks(batches):
            part = cutoff / SEGMENTS
            for at in range(0, len(ids), TOGETHER):
                some = slice(at, min(at + TOGETHER, len(ids)))
                reach = lists.partial(some, 0) >= part[some, None]
                for segment in range(1, SEGMENTS):
                    reach |= lists.partial(some, segment) >= part[some, None]
                q, r = np.nonzero(reach & (row_ids[None, :] != ids[some, None]))
                score = lists.resolve(q + at, r)
                good = score >= cutoff[q + at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q[good] + at]), pa.array(row_ids[r[good]]), pa.array(score[good])], ["query_id", "vec_id", "score"]
                )

    return in_batches(pairs).mapInArrow(run, "query_id long, vec_id long, score long")


def search(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for each row of ``df`` that ``queries`` marks."""
    vectors = whole_numbers(df, key, vector)
    asked = whole_numbers(df.filter(queries), key, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = stored(blocks(vectors, ROWS), "rows")
    cut = cutoffs(_pairs(stored(blocks(asked, QUERIES), "queries"), rows), k)
    least = F.lit(-(1 << 62)).cast("long")
    known = asked.join(cut.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("cutoff", F.coalesce("cutoff", least))
    found = entries(_pairs(stored(blocks(known, QUERIES), "cutoffs"), rows))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
