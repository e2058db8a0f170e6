"""Ranked lexical search by pair-bound MaxScore over blocks of documents.

Building. One pass cuts whole texts into terms and stores, per block of documents, the postings of the
items' terms; sums of document counts and lengths follow from it. A second pass turns counts into
impacts and stores with each block: the greatest impact of each term, and for each chosen pair of an
item's terms the list of documents that hold both, with their greatest joint impact.

Bounds. An item's terms are paired in two ways, each a chain of neighbours in the order of falling weight. For any
document of a block a pair adds at most the greatest of its joint maximum and its two single
maxima, which is less than their sum unless the two meet at their best. An item's bound on a block is the
lower of both pairings' sums; it skips whole blocks, and, by the MaxScore rule over pairs, all documents
that hold terms of the least pairs alone; partial scores plus the bounds of the rest skip further ones.

Search. The document of the best joint impact of each pair is scored in full while building; the k-th best of
these scores over all blocks is a cutoff no answer falls below. Tasks then go through their blocks
with that cutoff, raise it by what they find, and hand on at most k rows an item.

Scores are whole numbers; equal ones go to the smaller id, rows without an id last. Nothing that is
skipped can be an answer: only documents whose bound is below a cutoff that k documents reach go.

Defined results: null texts and those without terms are no documents; null items and those without terms give
no rows; equal rows of ``items`` are searched once, rows of one id with unlike texts each; repeated document
rows are ranked each; empty tables give an empty result. Only ids and texts are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import in_batches, slices, stored

TOP = 20
#: Documents of a block at most (their numbers fit 16 bits), and postings after which a block is closed.
DOCUMENTS, POSTINGS = 4096, 1 << 19
#: Items searched together; more are searched in turns.
ITEMS = 5000

#: A-Z in lower case, other ASCII letters and digits and all further bytes as they are, the rest as spaces:
#: in UTF-8 each character beyond ASCII is made of bytes from 0x80 on.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

TERMS_SCHEMA = "ids array<long>, sizes array<long>, terms binary, counts binary, documents binary, repeats binary"
INDEX_SCHEMA = (
    "ids array<long>, terms binary, counts binary, documents binary, gains binary, most binary, "
    "pairs binary, joint binary, met binary, both binary, probe_items array<int>, probe_scores array<long>"
)


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z alone in lower case."""
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class Items:
    """Searches: ids, and per search its distinct terms (as numbers) with their repeats."""

    ids: list[int | None]
    words: list[bytes]
    own: list[tuple[tuple[int, int], ...]]

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Items:
        counted = [(i, Counter(terms((text or "").encode()))) for i, text in rows]
        counted = [(i, c) for i, c in counted if c]
        words = sorted({w for _, c in counted for w in c})
        number = {w: n for n, w in enumerate(words)}
        return Items([i for i, _ in counted], words, [tuple(sorted((number[w], n) for w, n in c.items())) for _, c in counted])


@dataclass(frozen=True)
class Statistics:
    documents: int
    length: int
    frequency: np.ndarray

    def weights(self) -> np.ndarray:
        n = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(n / (2 * int(df) + 1))) for df in self.frequency], np.int64)

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        """What a document's length adds to the divisor; Python's whole numbers, as products may be large."""
        return np.array([75 + 25 * int(n) * self.documents // self.length for n in sizes], np.int64)


def term_blocks(docs: DataFrame, words: list[bytes], key: str, text: str) -> DataFrame:
    """Blocks of documents with the postings of ``words``, by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: n for n, w in enumerate(words)}
        find = number.get
        ids, sizes, found = [], [], []
        postings = 0

        def block() -> pa.RecordBatch:
            term = np.fromiter((t for own in found for t in own), np.int64, postings)
            repeats = np.fromiter((n for own in found for n in own.values()), np.int64, postings)
            document = np.repeat(np.arange(len(found)), [len(own) for own in found])
            order = np.argsort(term, kind="stable")
            present, counts = np.unique(term, return_counts=True)
            arrays = [present.astype(np.int32), counts.astype(np.int32), document[order].astype(np.uint16), repeats[order].astype(np.int32)]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
                names=["ids", "sizes", "terms", "counts", "documents", "repeats"],
            )

        for batch in slices(batches):
            for own_id, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                cut = terms(value.as_py())
                if not cut:
                    continue
                own = Counter(map(find, cut))
                own.pop(None, None)
                ids.append(own_id)
                sizes.append(len(cut))
                found.append(own)
                postings += len(own)
                if len(ids) == DOCUMENTS or postings >= POSTINGS:
                    yield block()
                    ids, sizes, found, postings = [], [], [], 0
        if ids:
            yield block()

    read = docs.select(quoted(key).cast("long").alias("id"), quoted(text).cast("string").alias("text")).filter("text IS NOT NULL")
    return in_batches(read).mapInArrow(run, TERMS_SCHEMA)


def statistics(blocks: DataFrame, words: int) -> Statistics:
    """Documents, their terms with repeats, and documents per word; a row per word is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(words + 2, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                term, count = (np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("terms", "counts"))
                sums[term] += count
                sizes = batch.column("sizes")[row].values.to_numpy()
                sums[words] += len(sizes)
                sums[words + 1] += sizes.sum()
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["cell", "value"])

    totals = in_batches(blocks).select("sizes", "terms", "counts").mapInArrow(run, "cell long, value long")
    found = {r["cell"]: r["value"] for r in totals.groupBy("cell").agg(F.sum("value").alias("value")).collect()}
    frequency = np.array([found.get(n, 0) for n in range(words)], np.int64)
    return Statistics(found.get(words, 0), found.get(words + 1, 0), frequency)


@dataclass(frozen=True)
class Plan:
    """An item's weighted terms by falling weight, and its two pairings as numbers of the pair table (-1: a term alone)."""

    terms: np.ndarray
    repeats: np.ndarray
    pairings: tuple[tuple[tuple[int, int, int], ...], ...]


def plans(items: Items, weights: np.ndarray) -> tuple[list[Plan], np.ndarray]:
    """Each item's plan, and the table of pairs (term, repeats, term, repeats) the items share."""
    pairs: dict[tuple[int, int, int, int], int] = {}
    made = []
    for own in items.own:
        ranked = sorted(own, key=lambda t: (-weights[t[0]] * t[1], t[0]))
        pairings = []
        for start in (0, 1):
            units = [(0, -1, -1)] if start else []
            for at in range(start, len(ranked) - 1, 2):
                pair = pairs.setdefault((*ranked[at], *ranked[at + 1]), len(pairs))
                units.append((at, at + 1, pair))
            if (len(ranked) - start) % 2 and (start == 0 or len(ranked) > 1):
                units.append((len(ranked) - 1, -1, -1))
            pairings.append(tuple(units))
        made.append(Plan(np.array([t for t, _ in ranked]), np.array([n for _, n in ranked], np.int64), tuple(pairings)))
    return made, np.array(list(pairs), np.int64).reshape(-1, 4)


class Block:
    """Postings of a block: documents and gains of each present term."""

    def __init__(self, present, counts, documents, gains, weights, size: int) -> None:
        ends = np.cumsum(counts)
        self.at = dict(zip(present.tolist(), zip((ends - counts).tolist(), ends.tolist(), strict=True), strict=True))
        self.documents, self.gains, self.weights, self.size = documents, gains, weights, size

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold the term, and what it adds to their scores."""
        first, end = self.at.get(int(term), (0, 0))
        return self.documents[first:end], self.gains[first:end].astype(np.int64) * self.weights[term]

    def score(self, plan: Plan, chosen: np.ndarray) -> np.ndarray:
        """Full scores of the chosen documents (ascending)."""
        total = np.zeros(self.size, np.int64)
        for term, repeats in zip(plan.terms, plan.repeats, strict=True):
            documents, impacts = self.of(term)
            total[documents] += repeats * impacts
        return total[chosen]


def _pair_lists(block: Block, pairs: np.ndarray) -> list[tuple[int, int, int, np.ndarray]]:
    """(pair, joint maximum, its first document, documents holding both) of each pair that meets in the block."""
    found = []
    scratch = np.zeros(block.size, np.int64)
    for first in np.unique(pairs[:, 0]):
        documents, impacts = block.of(first)
        if not len(documents):
            continue
        scratch[documents] = impacts + 1  # weights, and so impacts, may be zero
        for number in np.flatnonzero(pairs[:, 0] == first):
            others, gains = block.of(pairs[number, 2])
            there = scratch[others]
            both = np.flatnonzero(there)
            if len(both):
                joint = (there[both] - 1) * pairs[number, 1] + gains[both] * pairs[number, 3]
                best = int(joint.argmax())
                found.append((int(number), int(joint[best]), int(others[both[best]]), others[both]))
        scratch[documents] = 0
    return found


def index(blocks: DataFrame, items: Items, known: Statistics, top: int) -> DataFrame:
    """Blocks with gains, greatest impacts, pair lists and the probes' scores."""
    weights = known.weights()
    made, pairs = plans(items, weights)
    users: dict[int, list[int]] = {}
    for item, plan in enumerate(made):
        for pair in {unit[2] for pairing in plan.pairings for unit in pairing if unit[2] >= 0}:
            users.setdefault(pair, []).append(item)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                present, counts, repeats = (
                    np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("terms", "counts", "repeats")
                )
                documents = np.frombuffer(batch.column("documents")[row].as_py(), np.uint16)
                damping = known.damping(batch.column("sizes")[row].values.to_numpy())
                tf = repeats.astype(np.int64)
                gains = 1_000_000_000 * tf // (1000 * tf + 12 * damping[documents])
                block = Block(present, counts, documents, gains, weights, len(damping))
                starts = np.cumsum(counts) - counts
                most = np.maximum.reduceat(gains, starts) * weights[present] if len(gains) else np.zeros(0, np.int64)
                lists = _pair_lists(block, pairs)
                probes: dict[int, set[int]] = {}
                for pair, _, best, _ in lists:
                    for item in users[pair]:
                        probes.setdefault(item, set()).add(best)
                probe_items, probe_scores = [], []
                for item, chosen in probes.items():
                    scores = np.sort(block.score(made[item], np.array(sorted(chosen))))[::-1][:top]
                    probe_items += [item] * len(scores)
                    probe_scores += scores.tolist()
                binary = [
                    gains.astype(np.int32), most.astype(np.int64), np.array([x[0] for x in lists], np.int32),
                    np.array([x[1] for x in lists], np.int64), np.array([len(x[3]) for x in lists], np.int32),
                    np.concatenate([x[3] for x in lists] or [np.zeros(0)]).astype(np.uint16),
                ]
                columns = [batch.column(c).slice(row, 1) for c in ("ids", "terms", "counts", "documents")]
                columns += [pa.array([a.tobytes()], pa.binary()) for a in binary]
                columns += [pa.array([probe_items], pa.list_(pa.int32())), pa.array([probe_scores], pa.list_(pa.int64()))]
                names = [f.split(" ")[0] for f in INDEX_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_batches(blocks).mapInArrow(run, INDEX_SCHEMA)


def cutoffs(built: DataFrame, top: int) -> dict[int, int]:
    """The k-th best probe of each item that has as many; probes of different blocks are different documents."""
    probes = built.select(F.explode(F.arrays_zip("probe_items", "probe_scores")).alias("p")).select("p.*")
    rank = F.row_number().over(Window.partitionBy("probe_items").orderBy(F.desc("probe_scores")))
    least = probes.withColumn("rank", rank).filter(F.col("rank") <= top).filter(F.col("rank") == top)
    return {r["probe_items"]: r["probe_scores"] for r in least.collect()}


def search_blocks(built: DataFrame, items: Items, known: Statistics, floor: dict[int, int], top: int) -> DataFrame:
    """(item, id, score): at most ``top`` best rows an item and task, none below the item's cutoff."""
    weights = known.weights()
    made, pairs = plans(items, weights)

    def item_bounds(plan: Plan, most: np.ndarray, joint: np.ndarray) -> tuple[int, np.ndarray]:
        """The pairing with the lower sum, and the bounds of its units."""
        best = None
        alone = most[plan.terms] * plan.repeats
        for number, pairing in enumerate(plan.pairings):
            bounds = np.array(
                [alone[a] if b < 0 else max(alone[a], alone[b], joint[p]) for a, b, p in pairing], np.int64
            )
            if best is None or bounds.sum() < best[1].sum():
                best = number, bounds
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple[int, bool, int]]] = [[] for _ in made]  # (-score, without id, id), best first
        least = [floor.get(item, 1) for item in range(len(made))]
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(batch.column(c)[row].as_py(), kind)  # noqa: B023, E731
                ids = batch.column("ids")[row].as_py()
                present = get("terms", np.int32)
                block = Block(present, get("counts", np.int32), get("documents", np.uint16), get("gains", np.int32), weights, len(ids))
                most, joint = np.zeros(len(weights), np.int64), np.zeros(len(pairs), np.int64)
                most[present] = get("most", np.int64)
                joint[get("pairs", np.int32)] = get("joint", np.int64)
                for item, plan in enumerate(made):
                    number, bounds = item_bounds(plan, most, joint)
                    if bounds.sum() < least[item]:
                        continue
                    order = np.argsort(-bounds, kind="stable")
                    units = [plan.pairings[number][u] for u in order]
                    chosen, scores = _scored(block, plan, units, bounds[order], least[item])
                    if not len(chosen):
                        continue
                    if len(chosen) > top:  # ties of the last place stay
                        enough = np.partition(scores, -top)[-top]
                        chosen, scores = chosen[scores >= enough], scores[scores >= enough]
                    own = kept[item] + [(-s, ids[c] is None, ids[c] or 0) for c, s in zip(chosen.tolist(), scores.tolist(), strict=True)]
                    own.sort()
                    kept[item] = own[:top]
                    if len(own) >= top:
                        least[item] = max(least[item], -own[top - 1][0])
        rows = [(item, None if without else i, -s) for item, own in enumerate(kept) for s, without, i in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return in_batches(built).mapInArrow(run, "item int, doc_id long, score long")


def _scored(block: Block, plan: Plan, units, bounds: np.ndarray, cutoff: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that reach the cutoff, ascending, with their scores.

    ``units`` (pairs and single terms) come by falling bound. Once the bounds of the rest add up to less than the
    cutoff, documents not met so far cannot be answers: from there on only those met are carried, and
    dropped as soon as their sum and the rest's bounds stay below it.
    """
    rest = np.cumsum(bounds[::-1])[::-1]
    total = np.zeros(block.size, np.int64)
    alive: np.ndarray | None = None
    for at, (first, second, _) in enumerate(units):
        if rest[at] < cutoff:
            alive = np.flatnonzero(total) if alive is None else alive
            alive = alive[total[alive] + rest[at] >= cutoff]
            if not len(alive):
                return alive, alive
        for term in (first, second):
            if term >= 0:
                documents, impacts = block.of(plan.terms[term])
                total[documents] += plan.repeats[term] * impacts
    alive = np.flatnonzero(total) if alive is None else alive
    alive = alive[total[alive] >= max(cutoff, 1)]
    return alive, total[alive]


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", together: int = ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every item.

    Items are the searches; their texts are collected ``together`` at a time, in the order of a hash.
    """
    asked = items.select(quoted(item_key).cast("long").alias("item_id"), quoted(item_text).cast("string").alias("text"))
    asked = asked.filter("text IS NOT NULL").distinct()
    turns = max(1, -(-asked.count() // together))
    found = None
    for turn in range(turns):
        of_turn = F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)) == turn
        rows = sorted(asked.filter(of_turn).collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        part = _search(docs, Items.of([(r["item_id"], r["text"]) for r in rows]), top, key, text)
        found = part if found is None else found.union(part)
    return found


def _search(docs: DataFrame, items: Items, top: int, key: str, text: str) -> DataFrame:
    blocks = stored(term_blocks(docs, items.words, key, text), "search-terms")
    known = statistics(blocks, len(items.words))
    built = stored(index(blocks, items, known, top), "search-index")
    best = stored(search_blocks(built, items, known, cutoffs(built, top), top), "search-best")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
