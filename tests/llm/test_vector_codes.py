"""Vector codes against plain assignment, odd rows, partitions."""

import hashlib
import math

import numpy as np
import pytest

from surveyflow.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, note string, code string"


def rows_of(rng, n, width=32, spread=0.3):
    return [
        (i, [float(x) for x in rng.normal(0, spread, width).astype(np.float32)], int(rng.integers(0, 4)), "x", "y")
        for i in range(n)
    ]


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    whole = [[math.floor(x * scale) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, [math.floor(x * scale) for x in kept[i][1]]))
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    books = [[cut(whole[i], p) for i in order[:entries]] for p in range(parts)]

    def assign():
        found = []
        for v in whole:
            own = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in books[p]]
                own.append((d.index(min(d)), min(d)))
            found.append(own)
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for v, f in zip(whole, found, strict=True) if f[p][0] == e]
                if own:
                    books[p][e] = tuple(sum(axis) // len(own) for axis in zip(*own, strict=True))
    found = assign()
    text = ",".join(str(x) for book in books for e in book for x in e)
    errors = [sum(d for _, d in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [
        (r[0], "".join(f"{e:02x}" for e, _ in f), error, by_label[r[2]], sha)
        for r, f, error in zip(kept, found, errors, strict=True)
    ]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def result(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return ordered(tuple(r) for r in vector_codes.encode(df).collect())


def test_equals_brute_force(spark, monkeypatch):
    rows = rows_of(np.random.default_rng(1), 400)
    assert result(spark, rows) == ordered(brute(rows))
    assert result(spark, rows, 1) == result(spark, rows, 7)


def test_small_slabs_and_blocks(spark, monkeypatch):
    rows = rows_of(np.random.default_rng(2), 150, width=16)
    assert result(spark, rows, 1) == ordered(brute(rows))


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = rows_of(rng, 90, width=40)
    nan, inf = float("nan"), float("inf")
    bad = [(100, None, 1), (101, [nan] * 40, 1), (102, [inf] + [0.0] * 39, 1), (103, [None] + [0.0] * 39, 1)]
    odd = [(None, rows[0][1], None), (5, rows[9][1], 2), (5, rows[9][1], None), (200, [], 1), (201, [0.5] * 7, 3), (-4, [-0.001] * 40, 0)]
    rows = rows + [(*r, None, None) for r in bad + odd]
    got = result(spark, rows)
    assert got == ordered(brute(rows)) and len(got) == 96


def test_few_equal_and_no_rows(spark):
    one = [(7, [0.25] * 16, None, "", "")]
    assert result(spark, one) == ordered(brute(one))
    same = [(i, [0.25, -0.5] * 8, i % 2, "", "") for i in range(300)]
    assert result(spark, same) == ordered(brute(same))
    assert result(spark, []) == []
    assert result(spark, [(1, None, 1, "", "")]) == []


def test_components_too_large_raise(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        result(spark, [(1, [1e30] * 16, 1, "", "")])


@pytest.mark.parametrize(("width", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours(width, bits):
    side = 1 << bits
    grid = np.stack(np.meshgrid(*[np.arange(side)] * width), -1).reshape(-1, width)
    order = vector_codes.hilbert_order(grid, bits)
    assert sorted(order.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_shortlists_keep_the_nearest_and_are_short():
    rng = np.random.default_rng(4)
    points = rng.integers(-300, 300, (5000, 4))
    points = points[vector_codes.hilbert_order(points)]
    entries = rng.integers(-300, 300, (64, 4))
    boxes = vector_codes._boxes(points)
    lists = vector_codes.shortlists(boxes, entries)
    plain = ((points[:, None] - entries) ** 2).sum(2)
    assert lists[np.arange(len(points)) // vector_codes.BLOCK, plain.argmin(1)].all()
    assert lists.mean() < 0.5
    for skip in (False, True):
        entry, error = vector_codes.nearest(points, boxes, entries, skip)
        seen = entry >= 0
        assert (entry[seen] == plain.argmin(1)[seen]).all() and (error[seen] == plain.min(1)[seen]).all()
        assert seen.all() or skip
