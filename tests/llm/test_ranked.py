"""Ranked search against plain scoring, bounds, odd rows, partitions."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyflow.llm import ranked

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    cut = [(i, Counter(words(t))) for i, t in docs]
    cut = [(i, c) for i, c in cut if c]
    n, length = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(w for _, c in cut for w in c)
    result = []
    for item, text in set(items):
        scores = []
        for doc, c in cut:
            m = 100 - 25 + 25 * sum(c.values()) * n // length
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m))
                for w in words(text) if c[w]
            )
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        ordered = sorted(scores)[:top]
        result += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(ordered, 1)]
    return sorted(result, key=str)


def result(spark, docs, items, partitions=3, top=20, **more):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, score string, rank int").repartition(partitions)
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in ranked.search(d, i, top, **more).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [w.decode() for w in ranked.terms(text.encode())] == words(text)


def corpus(seed, n, vocabulary=300):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, vocabulary + 1)
    pick = lambda k: " ".join(f"w{x}" for x in rng.choice(vocabulary, k, p=share / share.sum()))
    docs = [(i, pick(int(rng.integers(1, 120)))) for i in range(n)]
    items = [(i, pick(int(rng.integers(1, 30)))) for i in range(25)]
    docs += [(n + i, f"{pick(5)} {items[i][1]} {pick(30)}") for i in range(8)]  # copies of items' texts
    return docs, items


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_equals_plain_scoring(spark, monkeypatch, size):
    monkeypatch.setattr(ranked, "DOCUMENTS", size)
    docs, items = corpus(size, 500)
    want = brute(docs, items)
    assert result(spark, docs, items, 1) == want
    assert result(spark, docs, items, 7) == want


def test_more_items_than_are_searched_together(spark):
    docs, items = corpus(5, 120)
    assert result(spark, docs, items, together=6) == brute(docs, items)


def test_odd_rows(spark):
    docs = [
        (1, "Äpfel und ÄPFEL, apfel"), (2, None), (3, ""), (4, "... \t\n"), (None, "apfel und"), (5, "apfel und"), (5, "apfel und"),
        (6, "naïve x́ \x7f{}"), (7, "long " * 50_000 + "apfel"), (8, "日本 日本語"), (-9, "apfel und"), (10, "K K k"),
    ]
    items = [(1, "APFEL apfel und"), (2, None), (3, ""), (4, "!!"), (None, "日本"), (5, "nowhere"), (6, "k"), (6, "k"), (6, "x́"), (7, "long")]
    assert result(spark, docs, items) == brute([d for d in docs], [i for i in items if i[1] is not None])


def test_ties_and_no_rows(spark):
    same = [(i, "a b c") for i in range(60)]
    got = result(spark, same + [(100, "d")], [(1, "a c"), (2, "d")], 5)
    assert got == brute(same + [(100, "d")], [(1, "a c"), (2, "d")])
    assert [r[2] for r in sorted(got)][:20] == list(range(20))
    assert result(spark, [], [(1, "a")]) == [] and result(spark, same, []) == []
    assert result(spark, [(1, None)], [(1, "a")]) == []


def test_words_of_all_documents_score_by_the_formula(spark):
    docs = [(i, "every") for i in range(3000)]  # the weight is zero from some 1,000 documents on
    assert result(spark, docs, [(1, "every")]) == [] == brute(docs, [(1, "every")])


def built_block(seed):
    rng = np.random.default_rng(seed)
    size, vocabulary = 200, 40
    held = rng.random((vocabulary, size)) < (1 / np.arange(2, vocabulary + 2))[:, None]
    gains = rng.integers(1, 10**6, (vocabulary, size)) * held
    weights = rng.integers(1, 12_000, vocabulary)
    present = np.flatnonzero(held.any(1))
    documents = np.concatenate([np.flatnonzero(held[t]) for t in present]).astype(np.uint16)
    flat = np.concatenate([gains[t][held[t]] for t in present]).astype(np.int32)
    return ranked.Block(present, held[present].sum(1), documents, flat, weights, size), gains * weights[:, None], weights


@pytest.mark.parametrize("seed", range(6))
def test_pair_bounds_hold_and_are_tighter(seed):
    block, impacts, weights = built_block(seed)
    rng = np.random.default_rng(seed + 100)
    own = tuple((int(t), int(rng.integers(1, 4))) for t in sorted(rng.choice(len(weights), 13, replace=False)))
    (plan,), pairs = ranked.plans(ranked.Items([1], [], [own]), weights)
    assert {t for t, _ in own} == set(plan.terms.tolist())
    scores = sum(impacts[t] * n for t, n in own)
    joint = np.zeros(len(pairs), np.int64)
    for number, most, best, both in ranked._pair_lists(block, pairs):
        a, n, b, m = pairs[number]
        together = impacts[a] * n + impacts[b] * m
        meet = (impacts[a] > 0) & (impacts[b] > 0)
        assert most == together[meet].max() == together[best] and both.tolist() == np.flatnonzero(meet).tolist()
        joint[number] = most
    alone = np.array([impacts[t].max() * n for t, n in zip(plan.terms, plan.repeats, strict=True)])
    for pairing in plan.pairings:
        covered = sorted(x for a, b, _ in pairing for x in (a, b) if x >= 0)
        assert covered == list(range(len(own)))
        bounds = np.array([alone[a] if b < 0 else max(alone[a], alone[b], joint[p]) for a, b, p in pairing])
        assert scores.max() <= bounds.sum() < alone.sum()
        order = np.argsort(-bounds, kind="stable")
        for cutoff in (1, int(np.median(scores)), int(np.sort(scores)[-10]), int(scores.max()), int(scores.max()) + 1):
            chosen, got = ranked._scored(block, plan, [pairing[u] for u in order], bounds[order], cutoff)
            want = np.flatnonzero(scores >= cutoff)
            assert chosen.tolist() == want.tolist() and got.tolist() == scores[want].tolist()
