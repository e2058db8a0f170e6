import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyflow.llm import language, quality, quality_rules, queries, toxicity


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def brute_rules(spark, texts, trusted, buckets=quality_rules.BUCKETS):
    """Verdict of every text, hashing tokens by Spark alone."""
    import regex

    tokens = {i: regex.findall(quality_rules.TOKEN, t or "") for i, t in texts.items()}
    pairs = {(a,) for own in tokens.values() for a in own} | {p for own in tokens.values() for p in zip(own, own[1:], strict=False)}
    frame = spark.createDataFrame([(p[0], p[1] if len(p) > 1 else None) for p in pairs], "a string, b string")
    both = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    bucket = {((r.a,) if r.b is None else (r.a, r.b)): r.k for r in frame.select("a", "b", F.pmod(both, F.lit(buckets)).alias("k")).collect()}
    grams = {i: [bucket[a,] for a in own] + [bucket[p] for p in zip(own, own[1:], strict=False)] for i, own in tokens.items()}
    raw = Counter(g for own in grams.values() for g in own)
    target = Counter(g for i, own in grams.items() if i in trusted for g in own)
    n, m = sum(raw.values()), sum(target.values())
    weight = {g: round(quality_rules.UNIT * math.log(((target[g] + 1) / (m + buckets)) / ((raw[g] + 1) / (n + buckets)))) if m else 0 for g in raw}
    return {i: sum(weight[g] for g in own) / len(own) / quality_rules.UNIT if own else None for i, own in grams.items()}


def test_quality_rules_query(spark, sf, corpus):
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()
    ratio = brute_rules(spark, {i: r.text for i, r in corpus.items()}, {r.doc_id for r in labels})
    rows = queries.op10_quality_rules(spark, sf).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        want = base_counts(corpus[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.llr == pytest.approx(ratio[r.doc_id], abs=1e-9)
        assert r.kept == (not r.base_failed and ratio[r.doc_id] >= quality_rules.THRESHOLD)


def test_quality_rules_run_no_python(spark, sf):
    plan = queries.op10_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_rules_on_odd_rows(spark, odd, nothing, odd_rows):
    trusted = spark.createDataFrame([(6,), (6,), (None,)], "doc_id long")
    rows = quality_rules.judge(odd, trusted).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((str(i), *base_counts(t)) for i, t in odd_rows)
    kept = quality_rules.keep(odd, trusted)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)
    none = trusted.filter("false")
    assert all(r.llr in (0.0, None) for r in quality_rules.judge(odd, none).collect())
    assert quality_rules.judge(nothing, none).count() == 0


@pytest.mark.parametrize("text", ["a b c d e f g h " * 3, "a " * 9, "w " + "a b c d e f g h x " * 2, "p q r s t u v w p q r s t u v w x p q r s t u v"])
def test_repeated_windows(spark, text):
    row = quality_rules.repetition(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == base_counts(text)


def test_language_query(spark, sf, corpus):
    rows = queries.op6_language(spark, sf).collect()
    assert len(rows) == len(corpus)
    out = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    assert np.mean([r.lang_pred == corpus[r.doc_id].lang for r in out]) >= 0.97


def two_languages(spark):
    rows = [(i, "the cat and the dog went there together with them", "en") for i in range(20)]
    rows += [(100 + i, "der Hund und die Katze gingen gemeinsam über Straßen", "de") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_mixture(spark):
    model = language.Languages.learn(two_languages(spark))
    en, de = "the dog and the cat went with them ", "die Katze und der Hund gingen über "
    alone, mixed = (model.mixtures([t])[0] for t in (en * 5, en * 12 + de * 4))
    assert dict(zip(model.names, alone, strict=True)) == {"de": 0.0, "en": 1.0}
    assert 0.1 < mixed[0] < 0.4 and mixed.sum() == pytest.approx(1)


def test_language_expectation_maximises():
    chances = np.array([[0.7, 0.1, 0.1], [0.2, 0.8, 0.1], [0.1, 0.1, 0.8]])
    w = np.array([5.0, 3.0, 2.0])
    share, likely = language._expectation(chances, w, np.array([0]), np.zeros(3, int), np.full((1, 3), 1 / 3), np.array([10.0]))
    grid = [(a / 60, b / 60) for a in range(61) for b in range(61 - a)]
    best = max((w * np.log(chances @ np.array([a, b, 1 - a - b]))).sum() for a, b in grid)
    assert likely[0] >= best - 1e-3 and share.sum() == pytest.approx(1)


def test_language_counts(spark):
    frame = two_languages(spark).union(spark.createDataFrame([(1, None, "en"), (2, "lost", None)], "doc_id long, text string, lang string"))
    got = {(r.lang, r.bucket): r.n for r in language.count(frame).collect()}
    want = Counter()
    for r in two_languages(spark).collect():
        clean = re.sub(r"[^\w]+", " ", r.text.lower())
        want.update((r.lang, int(b)) for b in language.trigrams(clean, language.BUCKETS))
    assert got == want


def test_language_of_odd_rows(spark, odd, nothing):
    model = language.Languages.learn(two_languages(spark))
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3))
        assert r.score == (0.0 if r.lang_pred == "und" else pytest.approx(sum(r.shares.values()) - sum(sorted(r.shares.values())[:-1])))
    kept = language.keep(odd, model, least=0.0)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.lang_pred != "und")
    empty = language.Languages.learn(two_languages(spark).filter("false"))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0
    assert language.bucket_count(1) == language.BUCKETS
    assert language.bucket_count(1 << 16) * (1 << 16) <= language.MOST_CELLS


def test_quality_query(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op9_quality(spark, sf).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    known = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) >= 0.8


def test_additive_model_finds_an_interaction():
    pick = np.random.default_rng(0)
    x = pick.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_additive_scores_are_sums_of_table_entries():
    pick = np.random.default_rng(1)
    x = pick.random((500, 2))
    model = quality.fit(x, (x[:, 0] > 0.3).astype(float))
    for row, got in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.base
        for j, v in enumerate(row):
            total += model.tables[j][sum(c < v for c in model.cuts[j])]
        for (j, k), t in model.pairs.items():
            total += t[sum(c < row[j] for c in model.coarse[j]), sum(c < row[k] for c in model.coarse[k])]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (6, None, None), (None, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(odd, labels)
    scores = {str(r.doc_id): r.score for r in quality.score(odd, model).collect()}
    assert len(scores) == 10 and scores["1"] == scores["2"] and all(0 <= s <= 1 for s in scores.values())
    unknown = quality.learn(odd, labels.filter("false"))
    assert {r.score for r in quality.score(odd, unknown).collect()} == {0.5}
    assert quality.score(nothing, model).count() == 0
    severity = toxicity.learn(odd, labels)
    assert toxicity.score(odd, severity).count() == odd.count()
    assert not any(r.toxic for r in toxicity.score(odd, toxicity.learn(odd, labels.filter("false"))).collect())
    assert toxicity.score(nothing, severity).count() == 0


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op3_toxicity(spark, folder).collect() if r.doc_id in labels]
    toxic = [r for r in rows if labels[r.doc_id] == 1]
    assert np.mean([r.toxic for r in toxic]) >= 0.85
    assert np.mean([r.toxic for r in rows if labels[r.doc_id] == 0]) <= 0.02
    assert all(0 <= r.expected_severity <= 2 and r.toxic == (r.score >= 0.5) for r in rows)


def test_cumulative_link_orders_grades():
    pick = np.random.default_rng(2)
    rows, grades = [], []
    for _ in range(900):
        level = int(pick.integers(0, 3))
        rows.append({1: float(level + pick.normal(0, 0.3)), 2: float(pick.normal())})
        grades.append(level)
    model = toxicity.fit(rows, np.array(grades), rounds=600)
    assert (np.diff(model.thresholds) > 0).all() and abs(model.weights[2]) < abs(model.weights[1])
    x = np.array([sum(model.weights[f] * v for f, v in r.items()) for r in rows])
    chances = model.chances(x)
    assert chances.sum(1) == pytest.approx(1)
    assert (chances.argmax(1) == grades).mean() > 0.85


def test_language_scores_do_not_depend_on_neighbours(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.Languages.learn(docs)
    found = []
    for parts in (1, 7):
        rows = language.identify(docs.repartition(parts), model).collect()
        found.append(sorted((r.doc_id, r.lang_pred, r.score, str(r.shares)) for r in rows))
    assert found[0] == found[1]
