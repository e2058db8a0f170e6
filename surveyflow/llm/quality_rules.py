"""Quality rules: repetition limits, and a log-likelihood ratio of hashed n-grams.

Token unigrams and bigrams are hashed into a fixed number of buckets. Two multinomials over the
buckets, one of a trusted target corpus and one of all documents, give each bucket a log-likelihood
ratio; a document is kept when the mean ratio of its n-grams reaches a fixed threshold. Only
DataFrame functions run: counting is one exploded aggregate over buckets, scoring and the
repetition counts stay within each row, and what is broadcast is the table of buckets.

Edge cases: a null or blank text has no words and fails the base rules; without trusted documents
every ratio is zero; repeated rows are judged alike; an empty table gives an empty result. Only
key and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import SPACE, narrow_side, texts

#: Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: Words and runs of marks are the tokens of the ratio.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
BUCKETS, UNIT = 65536, 10000
THRESHOLD = -0.5
#: A trusted set of more ids than this is joined by a shuffle and not broadcast.
MOST_TRUSTED = 2_000_000


def repetition(df: DataFrame) -> DataFrame:
    """Adds the base counts of the column ``text`` (never null) to ``df``.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words. Windows of words are compared
    by 64-bit hashes of word hashes. Where one occurs twice, the places of all such windows are
    put in order and the words they cover counted once each.
    """
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda word: word != "")
    counted = df.select(
        "*",
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        words.alias("_words"),
    ).select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), F.size("_hashes") - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    windows = F.transform(starts, lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW))))
    kept = [c for c in counted.columns if c != "_hashes"]
    windowed = counted.select(*kept, windows.alias("_windows"))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windowed.select(*kept, F.when(repeats, placed).alias("_placed"))

    def twice(x: Column, i: Column) -> Column:
        beside = (F.get("_placed", i - 1)["h"], F.get("_placed", i + 1)["h"])
        return F.when((x["h"] == beside[0]) | (x["h"] == beside[1]), x["i"])

    places = F.array_sort(F.filter(F.transform("_placed", twice), lambda i: i.isNotNull()))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def covered(so_far: Column, i: Column) -> Column:
        end = i + WINDOW
        return F.struct(end.alias("end"), (so_far["total"] + end - F.greatest(so_far["end"], i)).alias("total"))

    total = F.aggregate(places, none, covered, lambda so_far: so_far["total"])
    return ordered.select(*kept, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def _bucket(*tokens: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*tokens), F.lit(buckets)).cast("int")


def ratios(df: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Every bucket's log-likelihood ratio, trusted over raw, in units of 1 / ``UNIT``.

    ``trusted``: ids (column ``key``) of the target documents, counted as part of the raw corpus
    too. Counts start at one in every bucket.
    """
    target = trusted.select(quoted(key).alias("doc_id")).filter("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(1))
    tokens = texts(df, key, text).select("doc_id", F.regexp_extract_all("text", F.lit(TOKEN), 0).alias("tokens"))
    marked = tokens.join(narrow_side(target, MOST_TRUSTED), "doc_id", "left").select(F.coalesce("target", F.lit(0)).alias("target"), "tokens")
    pairs = marked.select("target", F.explode(F.arrays_zip("tokens", F.expr("slice(tokens, 2, greatest(size(tokens) - 1, 0))").alias("next"))).alias("pair"))
    one, two = F.col("pair.tokens"), F.col("pair.next")
    hashed = pairs.select(
        "target", _bucket(one, buckets=buckets).alias("first"), F.when(two.isNotNull(), _bucket(one, two, buckets=buckets)).alias("second")
    )
    counts = (
        hashed.select("target", F.explode(F.array("first", "second")).alias("bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("target").cast("long").alias("target"))
    )
    found = {r.bucket: (r.raw, r.target) for r in counts.collect()}  # a row per bucket at most
    raws, targets = (sum(pair[k] for pair in found.values()) for k in (0, 1))
    if not targets:
        return [0] * buckets
    smooth = [(found.get(b, (0, 0))[1] + 1, found.get(b, (0, 0))[0] + 1) for b in range(buckets)]
    return [round(UNIT * math.log((t / (targets + buckets)) / (r / (raws + buckets)))) for t, r in smooth]


def score(df: DataFrame, weights: list[int]) -> DataFrame:
    """Adds ``llr`` to ``df``: the mean ratio of the n-grams of ``text``, null without any."""
    buckets = len(weights)
    # One constant of the plan: a list of literals would be tens of thousands of expressions.
    constant = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    tokens = df.select("*", F.regexp_extract_all("text", F.lit(TOKEN), 0).alias("_tokens"))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("string").alias("last"))

    def add(so_far: Column, token: Column) -> Column:
        pair = F.get(constant, _bucket(so_far["last"], token, buckets=buckets))
        alone = F.get(constant, _bucket(token, buckets=buckets))
        both = so_far["sum"] + alone + F.when(so_far["last"].isNull(), 0).otherwise(pair)
        return F.struct(both.cast("long").alias("sum"), token.alias("last"))

    total = F.aggregate("_tokens", start, add, lambda so_far: so_far["sum"])
    size = F.size("_tokens")
    return tokens.select(*df.columns, F.when(size > 0, total / (2 * size - 1) / UNIT).alias("llr"))


def _verdicts(rows: DataFrame, weights: list[int], threshold: float) -> DataFrame:
    """``rows`` (with a column ``text``) and their base counts, llr, base_failed and kept."""
    counted = repetition(score(rows.withColumn("text", F.coalesce("text", F.lit(""))), weights)).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (F.coalesce("llr", F.lit(0.0)) >= threshold)
    return counted.select("*", failed.alias("base_failed"), kept.alias("kept"))


def judge(
    df: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, the base counts, llr, base_failed and kept of every document."""
    return _verdicts(texts(df, key, text), ratios(df, trusted, key, text, buckets), threshold)


def keep(
    df: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that are kept, as they are."""
    whole = df.select(F.struct(*(quoted(c) for c in df.columns)).alias("row"), quoted(text).cast("string").alias("text"))
    # The task's number in the projection and the condition keeps the optimizer from pushing the filter
    # below, where the expressions it stands for would be written out within one another.
    judged = _verdicts(whole, ratios(df, trusted, key, text, buckets), threshold).withColumn("here", F.spark_partition_id())
    return judged.filter(F.col("kept") & (F.col("here") >= 0)).select(*(F.col("row")[c].alias(c) for c in df.columns))
