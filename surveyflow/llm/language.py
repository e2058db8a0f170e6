"""Language identification by a mixture of languages in every document.

Per-language multinomials over hashed letter trigrams are counted over all learning rows. A document
is a mixture of languages: expectation-maximisation estimates their proportions from the likelihoods
of its trigrams. The set of languages grows from the best single one: the language towards which the
likelihood rises fastest is added as long as the likelihood gains more than its penalty.

Edge cases: a null text and one without letters are ``und`` with score 0; ties go to the language
first in order of names; rows without a language or id teach nothing; with no learning rows at all
everything is ``und``; repeated rows count and are judged each; an empty table gives an empty
result. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import held, in_batches

UNKNOWN = "und"
#: Hash buckets of trigrams; with many languages fewer, so that a model has at most MOST_CELLS numbers.
BUCKETS, MOST_CELLS = 32768, 1 << 23
#: Languages a task counts at a time before it hands on what it has.
HELD_LANGUAGES = 32
#: Log-likelihood one more language must gain, times the logarithm of the number of trigrams.
PENALTY = 3.0
#: Share of the main language below which a filter rejects a text.
LEAST_SHARE = 0.5
ROUNDS, CLOSE = 30, 1e-4
#: Documents and characters that are worked on together.
DOCUMENTS, CHARACTERS = 256, 1 << 21


def letters(text: str = "text") -> Column:
    """Lower-cased letters with single spaces around words: what trigrams are taken from."""
    return F.regexp_replace(F.lower(quoted(text).cast("string")), r"[^\p{L}]+", " ")


def trigrams(text: str, buckets: int) -> np.ndarray:
    """Bucket of every trigram of bytes, the text having a space at both ends."""
    b = np.frombuffer(b" " + text.strip().encode("utf-8", "replace") + b" ", "u1").astype("u4")
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1)


def bucket_count(languages: int) -> int:
    """The largest power of two up to ``BUCKETS`` for which the model is within ``MOST_CELLS``."""
    return min(BUCKETS, 1 << max(4, (MOST_CELLS // max(1, languages)).bit_length() - 1))


def count(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, bucket and n: trigram counts over all rows whose language is known.

    Tasks count in arrays and hand on sparse rows, which Spark adds up; a task never holds more
    than a few languages.
    """
    rows = df.select(letters(text).alias("text"), quoted(lang).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("language", dict)
        counts_of: dict[str, np.ndarray] = {}

        def sparse() -> Iterator[pa.RecordBatch]:
            for name, counts in counts_of.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at.astype("i4")), pa.array(counts[at])], ["lang", "bucket", "n"]
                )
            counts_of.clear()

        for batch in batches:
            for text, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if name not in counts_of and len(counts_of) == HELD_LANGUAGES:
                    yield from sparse()
                counts = counts_of.setdefault(name, np.zeros(BUCKETS, "i8"))
                counts += np.bincount(trigrams(text.as_py(), BUCKETS), minlength=BUCKETS)
        yield from sparse()

    return in_batches(rows).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Languages:
    """Names of the languages, in order, and each bucket's probability in every one of them."""

    def __init__(self, names: list[str], chances: np.ndarray):
        self.names, self.chances = names, chances

    @classmethod
    def learn(cls, df: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
        """From all rows; what reaches the driver has at most a row per language and bucket of the model."""
        counts = count(df, text, lang).cache()
        try:
            names = sorted(r.lang for r in counts.select("lang").distinct().collect())
            buckets = bucket_count(len(names))
            narrow = F.floor(F.col("bucket") * F.lit(buckets) / F.lit(BUCKETS)).cast("int")
            sums = counts.groupBy("lang", narrow.alias("bucket")).agg(F.sum("n").alias("n")).toPandas()
        finally:
            counts.unpersist()
        table = np.zeros((buckets, len(names)))
        table[sums["bucket"], np.searchsorted(names, sums["lang"]) if names else []] = sums["n"]
        chances = (table + 0.5) / (table.sum(0) + 0.5 * buckets)
        return cls(names, chances.astype("f4"))

    def mixtures(self, texts: list[str], penalty: float = PENALTY) -> np.ndarray:
        """A row of proportions of all languages for every text that has letters."""
        found = [np.unique(trigrams(t, len(self.chances)), return_counts=True) if len(t) < 4096 else _counted(t, len(self.chances)) for t in texts]
        start = np.r_[0, np.cumsum([len(bucket) for bucket, _ in found])]
        chance = self.chances[np.concatenate([bucket for bucket, _ in found])].astype("f8")
        times = np.concatenate([n for _, n in found]).astype("f8")
        return self._select(chance, times, start[:-1], np.diff(start), penalty)

    def _select(self, chance, times, start, sizes, penalty) -> np.ndarray:
        total = np.add.reduceat(times, start)
        alone = np.add.reduceat(times[:, None] * np.log(chance), start)
        share = np.zeros_like(alone)
        share[np.arange(len(share)), alone.argmax(1)] = 1.0
        best = alone.max(1)
        open_ = np.arange(len(share))
        while len(open_) and len(self.names) > 1:
            entry = np.concatenate([np.arange(start[d], start[d] + sizes[d]) for d in open_])
            at = np.r_[0, np.cumsum(sizes[open_])][:-1]
            of = np.repeat(np.arange(len(open_)), sizes[open_])
            p, w = chance[entry], times[entry]
            mixed = (p * share[open_][of]).sum(1)
            rise = np.add.reduceat(w[:, None] * p / mixed[:, None], at) / total[open_, None]
            rise[share[open_] > 0] = -np.inf
            new = rise.argmax(1)
            trial = share[open_] * 0.8
            trial[np.arange(len(open_)), new] += 0.2
            hopeful = rise[np.arange(len(open_)), new] > 1
            trial, likely = _expectation(p, w, at, of, trial, total[open_])
            better = hopeful & (likely - best[open_] > penalty * np.log(total[open_] + 1))
            gained = open_[better]
            share[gained], best[gained] = trial[better], likely[better]
            open_ = gained
        return share


def _counted(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(trigrams(text, buckets), minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _expectation(p, w, at, of, share, total) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihoods after expectation-maximisation from ``share``.

    Each document rests by its own change, so what it gets does not depend on those beside it.
    """
    going = np.ones(len(share), bool)
    for _ in range(ROUNDS):
        joint = p * share[of]
        mixed = joint.sum(1)
        fresh = np.add.reduceat((w / mixed)[:, None] * joint, at) / total[:, None]
        moved = np.abs(fresh - share).max(1)
        share = np.where(going[:, None], fresh, share)
        going &= moved >= CLOSE
        if not going.any():
            break
    return share, np.add.reduceat(w * np.log((p * share[of]).sum(1)), at)


def _predicted(texts: pa.Array, model: Languages) -> Iterator[tuple[str, float, list[tuple[str, float]]]]:
    """Language, share and all shares of every normalised text (null: no letters)."""
    for at in range(0, len(texts), DOCUMENTS):
        some = texts.slice(at, DOCUMENTS).to_pylist()
        known = [t for t in some if t is not None] if model.names else []
        found = iter(row for part in _parts(known) for row in model.mixtures(part))
        for t in some:
            if t is None or not model.names:
                yield UNKNOWN, 0.0, []
            else:
                row = next(found)
                shares = [(model.names[i], float(row[i])) for i in np.flatnonzero(row)]
                yield model.names[int(row.argmax())], min(1.0, float(row.max())), shares


def _letters(text: str) -> Column:
    has_letter = F.coalesce(quoted(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    return F.when(has_letter, letters(text))


def identify(df: DataFrame, model: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (its share of the text) and shares (language to share) of every row."""
    rows = df.select(quoted(key).alias("doc_id"), _letters(text).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("language", dict)
        for batch in batches:
            names, scores, shares = zip(*_predicted(batch.column(1), model), strict=True) if batch.num_rows else ((), (), ())
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "shares"])

    fields = [("lang_pred", StringType()), ("score", DoubleType()), ("shares", MapType(StringType(), DoubleType()))]
    return in_batches(rows).mapInArrow(run, StructType([rows.schema["doc_id"], *(StructField(n, t) for n, t in fields)]))


def keep(df: DataFrame, model: Languages, text: str = "text", least: float = LEAST_SHARE) -> DataFrame:
    """The rows, as they are, with a known language that makes up at least ``least`` of the text."""
    columns = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("language", dict)
        for batch in batches:
            good = [name != UNKNOWN and share >= least for name, share, _ in _predicted(batch.column(columns), model)]
            rows = pa.RecordBatch.from_arrays(batch.columns[:columns], batch.schema.names[:columns])
            yield rows.filter(pa.array(good, pa.bool_()))

    return in_batches(df.select("*", _letters(text).alias("letters of the text"))).mapInArrow(run, df.schema)


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of a bounded number of characters; a longer text stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHARACTERS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part
