"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.session import scratch_path

#: Whether Spark drops a query's shuffle files at its end, and not when the driver next collects garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: White space that separates words: space and the five controls from tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in the lineage that outlives executors.

    What was shuffled for it is of no use any more, and its files go at once.
    """
    path = shared_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(FILE_CLEANUP, None)
    conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(FILE_CLEANUP) if before is None else conf.set(FILE_CLEANUP, before)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def release(tables: list[DataFrame]) -> None:
    """Empty stored tables that nothing reads any more: what was made of them has been stored itself."""
    for table in tables:
        table.sparkSession.range(0).write.mode("overwrite").parquet(table.stored_at)


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, so that further columns can neither clash nor be read."""
    return df.select(quoted(key).alias("doc_id"), quoted(text).cast("string").alias("text"))


def id_crc(key: Column) -> Column:
    """CRC-32 of the id written as text, unsigned; splits learning rows from held-out ones."""
    return F.crc32(key.cast("string"))


def in_batches(df: DataFrame, rows: int = 1000, size: int = 1 << 23) -> DataFrame:
    """``df``, after telling the session to hand rows to Python in batches of bounded length.

    Texts are long: the usual batch of ten thousand rows takes a worker's memory several times over.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that a Python worker holds few texts as objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def narrow_side(df: DataFrame, most_rows: int) -> DataFrame:
    """``df``, of a few narrow columns, to be broadcast if it has at most ``most_rows`` rows; else as it is."""
    return F.broadcast(df) if df.count() <= most_rows else df.hint("merge")


def learning_rows(
    docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled documents at most, whatever their number.

    Of more than ``most`` labelled ids those with the lowest hashes are taken. Conflicting labels
    of an id count as the least. The ids, bounded by ``most``, are what is broadcast.
    """
    known = labels.select(quoted(key).alias("doc_id"), quoted(label).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    return texts(docs, key, text).filter("text IS NOT NULL").join(F.broadcast(known), "doc_id")


_held: dict = {}


def held(name, make):
    """What ``make`` gives, kept by this Python worker until something else is to be held.

    Workers outlive tasks and serve one operator after another; each holds one large thing at most.
    """
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]
