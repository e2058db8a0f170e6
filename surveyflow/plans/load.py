"""Load every dataset below a folder into tables of a relational database."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.operators.clean import normalize_table
from surveyflow.sources.discover import discover
from surveyflow.sources.files import read_table


AUDIT = ("rows", "hash_sum", "hash_xor")


class NothingFound(RuntimeError):
    """There is no CSV or Parquet dataset below the folder."""


class Differs(RuntimeError):
    """What a table holds after loading is not what was handed to the writer."""


def _fingerprint(columns: list[str]) -> list[Column]:
    """Number of rows, sum and exclusive or of their hashes: the same for any order, and for equal contents alone.

    A row is hashed by its cells and their NULL flags, so that a NULL and an equal neighbour never stand for each other.
    """
    flags = F.array(*[quoted(c).isNull() for c in columns])
    row = F.xxhash64(*[quoted(c) for c in columns], flags)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
    ]


def load_all(
    spark: SparkSession,
    root: str,
    write: Callable[[DataFrame, str], None],
    parquet_unit: str = "directory",
    on_clash: str = "error",
    parallel: int = 4,
    read_back: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """Normalise each dataset and hand it to ``write(df, table_name)``; returns (table_name, path, rows, hash_sum, hash_xor).

    Rows are counted and fingerprinted while they are written, so each dataset is read once. With ``read_back(table_name)``
    the loaded table is fingerprinted too, and ``Differs`` is raised if it is not the same. Up to ``parallel``
    datasets are loaded at a time, so that small ones do not wait for the last task of another.
    """
    datasets = discover(spark, root, parquet_unit, on_clash).orderBy("table_name").collect()
    if not datasets:
        raise NothingFound(f"{root} has no dataset to load")

    def load(dataset) -> tuple[str, str, int, str, int]:
        seen = Observation()
        table = normalize_table(read_table(spark, dataset["path"], dataset["format"]))
        name, parts = dataset["table_name"], _fingerprint(table.columns)
        write(table.observe(seen, *parts), name)
        given = tuple(seen.get[c] for c in AUDIT)
        if read_back is not None:
            found = tuple(read_back(name).select(*[quoted(c) for c in table.columns]).agg(*parts).first())
            if found != given:
                raise Differs(f"{name}: handed over {given}, found {found} (rows, hash sum, hash xor)")
        return name, dataset["path"], *given

    with ThreadPoolExecutor(parallel) as pool:
        audit = list(pool.map(inheritable_thread_target(spark)(load), datasets))
    return spark.createDataFrame(audit, "table_name string, path string, rows long, hash_sum string, hash_xor long")
