"""Finding the datasets below a folder of any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyflow.functions.cells import table_name
from surveyflow.sources.files import literal_path

CLASH_POLICIES = ("error", "last", "suffix")


class NameClash(ValueError):
    """Datasets would become the same table. ``clashes`` is the lazy list of all such names."""

    def __init__(self, message: str, clashes: DataFrame) -> None:
        super().__init__(message)
        self.clashes = clashes


def discover(
    spark: SparkSession, root: str, parquet_unit: str = "directory", on_clash: str = "error"
) -> DataFrame:
    """(table_name, path, format): each CSV file, and each folder of Parquet part files.

    ``parquet_unit="file"`` makes every Parquet file a table of its own; a folder named like one
    (``orders.parquet/part-0.parquet``, as Spark writes) is one file. Files and folders whose names start with '_' or '.' are skipped. A partitioned table, whose part files lie in
    folders ``name=value``, is one dataset. Spark lists the tree and reads no content.
    """
    if parquet_unit not in ("directory", "file") or on_clash not in CLASH_POLICIES:
        raise ValueError("unknown parquet_unit or on_clash")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{[cC][sS][vV],[pP][aA][rR][qQ][uU][eE][tT]}")
        .load(literal_path(root))
        .select("path")
    )
    # Partition folders belong to the table above them, unless every file is a table.
    if parquet_unit == "file":
        files = files.select(F.regexp_replace("path", r"(/[^/]+\.(?i:parquet))(/[^/=]+=[^/]*)*/[^/]+\.(?i:parquet)$", "$1").alias("path"))
    else:
        files = files.select(F.regexp_replace("path", r"(/[^/=]+=[^/]*)+(/[^/]+\.(?i:parquet))$", "$2").alias("path"))
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    kind = F.when(F.lower(name).endswith(".csv"), "csv").otherwise("parquet")
    stem = F.regexp_replace(name, r"(?i)(\.snappy)?\.(csv|parquet)$", "")
    folder = F.element_at(parts, -2)
    parent = F.regexp_replace("path", "/[^/]+$", "")
    whole = F.lit(parquet_unit == "directory") & (kind == "parquet")
    found = files.select(
        table_name(F.when(whole, folder).otherwise(stem)).alias("table_name"),
        F.when(whole, parent).otherwise(F.col("path")).alias("path"),
        kind.alias("format"),
    ).distinct()
    # Ordering by path components is the order in which a walk of the tree meets the datasets.
    order = Window.partitionBy("table_name").orderBy(F.split("path", "/"))
    numbered = found.withColumn("turn", F.row_number().over(order)).withColumn(
        "same", F.count(F.lit(1)).over(Window.partitionBy("table_name"))
    )
    if on_clash == "suffix":
        suffix = F.when(F.col("turn") > 1, F.concat(F.lit("_"), F.col("turn"))).otherwise("")
        return numbered.select(F.concat("table_name", suffix).alias("table_name"), "path", "format")
    if on_clash == "error":
        clashes = numbered.filter("turn = 2").select("table_name")
        shared = clashes.count()
        if shared:
            raise NameClash(f"{shared} table names are shared by several datasets, {clashes.first()[0]!r} among them", clashes)
    return numbered.filter("turn = same").select("table_name", "path", "format")
