"""Continuous scoring of record batches that arrive as JSON files.

Scoring is a narrow map, so the stream needs neither state nor a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from surveyflow.plans.score import BODY_KEYS, score_records
from surveyflow.rules import SURVEY_RULES, RuleSet
from surveyflow.sources.bundle import Bundle
from surveyflow.sources.records import read_bodies, read_records

KEYS = BODY_KEYS


def record_stream(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of new files below ``path``, readable or not, keyed by body and position."""
    return read_records(read_bodies(spark, path, stream=True), "value", columns, keys=["body"])


def start_scoring(
    records: DataFrame, bundle: Bundle, output: str, rules: RuleSet = SURVEY_RULES, **trigger
) -> list[StreamingQuery]:
    """Append predictions and rejections to two Parquet tables, each row exactly once.

    The file sink's commit log and the checkpoint make a restart or a lost executor harmless.
    """
    scored, rejected = score_records(records, bundle, KEYS, rules)
    queries = []
    for name, rows in (("scored", scored), ("rejected", rejected)):
        writer = rows.writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{output}/{name}").option("checkpointLocation", f"{output}/checkpoints/{name}")
        queries.append(writer.trigger(**(trigger or {"availableNow": True})).start())
    return queries
