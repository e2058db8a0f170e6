"""Spark session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

TUNING = {
    "spark.sql.codegen.maxFields": "40",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
CHECKPOINT_CONF = "spark.checkpoint.dir"


def store_options(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Hadoop settings of an S3-compatible object store. Secrets come from the environment only."""
    options = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": env.get("STORE_SSL", "false"),
    }
    if env.get("STORE_ENDPOINT"):
        options["spark.hadoop.fs.s3a.endpoint"] = env["STORE_ENDPOINT"]
    if env.get("AWS_ACCESS_KEY_ID") and env.get("AWS_SECRET_ACCESS_KEY"):
        options["spark.hadoop.fs.s3a.access.key"] = env["AWS_ACCESS_KEY_ID"]
        options["spark.hadoop.fs.s3a.secret.key"] = env["AWS_SECRET_ACCESS_KEY"]
        options["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return options


def session(
    app: str = "surveyflow",
    master: str | None = None,
    object_store: bool = False,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; ``conf`` overrides anything."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # No Python call-site capture per Column: plans here hold hundreds of them.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if object_store:
        settings.update(store_options())
    settings.update(TUNING)
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Settings for very wide rows, changeable in a running session.

    Whole-stage code over some 60 columns grows past 8,000 bytes per method, which
    HotSpot never compiles, or past the 64 KB class-file limit. Operators wider than
    ``maxFields`` use split per-operator code instead; narrow ones keep whole-stage code.
    """
    for name, value in TUNING.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all machines share, as the cluster names it.

    Only where driver and executors are one process, and nothing is set, a temporary folder does.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="surveyflow-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
