"""spark-submit score_job.py --root ...: JSON bodies below root/requests and root/request-lines to tables below root

Files in requests are read whole; those in request-lines hold a body a line and are split, whatever their size.

scored: predictions; rejected: records and bodies that cannot be scored, and why; refused: bodies
without a single valid record.
"""

from functools import reduce

from pyspark.sql import DataFrame

from surveyflow.config import parse_job
from surveyflow.plans.score import score_bodies
from surveyflow.session import session
from surveyflow.sources.bundle import load_bundle
from surveyflow.sources.files import write_parquet
from surveyflow.sources.lines import files_below
from surveyflow.sources.records import read_bodies, read_body_lines


def has_files(path: str) -> bool:
    try:
        return bool(files_below(path))
    except FileNotFoundError:
        return False


def run(spark, config):
    bundle = load_bundle(spark, config.models_path)
    kinds = {"requests": read_bodies, "request-lines": read_body_lines}
    found = [read(spark, f"{config.root}/{name}") for name, read in kinds.items() if has_files(f"{config.root}/{name}")]
    if not found:
        raise FileNotFoundError(f"no request files below {config.root}")
    outcome = score_bodies(reduce(DataFrame.union, found), bundle)
    for name, rows in outcome.items():
        write_parquet(rows, f"{config.root}/{name}")
    return outcome


if __name__ == "__main__":
    job = parse_job()
    spark_session = session("score", object_store=job.root.startswith("s3a:"))
    try:
        run(spark_session, job)
    finally:
        spark_session.stop()
