"""spark-submit curate_job.py --root ... --dataset dropped|imputed"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from surveyflow.config import parse_job
from surveyflow.plans.curate import curate
from surveyflow.rules import SURVEY_RULES
from surveyflow.session import session
from surveyflow.sources.files import read_csv, write_parquet


def run(spark, config) -> dict[str, int]:
    """Curate the raw CSV and return the rows read and kept, counted in the writing job."""
    read, kept = Observation(), Observation()
    columns = spark.read.option("header", True).csv(config.raw_path).columns
    raw = read_csv(spark, config.raw_path, columns).observe(read, F.count(F.lit(1)).alias("rows"))
    curated = curate(raw, config.dataset, SURVEY_RULES, config.text_columns, keys=config.keys).observe(kept, F.count(F.lit(1)).alias("rows"))
    write_parquet(curated, config.curated_path)
    return {"read": read.get["rows"], "kept": kept.get["rows"]}


if __name__ == "__main__":
    job = parse_job()
    spark_session = session("curate", object_store=job.root.startswith("s3a:"))
    try:
        print(run(spark_session, job))
    finally:
        spark_session.stop()
