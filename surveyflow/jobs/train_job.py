"""spark-submit train_job.py --root ... --dataset dropped|imputed"""

from surveyflow.config import parse_job
from surveyflow.operators.clean import surrogate_key
from surveyflow.plans.train import TrainConfig, train
from surveyflow.session import session
from surveyflow.sources.bundle import save_bundle, summary_row
from surveyflow.sources.files import write_metrics

KEY = "row_key"


def run(spark, config):
    """Train on a curated table; store the bundle and its metrics.

    Equal rows get equal keys, so duplicates are removed first: a key has to be unique.
    """
    curated = spark.read.parquet(config.curated_path).dropDuplicates()
    keyed = surrogate_key(curated, curated.columns, KEY).drop(*config.keys)
    bundle = train(keyed, [KEY], config=TrainConfig(text_columns=config.text_columns))
    save_bundle(spark, bundle, config.models_path)
    write_metrics(summary_row(spark, bundle, config.dataset), config.metrics_path)
    return bundle


if __name__ == "__main__":
    job = parse_job()
    spark_session = session("train", object_store=job.root.startswith("s3a:"))
    try:
        print(run(spark_session, job).metrics)
    finally:
        spark_session.stop()
