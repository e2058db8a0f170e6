"""spark-submit load_job.py --root ... --db-host ... --db-name ...: tables, and the audit to root/_load_audit"""

from surveyflow.config import parse_job
from surveyflow.plans.load import load_all
from surveyflow.session import session
from surveyflow.sources.files import write_parquet
from surveyflow.sources.jdbc import write_jdbc


def run(spark, config):
    if config.database is None:
        raise ValueError("loading needs a database: --db-host and --db-name")
    audit = load_all(spark, config.root, lambda df, table: write_jdbc(df, table, config.database))
    write_parquet(audit, f"{config.root}/_load_audit", single_file=True)
    return audit


if __name__ == "__main__":
    job = parse_job()
    spark_session = session("load", object_store=job.root.startswith("s3a:"))
    try:
        print(f"{run(spark_session, job).count()} tables loaded; see {job.root}/_load_audit")
    finally:
        spark_session.stop()
