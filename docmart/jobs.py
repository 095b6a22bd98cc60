"""The two jobs as commands, for a scheduler or spark-submit:

    spark-submit --py-files docmart.zip docmart/jobs.py raw-to-staging --raw s3a://b/raw --staging s3a://b/staging
    spark-submit --py-files docmart.zip docmart/jobs.py staging-to-consume --staging s3a://b/staging --consume s3a://b/consume
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from docmart import schema
from docmart.plans import medallion
from docmart.session import get_session, scratch


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="docmart")
    jobs = out.add_subparsers(dest="job", required=True)
    raw = jobs.add_parser("raw-to-staging", help="landed snapshots to the nine staging tables")
    raw.add_argument("--raw", required=True, help="folder of landed snapshots")
    raw.add_argument("--staging", required=True, help="folder of the staging tables, replaced by each run")
    raw.add_argument("--snapshots", choices=("latest", "all"), default="latest")
    raw.add_argument("--multiline", action="store_true", help="files hold one JSON array each, not a record a line")
    raw.add_argument("--retention-days", type=int, help="leave out snapshots older than the newest by more")
    consume = jobs.add_parser("staging-to-consume", help="staging tables to the sixteen consume tables")
    consume.add_argument("--staging", required=True)
    consume.add_argument("--consume", required=True, help="folder of the published tables")
    consume.add_argument("--database", default="docmart")
    consume.add_argument("--run-ts", help="audit time as text; now by default")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Run one job; returns its tables as written. Its intermediate tables are removed."""
    args = parser().parse_args(argv)
    spark = spark or get_session(app=f"docmart-{args.job}")
    with scratch(spark):
        if args.job == "raw-to-staging":
            return medallion.raw_to_staging(spark, args.raw, args.staging, snapshots=args.snapshots,
                                            multiline=args.multiline, retention_days=args.retention_days)
        root = args.staging.rstrip("/")
        staging = {name: spark.read.parquet(f"{root}/{name}") for name in schema.STAGING_TABLES}
        return medallion.staging_to_consume(spark, staging, args.consume, args.database, args.run_ts)


if __name__ == "__main__":
    main()
