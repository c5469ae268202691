"""Run every configured table once; exit 1 if any table failed.

    spark-submit --py-files tidewater.zip tidewater/__main__.py run.json [--report PATH] [--mode M]

The session comes from ``spark-submit`` (cluster settings stay there). The
run report is printed and, with ``--report``, appended as parquet.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    from tidewater.plans.config import specs_from_json
    from tidewater.plans.ingest import ingest_all, summarize
    from tidewater.plans.session import session_conf

    ap = argparse.ArgumentParser(prog="tidewater")
    ap.add_argument("config", help="JSON run configuration")
    ap.add_argument("--report", help="append the run report (parquet) here")
    ap.add_argument("--mode", help="override the configured load mode")
    args = ap.parse_args(argv)

    specs, config = specs_from_json(args.config)
    if args.mode:
        config = dataclasses.replace(config, mode=args.mode)
    spark = SparkSession.builder.appName("tidewater").getOrCreate()
    for key, value in session_conf(time_zone=config.time_zone).items():
        spark.conf.set(key, value)
    report = ingest_all(spark, specs, config).cache()
    report.show(len(specs), truncate=False)
    summary = summarize(report).first()
    if args.report:
        report.write.mode("append").parquet(args.report)
    print(f"tables={summary['tables']} succeeded={summary['succeeded']} "
          f"failed={summary['failed']} skipped={summary['skipped']}")
    return 1 if summary["failed"] else 0


if __name__ == "__main__":
    sys.exit(main())
