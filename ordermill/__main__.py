"""Command line: python -m ordermill <job> --root <uri> [--date <day>] …"""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from ordermill.plans import jobs
from ordermill.session import build_session, remove_work
from ordermill.settings import Locations, Settings
from ordermill.sources.synthetic import SynthPlan


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ordermill")
    parser.add_argument(
        "job",
        choices=[
            "samples", "transfer", "validate", "enrich", "load", "publish", "publish-incremental",
            "publish-changes", "report", "test", "check", "expire", "daily",
        ],
    )
    parser.add_argument("--root", help="folder or URI that holds the zones")
    parser.add_argument("--config", help="YAML file with settings")
    parser.add_argument("--date", help="run date, YYYY-MM-DD")
    parser.add_argument("--to", help="last date of a report; the run date if left out")
    parser.add_argument("--origin", help="where transfer copies from")
    parser.add_argument("--event-types", choices=["list", "set", "counts"], default="list")
    parser.add_argument("--clustered", action="store_true", help="range-cluster the output files")
    parser.add_argument("--quick", action="store_true", help="validate by footers and headers only")
    parser.add_argument("--keep-raw", action="store_true", help="leave validated files in raw")
    parser.add_argument("--master", help="Spark master; the cluster's own if left out")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    settings = Settings.from_yaml(args.config) if args.config else Settings()
    if args.root:
        settings = replace(settings, locations=Locations.under(args.root))
    at = settings.locations
    if at is None:
        raise SystemExit("give --root, or root in the configuration")
    needs_date = {"samples", "enrich", "load", "publish", "report", "test", "check", "expire", "daily"}
    if args.job in needs_date and not args.date:
        raise SystemExit(f"{args.job} needs --date")
    spark = build_session(settings, args.master)
    last = args.to or args.date
    try:
        if args.job == "samples":
            jobs.make_samples(spark, at, SynthPlan(run_date=args.date))
        elif args.job == "transfer":
            print(jobs.transfer(spark, args.origin, at), "files transferred")
        elif args.job == "validate":
            jobs.validate(spark, at, args.keep_raw, args.quick).show()
        elif args.job == "enrich":
            jobs.enrich(spark, at, args.date, settings, args.event_types, args.clustered)
        elif args.job == "load":
            print(jobs.load(spark, at, args.date), "rows in staging")
        elif args.job == "publish":
            jobs.publish(spark, at, args.date).show(truncate=False)
        elif args.job == "publish-incremental":
            jobs.publish_incremental(spark, at, settings)
        elif args.job == "publish-changes":
            print(jobs.publish_changes(spark, at, settings), "changed rows")
        elif args.job == "report":
            jobs.report(spark, at, args.date, last).show(truncate=False)
        elif args.job == "test":
            results = jobs.test_columns(spark, at, args.date, last)
            results.show(truncate=False)
            return int(not results.where(F.col("failures") > 0).isEmpty())
        elif args.job == "check":
            results = jobs.check(spark, at, args.date, settings)
            results.show(truncate=False)
            return int(not results.where(~F.col("passed")).isEmpty())
        elif args.job == "expire":
            jobs.expire(spark, at, args.date, settings).show(truncate=False)
        else:
            jobs.daily(spark, at, args.date, settings)
    finally:
        remove_work(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
