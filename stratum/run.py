"""Command-line entry point: run the pipeline once (available-now) or continuously.

    spark-submit stratum/run.py --registry s3a://lake/meta/sources.json \
        --root s3a://lake/payments [--continuous "1 minute"] [--full-refresh silver.transactions]

On a cluster the session comes from spark-submit; only the settings the
pipeline needs for identical results are applied on top (UTC, ANSI).
"""

from __future__ import annotations

import argparse
import os
import sys
import time

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from stratum.session import ensure_checkpoint_dir  # noqa: E402
from stratum.sources.registry import load_sources  # noqa: E402
from stratum.sources.tables import Layout  # noqa: E402
from stratum.streaming.flows import FlowOptions  # noqa: E402
from stratum.streaming.pipeline import Pipeline  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="bronze -> silver -> gold payments pipeline")
    ap.add_argument("--registry", required=True, help="source registry (JSON array file)")
    ap.add_argument("--root", required=True, help="shared storage root for tables/checkpoints")
    ap.add_argument("--continuous", metavar="INTERVAL", help='e.g. "1 minute"; default: once')
    ap.add_argument("--gold-every", type=float, default=600.0,
                    help="seconds between gold refreshes in continuous mode")
    ap.add_argument("--full-refresh", action="append", default=[], metavar="TABLE",
                    help="drop a table and its checkpoint before running (repeatable)")
    ap.add_argument("--no-catalog", action="store_true", help="do not register catalog tables")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # (spark.cleaner.referenceTracking.cleanCheckpoints=true is recommended for
    # --continuous: it is a launch-time setting, pass it with --conf.)
    ensure_checkpoint_dir(spark, args.root)
    opts = FlowOptions(processing_time=args.continuous)
    pipe = Pipeline(spark, Layout(args.root), load_sources(spark, args.registry), opts=opts,
                    register_tables=not args.no_catalog)
    for table in args.full_refresh:
        pipe.full_refresh(table)
    if not args.continuous:
        pipe.run()
        return 0
    pipe.run_bronze()
    pipe.run_silver()
    try:
        while True:  # gold views refreshed on a schedule while the streams run
            pipe.catch_up()
            pipe.run_gold()
            if pipe._has_source("users"):
                pipe.run_users()
            time.sleep(args.gold_every)
    finally:
        pipe.stop()


if __name__ == "__main__":
    sys.exit(main())
