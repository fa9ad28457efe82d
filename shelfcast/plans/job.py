"""Command line of a planning cycle: ``spark-submit shelfcast/plans/job.py --as-of 2026-08-31 --out <folder>``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from pathlib import Path

if __package__ in (None, ""):  # started as a script: the package is the folder above
    sys.path[0] = str(Path(__file__).resolve().parents[2])

from pyspark.sql import SparkSession  # noqa: E402

from shelfcast.operators.projection import SITE_MODES, SPINES  # noqa: E402
from shelfcast.plans.cycle import cycle_store, refresh  # noqa: E402
from shelfcast.session import builder  # noqa: E402
from shelfcast.sources.tables import read_inputs  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Refresh the stockout-risk tables for one planning cycle.")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="day of the stock count to start from")
    parser.add_argument("--inputs", help="folder with one Parquet table per input; default: catalog tables")
    parser.add_argument("--out", required=True, help="folder of the stored cycles")
    parser.add_argument("--history-months", type=int, default=24)
    parser.add_argument("--horizon-months", type=int, help="months after the stock count; default: all that have a forecast")
    parser.add_argument("--site-mode", choices=SITE_MODES, default="single")
    parser.add_argument("--spine", choices=SPINES, default="forecast")
    parser.add_argument("--threshold", type=int, default=0, help="a month is short below so many units")
    parser.add_argument("--cast", action="store_true", help="convert input columns to the contract's types")
    parser.add_argument(
        "--shuffled-gb", type=float, help="size shuffle partitions for this volume; default: the cluster's setting"
    )
    return parser.parse_args(argv)


def check_shared_folder(spark: SparkSession) -> None:
    """Fail before the first job, not after hours: intermediate tables need a folder that all executors share."""
    if not spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None):
        raise SystemExit("set spark.checkpoint.dir to a folder that all executors share")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    check_shared_folder(spark)
    refresh(
        read_inputs(spark, root=args.inputs, cast=args.cast),
        args.as_of,
        cycle_store(args.out, args.as_of),
        horizon_months=args.horizon_months,
        site_mode=args.site_mode,
        spine=args.spine,
        threshold=args.threshold,
        history_months=args.history_months,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    volume = None if args.shuffled_gb is None else int(args.shuffled_gb * 1e9)
    run(builder("shelfcast-cycle", shuffled_bytes=volume).getOrCreate(), args)


if __name__ == "__main__":
    main()
