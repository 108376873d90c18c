"""Jobs for ``spark-submit`` or ``python -m bazaarline``.

``snapshot --raw DIR --root DIR --at 2024-01-02T03:00:00``  take the status history further
``build    --raw DIR --root DIR --run LABEL [--as-of DAY]``  build, check and report the marts
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from bazaarline.config import MartConfig
from bazaarline.plans.pipeline import build, report_acceptance, snapshot_orders
from bazaarline.sources.readers import load_raw_tables


def arguments(words: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="bazaarline", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("snapshot", "build"):
        job = jobs.add_parser(name)
        job.add_argument("--raw", required=True, help="folder of the raw tables")
        job.add_argument("--root", required=True, help="folder of the marts")
        job.add_argument("--format", default="parquet", choices=("parquet", "csv", "json", "orc"))
        job.add_argument("--seed", help="CSV of the category translation, if not a raw table")
        if name == "snapshot":
            job.add_argument("--at", required=True, type=datetime.fromisoformat)
        else:
            job.add_argument("--run", required=True, help="label of the run; labels order the runs")
            job.add_argument("--as-of", type=date.fromisoformat, help="default: the current date")
    return parser.parse_args(words)


def main(words: Sequence[str] | None = None) -> None:
    options = arguments(words)
    spark = SparkSession.builder.appName(f"bazaarline-{options.job}").getOrCreate()
    raw = load_raw_tables(spark, options.raw, options.format, seed=options.seed)
    if options.job == "snapshot":
        snapshot_orders(spark, raw, options.root, options.at)
        return
    config = MartConfig(as_of=options.as_of)
    marts = build(spark, raw, options.root, options.run, config)
    report_acceptance(raw, marts, options.root, options.run, config)


if __name__ == "__main__":
    main()
