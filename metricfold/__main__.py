"""Command line: run the flight metrics job once.

    python -m metricfold --catalog file_path.csv --store /shared/metrics [--seed metrics_store.csv]
    spark-submit --py-files metricfold.zip metricfold/__main__.py --catalog ... --store ...

The cluster (master, executors, ``spark.checkpoint.dir``) comes from
``spark-submit``; nothing here pins a master.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from metricfold.plans.flights import run_flight_job
from metricfold.session import DEFAULT_CONF


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="metricfold", description=__doc__.splitlines()[0])
    ap.add_argument("--catalog", required=True, help="CSV of (name, path) for flights, airports, airlines")
    ap.add_argument("--store", required=True, help="root of the versioned state and partials")
    ap.add_argument("--seed", help="CSV state file used once to seed an empty store")
    ap.add_argument("--start-afresh", nargs="*", default=(), metavar="METRIC",
                    help="metrics whose seeded dates are dropped: they count every row again")
    ap.add_argument("--as-of", type=dt.date.fromisoformat,
                    help="replay: see the flights as they stood at the end of this day")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("metricfold-job")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    results = run_flight_job(spark, args.catalog, args.store, seed_csv=args.seed, cut=args.as_of,
                             start_afresh=args.start_afresh)
    for name, res in results.items():
        s = res.state
        print(f"{name}: dateFrom={s.dateFrom} dateTo={s.dateTo} window={s.committedWindow}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
