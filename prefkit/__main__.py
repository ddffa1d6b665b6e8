"""Command line for the file-to-file jobs, e.g. with spark-submit:

    spark-submit prefkit/__main__.py genre-average --ratings R --items I --out O
    python -m prefkit item-cf --ratings R --personal P --items I --out O

Jobs: genre-average, genre-top-items, genre-top-users, matrix-statistics, item-cf, als.
The session comes from the launcher (master, resources); only runtime SQL settings are applied, the
shuffle and scan sizes among them from the size of the input files.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from prefkit.plans import jobs  # noqa: E402
from prefkit.session import configure, input_bytes_of  # noqa: E402


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="prefkit")
    sub = p.add_subparsers(dest="job", required=True)

    def add(name, *need, **extra):
        s = sub.add_parser(name)
        for arg in need:
            s.add_argument(f"--{arg}", required=True)
        s.add_argument("--out", required=True)
        for arg, (typ, default) in extra.items():
            s.add_argument(f"--{arg.replace('_', '-')}", type=typ, default=default)
        return s

    add("genre-average", "ratings", "items")
    add("genre-top-items", "ratings", "items", k=(int, 5))
    add("genre-top-users", "ratings", "items", k=(int, 5))
    add("matrix-statistics", "ratings", threshold=(int, 300))
    add("item-cf", "ratings", "personal", "items", k=(int, 10), n=(int, 50))
    add("als", "ratings", "personal", "items", n=(int, 50), parallelism=(int, 1), num_blocks=(int, None), trials=(str, None))
    return p


def run(args, spark) -> object:
    if args.job == "genre-average":
        return jobs.genre_average_job(spark, args.ratings, args.items, args.out)
    if args.job == "genre-top-items":
        return jobs.genre_top_items_job(spark, args.ratings, args.items, args.out, args.k)
    if args.job == "genre-top-users":
        return jobs.genre_top_users_job(spark, args.ratings, args.items, args.out, args.k)
    if args.job == "matrix-statistics":
        return jobs.matrix_statistics_job(spark, args.ratings, args.out, args.threshold)
    if args.job == "item-cf":
        return jobs.item_cf_job(spark, args.ratings, args.personal, args.items, args.out, args.k, args.n)
    if args.job == "als":
        return jobs.als_job(
            spark, args.ratings, args.personal, args.items, args.out, args.n, args.parallelism, num_blocks=args.num_blocks, trials=args.trials
        )
    raise ValueError(args.job)


def main(argv=None) -> int:
    from pyspark.sql import SparkSession

    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"prefkit-{args.job}").getOrCreate()
    inputs = [getattr(args, a) for a in ("ratings", "personal", "items") if getattr(args, a, None)]
    configure(spark, input_bytes=input_bytes_of(spark, *inputs))
    result = run(args, spark)
    if isinstance(result, dict):
        print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
