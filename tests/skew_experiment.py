"""Hot-user experiment: item similarity and centred ratings when one user holds a third of all ratings.

Broadcast joins are switched off so the self-join runs as a shuffle join, as it must when the
seed side is large. The plain join (no hot key split) and the salted join run alternately, twice
each; the second (warm) times are the ones to compare. Results must be identical.

Usage: python tests/skew_experiment.py [n_ratings]   (default 1,200,000)
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from prefkit.operators import similarity as SIM  # noqa: E402
from prefkit.session import RUNTIME_CONF, scratch_path  # noqa: E402


def main(n: int) -> None:
    b = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    )
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    hot = spark.range(0, n // 3).select(
        F.lit(7).cast("bigint").alias("user_id"),
        F.col("id").alias("item_id"),
        ((F.col("id") % 9) / 2 + 0.5).alias("rating"),
        (F.col("id") * 13).alias("ts"),
    )
    rest = spark.range(0, n - n // 3).select(
        (F.col("id") % 50000 + 100).alias("user_id"),
        ((F.col("id") * 7) % 20000).alias("item_id"),
        ((F.col("id") % 7) / 2 + 1.0).alias("rating"),
        (F.col("id") * 17 + 3).alias("ts"),
    )
    path = scratch_path(spark, "skew-ratings")
    hot.unionByName(rest).repartition(16).write.parquet(path)
    ratings = spark.read.parquet(path)
    personal = spark.createDataFrame(
        [(0, i, 4.0, 1) for i in range(0, 200, 10)], "user_id bigint, item_id bigint, rating double, ts bigint"
    )
    ops = {
        "item_similarity": lambda rpt: SIM.item_similarity(ratings, personal, rows_per_task=rpt),
        "centered_ratings": lambda rpt: SIM.centered_ratings(ratings, rows_per_task=rpt),
    }
    for op, build in ops.items():
        counts = {}
        for run in (1, 2):
            for label, rows_per_task in (("plain", 10**12), ("salted", 20_000)):
                t = time.time()
                out = build(rows_per_task)
                out.write.format("noop").mode("overwrite").save()
                counts[label] = out.count()
                print(f"run {run} {op} {label}: {time.time() - t:.2f} s, {counts[label]} rows", flush=True)
        assert counts["plain"] == counts["salted"]
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 1_200_000)
