"""Binding of the driver-generated test tables to the ratings / items model.

The test tables hold no ratings, so a fixed, documented mapping derives them (all columns are
built-in expressions, identical in the DuckDB oracle):

  user_id  = o_custkey of the order the line item belongs to
  item_id  = l_partkey
  rating   = ceil(l_quantity / 5) / 2                       (0.5 .. 5.0 in half steps)
  ts       = epoch seconds of l_shipdate + (l_orderkey * 7 + l_linenumber) % 86400
  title    = p_name || ', ' || p_brand || ' (' || p_size || ')'   (contains a comma on purpose)
  genres   = p_type || '|' || the words of p_name joined by '|', NULL when p_partkey % 97 = 0
  response = text of l_linenumber - 1 + l_partkey % 2, 'x' when l_linenumber = 7

User 0 is the target ("personal") user; everybody else is the community. The offset in ``ts``
matters: ship dates are midnights, so without it every timestamp ends in 0 and the split
by last digit would put everything in "train".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefkit import schemas as S

# Fixed values of the binding (see module docstring).
TARGET_USER = 0
NO_GENRE_MODULUS = 97
NO_ANSWER_LINENUMBER = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bind_ratings(spark: SparkSession, sf_dir: str, of_line: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All ratings, the target user's included (columns of ``schemas.RATINGS``). How line items meet
    orders is left to Spark: orders are broadcast while they are small, and shuffled with the line
    items beyond that; a filter on one user reaches the orders scan. Item, rating and time come from the line
    item alone and are made before that; ``of_line`` may work on these columns there, and what it drops is
    not shuffled."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Day number and time of day: no session time zone (and no gap in one) takes part.
    clock = F.hour("l_shipdate") * 3600 + F.minute("l_shipdate") * 60 + F.second("l_shipdate")
    epoch = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + clock
    lines = li.select(
        "l_orderkey",
        F.col("l_partkey").alias(S.ITEM),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias(S.RATING),
        (epoch + (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 86400).alias(S.TS),
    )
    lines = of_line(lines) if of_line else lines
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(F.col("o_custkey").alias(S.USER), *[c for c in lines.columns if c != "l_orderkey"])


def community_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of everybody but the target user (the reference's ratings file)."""
    return bind_ratings(spark, sf_dir).filter(F.col(S.USER) != TARGET_USER)


def personal_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target user's ratings (the reference's personal ratings file)."""
    return bind_ratings(spark, sf_dir).filter(F.col(S.USER) == TARGET_USER)


def bind_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a comma-bearing title and a pipe-separated genre string (columns of ``schemas.ITEMS``)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    genres = F.when(
        F.col("p_partkey") % NO_GENRE_MODULUS == 0, F.lit(None).cast("string")
    ).otherwise(F.concat(F.col("p_type"), F.lit("|"), F.regexp_replace("p_name", " ", "|")))
    return p.select(
        F.col("p_partkey").alias(S.ITEM),
        F.concat(
            F.col("p_name"), F.lit(", "), F.col("p_brand"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")
        ).alias(S.TITLE),
        genres.alias(S.GENRES),
    )


def bind_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey answers (item_id, response) for the preference-import operator."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber")
    answer = F.when(F.col("l_linenumber") == NO_ANSWER_LINENUMBER, F.lit("x")).otherwise(
        (F.col("l_linenumber") - 1 + F.col("l_partkey") % 2).cast("string")
    )
    return li.select(F.col("l_partkey").alias(S.ITEM), answer.alias("response"))


def rating_lines(ratings: DataFrame) -> DataFrame:
    """Ratings rendered as headerless CSV lines in a ``value`` column (input for the text parsers)."""
    return ratings.select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in (S.USER, S.ITEM, S.RATING, S.TS)]).alias("value")
    )


def item_lines(items: DataFrame) -> DataFrame:
    """Items rendered as CSV lines: title always quoted (inner quotes doubled), the genre field
    omitted when NULL so that the line has only two fields."""
    quoted = F.concat(F.lit('"'), F.regexp_replace(S.TITLE, '"', '""'), F.lit('"'))
    return items.select(F.concat_ws(",", F.col(S.ITEM).cast("string"), quoted, F.col(S.GENRES)).alias("value"))


def materialize_bindings(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write the bound ratings and items once as parquet tables under the shared folder
    (``spark.checkpoint.dir``) and return their paths. Jobs that read them many times then scan
    columnar tables with no binding join in their lineage."""
    from prefkit.session import scratch_path

    paths = {}
    for name, fn in (("ratings", bind_ratings), ("items", bind_items)):
        paths[name] = scratch_path(spark, f"table-{name}")
        fn(spark, sf_dir).write.mode("overwrite").parquet(paths[name])
    return paths
