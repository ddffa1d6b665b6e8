"""Aggregations over ratings, alone or joined to item genres.

All are ``groupBy().agg()`` with built-in aggregates, so Spark runs a partial (map-side)
aggregation before the shuffle: a hot user, item or genre contributes one row per task to the
exchange, never its whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.operators.items import explode_genres


def ratings_per_item(ratings: DataFrame, item: str = S.ITEM) -> DataFrame:
    """Number of ratings per item (A1). Items without ratings do not appear."""
    return ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n_ratings"))


def user_rating_totals(ratings: DataFrame, user: str = S.USER, rating: str = S.RATING) -> DataFrame:
    """Per user: sum, count and average of all their ratings (A2). Duplicate (user, item)
    rows all count (rule D11)."""
    return ratings.groupBy(user).agg(
        F.sum(rating).alias("rating_sum"),
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg(rating).alias("avg_rating"),
    )


def ratings_by_genre(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Each rating once per genre of its item (J1; inner join, so items without genres and
    ratings of unknown items drop out). Beyond a broadcast, adaptive execution splits a hot item: both
    sides come from plain exchanges and an item has few genres."""
    return ratings.join(explode_genres(items), on=S.ITEM)


def genre_avg_rating(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Average rating and number of ratings per genre (A3). A row without a rating counts neither in
    the average nor in the number, as in A2 and A4.

    Ratings are first reduced to one (sum, count) row per item and only then joined to the
    genres: the join and the genre shuffle see item-sized data, not rating-sized data. Sums of
    half-star ratings are exact in DOUBLE, so the result equals the row-by-row average.
    """
    per_item = ratings.groupBy(S.ITEM).agg(
        F.sum(S.RATING).alias("_sum"), F.count(S.RATING).alias("_n")
    )
    joined = per_item.join(explode_genres(items), on=S.ITEM)
    return joined.groupBy(S.GENRE).agg(
        (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias("avg_rating"),
        F.sum("_n").alias("n_ratings"),
    )


def genre_user_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Per (genre, user): number of ratings, their sum and average (A4)."""
    return (
        ratings_by_genre(ratings.select(S.USER, S.ITEM, S.RATING), items)
        .groupBy(S.GENRE, S.USER)
        .agg(
            F.count(F.lit(1)).alias("n_ratings"),
            F.sum(S.RATING).alias("rating_sum"),
            F.avg(S.RATING).alias("genre_avg"),
        )
    )


def dataset_counts(ratings: DataFrame) -> DataFrame:
    """One row: number of ratings, distinct users, distinct items (A8, A9). The rows grouped by user give
    the ratings and the users at once; the items are counted by grouping in a subquery of the plan. Rows
    are never expanded."""
    by_user = ratings.groupBy(S.USER).agg(F.count(F.lit(1)).alias("n"))
    items = ratings.select(S.ITEM).distinct().agg(F.count(S.ITEM).alias("n"))
    counts = by_user.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_ratings"), F.count(S.USER).alias("n_users"))
    return counts.select("n_ratings", "n_users", items.scalar().alias("n_items"))


def distinct_users(ratings: DataFrame) -> DataFrame:
    """The distinct user ids."""
    return ratings.select(S.USER).distinct()
