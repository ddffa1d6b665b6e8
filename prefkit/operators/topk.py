"""Deterministic top-k per group (W1, W2) and the packed per-genre list.

Top-k is ``row_number()`` over a window with a total order, filtered to ``<= k``. Spark plans
that filter as a ``WindowGroupLimit`` before and after the shuffle, so a hot group sends at most
k rows per task through the exchange; no group is ever collected into one list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.functions.columns import genre_list
from prefkit.operators.aggregates import genre_user_stats, ratings_per_item, user_rating_totals
from prefkit.operators.items import items_with_genres
from prefkit.session import stored


def top_k(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """Rows ranked 1..k within each partition (gap-free; ``order_by`` must be a total order).
    Spark plans the ``<= k`` filter as a ``WindowGroupLimit`` on both sides of the shuffle. With
    no ``partition_by`` the window is global (one task): use it only on bounded input, such as the
    output of ``orderBy().limit(n)``."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).filter(F.col(rank_col) <= k)


def _genres_with_titles(items: DataFrame) -> DataFrame:
    return items_with_genres(items).select(S.ITEM, S.TITLE, F.explode(genre_list(S.GENRES)).alias(S.GENRE))


def genre_top_items(ratings: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """The k most-rated items per genre (W1): count descending, then item id ascending (rule D7).

    Counts are computed before the join (the reference's aggregate-then-join order), unrated
    items are absent, and a genre with fewer than k rated items returns what it has (rule D6).
    Two items with equal titles stay apart (D14).
    """
    counts = ratings_per_item(ratings)
    joined = counts.join(_genres_with_titles(items), on=S.ITEM)
    ranked = top_k(joined, [S.GENRE], [F.col("n_ratings").desc(), F.col(S.ITEM).asc()], k)
    return ranked.select(S.GENRE, "rank", S.ITEM, S.TITLE, "n_ratings")


def genre_top_items_packed(ratings: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """One row per genre with its top items as text ``title:count, title:count, ...`` in rank
    order (A7). Only the k ranked rows per genre are collected, so each list is bounded by k."""
    top = genre_top_items(ratings, items, k)
    entries = F.array_sort(F.collect_list(F.struct("rank", S.TITLE, "n_ratings")))
    text = F.transform(entries, lambda e: F.concat(e[S.TITLE], F.lit(":"), e["n_ratings"].cast("string")))
    return top.groupBy(S.GENRE).agg(F.concat_ws(", ", text).alias("top_items"))


def genre_ranked_users(ratings: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """The k users with most ratings per genre (W2) with their genre average: count descending, then user id
    ascending compared **as text** (``"10"`` before ``"2"``), as the reference compares string ids."""
    stats = genre_user_stats(ratings, items)
    return top_k(stats, [S.GENRE], [F.col("n_ratings").desc(), F.col(S.USER).cast("string").asc()], k)


def genre_top_users(ratings: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """``genre_ranked_users`` with their overall average and count.

    The ranked rows, k per genre, are written when this
    is called; Spark knows their size and filters the ratings by them (broadcast while they are small),
    so that totals are summed for the ranked users only.
    """
    top = stored(genre_ranked_users(ratings, items, k), "top-users")
    of_ranked = ratings.select(S.USER, S.RATING).join(top.select(S.USER).distinct(), on=S.USER, how="left_semi")
    totals = user_rating_totals(of_ranked).select(
        S.USER, F.col("avg_rating").alias("overall_avg"), F.col("n_ratings").alias("overall_n")
    )
    return top.join(totals, on=S.USER).select(
        S.GENRE, "rank", S.USER, "n_ratings", "genre_avg", "overall_avg", "overall_n"
    )
