"""Item-side operators: genre lists, one row per genre, genre filter, title lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.functions.columns import genre_list


def items_with_genres(items: DataFrame, genres: str = S.GENRES) -> DataFrame:
    """Items that have a genre field (P7). Items with NULL genres are dropped everywhere (rule D4)."""
    return items.filter(F.col(genres).isNotNull())


def split_genres(items: DataFrame, genres: str = S.GENRES, out: str = "genre_list") -> DataFrame:
    """Add the genre list as ``array<string>`` (P5; empty entries dropped, rule D5)."""
    return items_with_genres(items, genres).withColumn(out, genre_list(genres))


def explode_genres(items: DataFrame, item: str = S.ITEM, genres: str = S.GENRES) -> DataFrame:
    """One (item_id, genre) row per listed genre (P6). A genre listed twice gives two rows."""
    return items_with_genres(items, genres).select(F.col(item), F.explode(genre_list(genres)).alias(S.GENRE))


def attach_titles(df: DataFrame, items: DataFrame, item: str = S.ITEM, title: str = S.TITLE) -> DataFrame:
    """Left-join titles onto ``df`` by item id (J6); a missing title is NULL, never an error. Spark
    broadcasts whichever side its measured size allows (the titles, or nothing)."""
    return df.join(items.select(item, title), on=item, how="left")
