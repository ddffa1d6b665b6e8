"""The ratings table seen as a sparse user x item matrix.

The long-form table *is* the sparse matrix: no matrix object, no dense array on the driver.
Column statistics count the implicit zeros of the users who did not rate an item, exactly as a
column summary of the dense matrix would (formulas in README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.functions.columns import safe_div
from prefkit.operators.similarity import dedupe_ratings


def matrix_dims(ratings: DataFrame) -> DataFrame:
    """One row: ``n_rows`` = users with at least one entry, ``n_cols`` = max item id + 1."""
    return ratings.agg(
        F.count_distinct(S.USER).alias("n_rows"),
        (F.max(S.ITEM) + F.lit(1)).alias("n_cols"),
    )


def item_column_summary(ratings: DataFrame, dedupe: bool = True) -> DataFrame:
    """Per item (matrix column) with at least one entry: nnz, normL1, normL2, mean, variance,
    min, max over all N users, implicit zeros included (M6b).

    A matrix cell holds one value, so duplicate (user, item) rows are first reduced to the
    latest one (``dedupe=True``, rule D11). N (number of rows) is a scalar subquery of the same
    plan: nothing runs before the result is asked for, and the ratings are read once.
    """
    m = dedupe_ratings(ratings) if dedupe else ratings
    # Users with any number of ratings. The number keeps the rating in the subquery's plan, whose exchange is
    # then the one that the deduplication makes anyway and is reused.
    users = m.groupBy(S.USER).agg(F.count(S.RATING).alias("k"))
    n = users.agg(F.count_if(F.col(S.USER).isNotNull() & (F.col("k") >= 0)).alias("n")).scalar()
    v = F.col(S.RATING)
    per_item = m.groupBy(S.ITEM).agg(
        F.count_if(v != 0).alias("nnz"),
        F.sum(F.abs(v)).alias("norm_l1"),
        F.sum(v).alias("_s"),
        F.sum(v * v).alias("_q"),
        F.count(F.lit(1)).alias("_c"),
        F.min(v).alias("_min"),
        F.max(v).alias("_max"),
    )
    per_item = per_item.withColumn("_n", n.cast("double"))
    n_lit = F.col("_n")
    has_zero = F.col("_c") < n_lit
    return per_item.select(
        S.ITEM,
        "nnz",
        "norm_l1",
        F.sqrt("_q").alias("norm_l2"),
        (F.col("_s") / n_lit).alias("mean"),
        safe_div(F.col("_q") - F.col("_s") * F.col("_s") / n_lit, n_lit - 1).alias("variance"),
        F.when(has_zero, F.least("_min", F.lit(0.0))).otherwise(F.col("_min")).alias("min"),
        F.when(has_zero, F.greatest("_max", F.lit(0.0))).otherwise(F.col("_max")).alias("max"),
    )


def popular_items(ratings: DataFrame, threshold: int = 300, dedupe: bool = True) -> DataFrame:
    """Items whose non-zero count is strictly above ``threshold``, in item order.

    Of a (user, item) the latest row counts, the highest rating of equal times (as in
    ``dedupe_ratings``). Only whether it is zero matters, so the pair keeps three times instead of rows: of its
    last row above, at and below zero. These are plain numbers, which are aggregated by hash without
    sorting the ratings first."""
    nonzero = F.col(S.RATING) != 0
    if dedupe:
        # No time is before every time.
        at = F.coalesce(F.col(S.TS), F.lit(-(2**63)))
        latest = lambda which: F.max(F.when(which, at))
        v = F.col(S.RATING)
        m = ratings.groupBy(S.USER, S.ITEM).agg(
            F.max(at).alias("_t"), latest(v > 0).alias("_up"), latest(v == 0).alias("_zero"), latest(v < 0).alias("_down")
        )
        below = (F.col("_down") == F.col("_t")) & ~F.coalesce(F.col("_zero") == F.col("_t"), F.lit(False))
        nonzero = (F.col("_up") == F.col("_t")) | below
    else:
        m = ratings
    nnz = m.groupBy(S.ITEM).agg(F.count_if(nonzero).alias("nnz"))
    return nnz.filter(F.col("nnz") > threshold).orderBy(S.ITEM)
