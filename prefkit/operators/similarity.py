"""Item-item adjusted-cosine similarity and neighbour-based recommendation.

For a seed item i (one the target user rated) and any item j, over the users u who rated both:

    a = r(u, i) - mean(u),  b = r(u, j) - mean(u),  sim(i, j) = sum(a b) / (sqrt(sum a^2) sqrt(sum b^2))

Pairs with a zero denominator are dropped; the self pair (i, i) is kept. mean(u) uses all of the
user's rows; r(u, .) uses the latest rating of a duplicated (user, item) (rule D11). The
prediction for item j is sum(sim * p(i)) / sum(|sim|) over j's ``k`` most similar seeds, p(i)
being the target user's rating; it is not mean-restored, so values may leave the rating scale.

Plan: one pass over the ratings collapses them to a row per (user, item) with the latest rating and
what the user's mean needs of all copies (an aggregation, partial before the shuffle, so a group of
copies is collapsed by the tasks that read it). That table is written once; the seed side, the user means and
the hot users are read from it. The seed-side rows (few per user) carry the user mean. A user gets as many salts as the pairs that the self-join gives for them need
(their rows times the seeds they rated), so neither a user with a third of all rows nor one with
many seeds is one task. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.functions.columns import safe_div
from prefkit.operators.items import attach_titles
from prefkit.operators.joins import DEFAULT_ROWS_PER_TASK, hot_keys, skew_safe_join
from prefkit.operators.topk import top_k
from prefkit.session import stored

SEED = "seed_id"

# Fixed value: decimals kept on similarities and predictions before ranking them, so that the
# order does not depend on the last bit of a floating sum (ties then break by id).
RANK_DIGITS = 9


def dedupe_ratings(ratings: DataFrame) -> DataFrame:
    """One row per (user, item): the latest ``ts`` wins, a tie goes to the higher rating.
    An aggregation, not a window, so a hot (user, item) key is reduced map-side."""
    last = F.max(F.struct(F.col(S.TS), F.col(S.RATING))).alias("_last")
    return ratings.groupBy(S.USER, S.ITEM).agg(last).select(
        S.USER, S.ITEM, F.col("_last." + S.RATING).alias(S.RATING), F.col("_last." + S.TS).alias(S.TS)
    )


def collapsed_ratings(ratings: DataFrame) -> DataFrame:
    """``dedupe_ratings`` with the sum (``rating_sum``) and number (``n_rated``) of all ratings of the pair:
    whatever is asked per user or per pair of all rows follows from these rows."""
    last = F.max(F.struct(F.col(S.TS), F.col(S.RATING))).alias("_last")
    pairs = ratings.groupBy(S.USER, S.ITEM).agg(
        last, F.sum(S.RATING).alias("rating_sum"), F.count(S.RATING).alias("n_rated")
    )
    return pairs.select(
        S.USER,
        S.ITEM,
        F.col("_last." + S.RATING).alias(S.RATING),
        F.col("_last." + S.TS).alias(S.TS),
        "rating_sum",
        "n_rated",
    )


def user_stats(ratings: DataFrame) -> DataFrame:
    """Per user: mean of all their rows (``user_mean``) and row count ``n`` (used to find hot users)."""
    return ratings.groupBy(S.USER).agg(F.avg(S.RATING).alias("user_mean"), F.count(F.lit(1)).alias("n"))


def centered_ratings(ratings: DataFrame, rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """Each rating minus its user's average over all the user's ratings (P13, A5). The join of
    ratings to the per-user means splits hot users across tasks."""
    stats = user_stats(ratings)
    joined = skew_safe_join(
        ratings,
        stats.select(S.USER, "user_mean"),
        S.USER,
        stats.select(S.USER, "n"),
        salt_cols=[S.ITEM, S.TS, S.RATING],
        rows_per_task=rows_per_task,
    )
    return joined.withColumn("centered", F.col(S.RATING) - F.col("user_mean"))


def seed_items(personal: DataFrame) -> DataFrame:
    """The target user's items with their (latest) rating: ``seed_id, p``."""
    return dedupe_ratings(personal).select(F.col(S.ITEM).alias(SEED), F.col(S.RATING).alias("p"))


def raters_of_seeds(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """Community ratings of the seed items (P10: "has this user rated item i?")."""
    return ratings.join(seed_items(personal).select(F.col(SEED).alias(S.ITEM)), on=S.ITEM, how="left_semi")


def co_rated_pairs(
    ratings: DataFrame, personal: DataFrame, rows_per_task: int = DEFAULT_ROWS_PER_TASK
) -> DataFrame:
    """(user_id, seed_id, item_id, a, b) for every user who rated seed i and item j, j = i
    included (J7). One join replaces the reference's per-seed loop of unions (U2). The collapsed ratings
    are written when this is called (one pass over ``ratings``); the rest runs when it is asked for.

    The seed side (each user's ratings of seed items, with the user's mean attached) is replicated
    once per salt of its user; the user's full rating list is split by a hash of the item.
    ``rows_per_task`` is the number of pairs that one salt may give.
    """
    pairs = stored(collapsed_ratings(ratings), "rated-pairs")
    seed_side = raters_of_seeds(pairs, personal).select(S.USER, F.col(S.ITEM).alias(SEED), F.col(S.RATING).alias("_ri"))
    mean = safe_div(F.sum("rating_sum"), F.sum("n_rated")).alias("user_mean")
    stats = pairs.groupBy(S.USER).agg(mean, F.count(F.lit(1)).alias("n"))
    seeds_rated = seed_side.groupBy(S.USER).agg(F.count(F.lit(1)).alias("_m"))
    work = stats.join(seeds_rated, on=S.USER).select(S.USER, (F.col("n") * F.col("_m")).alias("n"))
    hot = hot_keys(work, S.USER, rows_per_task)
    nsalt = F.coalesce(F.col("_nsalt"), F.lit(1))
    salt = F.pmod(F.xxhash64(S.ITEM), nsalt).cast("int")
    latest = pairs.select(S.USER, S.ITEM, S.RATING).join(hot, on=S.USER, how="left").withColumn("_salt", salt).drop("_nsalt")
    seed_side = seed_side.join(stats.select(S.USER, "user_mean"), on=S.USER).join(hot, on=S.USER, how="left")
    seed_side = seed_side.withColumn("_salt", F.explode(F.sequence(F.lit(0), nsalt - 1))).drop("_nsalt")
    both = latest.join(seed_side, on=[S.USER, "_salt"])
    return both.select(
        S.USER,
        SEED,
        S.ITEM,
        (F.col("_ri") - F.col("user_mean")).alias("a"),
        (F.col(S.RATING) - F.col("user_mean")).alias("b"),
    )


def item_similarity(
    ratings: DataFrame,
    personal: DataFrame,
    digits: int | None = RANK_DIGITS,
    rows_per_task: int = DEFAULT_ROWS_PER_TASK,
) -> DataFrame:
    """Adjusted cosine ``sim`` for each (seed_id, item_id) with a non-zero denominator (M7),
    with ``n_users`` co-raters. ``digits`` rounds ``sim`` (None keeps the raw value)."""
    pairs = co_rated_pairs(ratings, personal, rows_per_task)
    sums = pairs.groupBy(SEED, S.ITEM).agg(
        F.sum(F.col("a") * F.col("b")).alias("_ab"),
        F.sum(F.col("a") * F.col("a")).alias("_aa"),
        F.sum(F.col("b") * F.col("b")).alias("_bb"),
        F.count(F.lit(1)).alias("n_users"),
    )
    den = F.sqrt("_aa") * F.sqrt("_bb")
    sim = F.col("_ab") / den
    if digits is not None:
        sim = F.round(sim, digits)
    return sums.filter(den != 0).select(SEED, S.ITEM, sim.alias("sim"), "n_users")


def item_neighbors_topk(similarity: DataFrame, k: int = 10) -> DataFrame:
    """For each item, its k most similar seeds (W3): sim descending, seed id ascending."""
    ranked = top_k(similarity, [S.ITEM], [F.col("sim").desc(), F.col(SEED).asc()], k)
    return ranked.select(S.ITEM, "rank", SEED, "sim")


def item_predictions(
    ratings: DataFrame,
    personal: DataFrame,
    k: int = 10,
    digits: int | None = RANK_DIGITS,
    rows_per_task: int = DEFAULT_ROWS_PER_TASK,
) -> DataFrame:
    """Predicted rating of every item that has at least one seed neighbour (A11 over W3).
    A zero sum of |sim| gives no prediction (rule D12)."""
    top = item_neighbors_topk(item_similarity(ratings, personal, digits, rows_per_task), k)
    seeds = seed_items(personal)
    pred = top.join(seeds, on=SEED).groupBy(S.ITEM).agg(
        safe_div(F.sum(F.col("sim") * F.col("p")), F.sum(F.abs("sim"))).alias("prediction")
    )
    if digits is not None:
        pred = pred.withColumn("prediction", F.round("prediction", digits))
    return pred.filter(F.col("prediction").isNotNull())


def item_cf_recommend(
    ratings: DataFrame,
    personal: DataFrame,
    items: DataFrame,
    k: int = 10,
    n: int = 50,
    digits: int | None = RANK_DIGITS,
    rows_per_task: int = DEFAULT_ROWS_PER_TASK,
) -> DataFrame:
    """The n items with the highest prediction (M9, W4), ties by item id, with titles.
    Seeds themselves are eligible. ``orderBy().limit()`` runs as a per-partition top-n."""
    pred = item_predictions(ratings, personal, k, digits, rows_per_task)
    best = pred.orderBy(F.col("prediction").desc(), F.col(S.ITEM).asc()).limit(n)
    # ``best`` holds at most n rows, so numbering them in one unpartitioned window is bounded.
    ranked = top_k(best, [], [F.col("prediction").desc(), F.col(S.ITEM).asc()], n)
    return attach_titles(ranked, items).select("rank", S.ITEM, S.TITLE, "prediction")
