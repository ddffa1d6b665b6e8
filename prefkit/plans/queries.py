"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

Ratings and items come from ``prefkit.sources.bindings``. Column names match
``prefkit.plans.oracle``; floating outputs are rounded the same way there (9 decimals for
averages, similarities and statistics, 6 for predictions).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefkit import schemas as S
from prefkit.functions.columns import tab_line, timestamp_bucket
from prefkit.operators import aggregates as A
from prefkit.operators import factorize as M
from prefkit.operators import items as I
from prefkit.operators import matrix as X
from prefkit.operators import similarity as SIM
from prefkit.operators import splits as SP
from prefkit.operators import topk as W
from prefkit.session import input_bytes_of, scratch_path
from prefkit.sources import bindings as B
from prefkit.sources import readers as R
from prefkit.sources import sinks

AVG_DIGITS = 9
PRED_DIGITS = 6
# Parameters of the registered queries (the binding's items have at most ~55 ratings each, so
# the popularity threshold is lowered from the default 300; the survey answers get one stamp).
POPULAR_THRESHOLD = 40
RESPONSE_TS = 1_000_000_000
ALS_PARAMS = dict(rank=10, max_iter=10, reg=0.1, seed=42)
GRID_PARALLELISM = 8  # concurrent fits in the grid search, at most (results do not depend on it)

RATING_COLS = [S.USER, S.ITEM, S.RATING, S.TS]
ALS_COLS = [S.USER, S.ITEM, S.RATING]


def _r(c: str, d: int = AVG_DIGITS):
    return F.round(F.col(c), d).alias(c)


def _community(spark, sf_dir):
    return B.community_ratings(spark, sf_dir)


def _personal(spark, sf_dir):
    return B.personal_ratings(spark, sf_dir)


def _items(spark, sf_dir):
    return B.bind_items(spark, sf_dir)


# ---- sources and sinks -------------------------------------------------------------------


def _file(spark, lines, name):
    """A text file (folder) of ``lines`` under the shared folder: the input of a scan."""
    path = scratch_path(spark, f"file-{name}")
    lines.write.text(path)
    return path


def scan_ratings(spark, sf_dir):
    return R.read_ratings(spark, _file(spark, B.rating_lines(B.bind_ratings(spark, sf_dir)), "ratings"))


def scan_items(spark, sf_dir):
    return R.read_items(spark, _file(spark, B.item_lines(_items(spark, sf_dir)), "items"))


def scan_personal_ratings(spark, sf_dir):
    return R.read_personal_ratings(spark, _file(spark, B.rating_lines(_personal(spark, sf_dir)), "personal"))


def sink_roundtrip(spark, sf_dir):
    """Write the genre averages as tab-separated text under the shared folder and read them back."""
    path = scratch_path(spark, "sink")
    sinks.write_table(genre_avg_rating(spark, sf_dir), path, fmt="csv", sep="\t")
    schema = T.StructType(
        [
            T.StructField(S.GENRE, T.StringType()),
            T.StructField("avg_rating", T.DoubleType()),
            T.StructField("n_ratings", T.LongType()),
        ]
    )
    return sinks.read_table(spark, path, schema, fmt="csv", sep="\t")


def preferences_from_responses(spark, sf_dir):
    return R.preferences_from_responses(B.bind_responses(spark, sf_dir), user_id=0, ts=RESPONSE_TS)


# ---- items -------------------------------------------------------------------------------


def split_genres(spark, sf_dir):
    g = I.split_genres(_items(spark, sf_dir))
    return g.select(S.ITEM, F.size("genre_list").cast("bigint").alias("n_genres"), F.col("genre_list")[0].alias("first_genre"))


def explode_genres(spark, sf_dir):
    return I.explode_genres(_items(spark, sf_dir))


def items_with_genres(spark, sf_dir):
    return I.items_with_genres(_items(spark, sf_dir))


def attach_titles(spark, sf_dir):
    return I.attach_titles(A.ratings_per_item(_community(spark, sf_dir)), _items(spark, sf_dir))


# ---- projections / filters ---------------------------------------------------------------


def timestamp_bucket_q(spark, sf_dir):
    return _community(spark, sf_dir).withColumn("bucket", timestamp_bucket(S.TS))


def raters_of_seeds(spark, sf_dir):
    return SIM.raters_of_seeds(_community(spark, sf_dir), _personal(spark, sf_dir))


def popular_items(spark, sf_dir):
    return X.popular_items(_community(spark, sf_dir), threshold=POPULAR_THRESHOLD)


def centered_ratings(spark, sf_dir):
    c = SIM.centered_ratings(_community(spark, sf_dir))
    return c.select(*RATING_COLS, _r("user_mean"), _r("centered"))


def format_rows(spark, sf_dir):
    stats = A.genre_user_stats(_community(spark, sf_dir), _items(spark, sf_dir))
    return stats.select(tab_line(S.GENRE, S.USER, "n_ratings").alias("line"))


# ---- joins -------------------------------------------------------------------------------


def ratings_by_genre(spark, sf_dir):
    return A.ratings_by_genre(_community(spark, sf_dir), _items(spark, sf_dir))


def actual_vs_predicted(spark, sf_dir):
    """Validation ratings beside the item-mean baseline's predictions."""
    train, validation, _ = SP.split_frames(_community(spark, sf_dir))
    scored = M.predict_item_mean(M.item_mean_model(train), validation)
    return scored.select(
        S.USER, S.ITEM, F.col(S.RATING).alias("actual"), F.round("prediction", AVG_DIGITS).alias("predicted")
    )


def co_rated_pairs(spark, sf_dir):
    p = SIM.co_rated_pairs(_community(spark, sf_dir), _personal(spark, sf_dir))
    return p.select(S.USER, SIM.SEED, S.ITEM, _r("a"), _r("b"))


# ---- aggregations ------------------------------------------------------------------------


def ratings_per_item(spark, sf_dir):
    return A.ratings_per_item(_community(spark, sf_dir))


def user_rating_totals(spark, sf_dir):
    t = A.user_rating_totals(_community(spark, sf_dir))
    return t.select(S.USER, "rating_sum", "n_ratings", _r("avg_rating"))


def genre_avg_rating(spark, sf_dir):
    out = A.genre_avg_rating(_community(spark, sf_dir), _items(spark, sf_dir))
    return out.select(S.GENRE, _r("avg_rating"), "n_ratings")


def genre_user_stats(spark, sf_dir):
    s = A.genre_user_stats(_community(spark, sf_dir), _items(spark, sf_dir))
    return s.select(S.GENRE, S.USER, "n_ratings", "rating_sum", _r("genre_avg"))


def genre_top_items_packed(spark, sf_dir):
    return W.genre_top_items_packed(_community(spark, sf_dir), _items(spark, sf_dir))


def dataset_counts(spark, sf_dir):
    return A.dataset_counts(_community(spark, sf_dir))


def rating_error_metrics(spark, sf_dir):
    """Error of the item-mean baseline on the validation split; unscored rows count in n_total."""
    train, validation, _ = SP.split_frames(_community(spark, sf_dir))
    scored = M.predict_item_mean(M.item_mean_model(train), validation, how="left")
    m = M.error_metrics(scored)
    return m.select(_r("mse"), _r("rmse"), _r("reference_mse"), "n_scored", "n_total")


def distinct_users(spark, sf_dir):
    return A.distinct_users(_community(spark, sf_dir))


# ---- top-k -------------------------------------------------------------------------------


def genre_top_items(spark, sf_dir):
    return W.genre_top_items(_community(spark, sf_dir), _items(spark, sf_dir), k=5)


def genre_top_users(spark, sf_dir):
    t = W.genre_top_users(_community(spark, sf_dir), _items(spark, sf_dir), k=5)
    return t.select(S.GENRE, "rank", S.USER, "n_ratings", _r("genre_avg"), _r("overall_avg"), "overall_n")


def item_neighbors_topk(spark, sf_dir):
    sims = SIM.item_similarity(_community(spark, sf_dir), _personal(spark, sf_dir))
    return SIM.item_neighbors_topk(sims, k=10)


# ---- set operations and splits -----------------------------------------------------------


def training_with_personal(spark, sf_dir):
    return SP.training_with_personal(_community(spark, sf_dir), _personal(spark, sf_dir))


def split_assignment(spark, sf_dir):
    return SP.split_assignment(_community(spark, sf_dir))


def split_sizes(spark, sf_dir):
    return SP.split_sizes(_community(spark, sf_dir))


# ---- matrix and similarity ---------------------------------------------------------------


def matrix_dims(spark, sf_dir):
    return X.matrix_dims(_community(spark, sf_dir))


def item_column_summary(spark, sf_dir):
    s = X.item_column_summary(_community(spark, sf_dir))
    return s.select(S.ITEM, "nnz", _r("norm_l1"), _r("norm_l2"), _r("mean"), _r("variance"), "min", "max")


def item_similarity(spark, sf_dir):
    return SIM.item_similarity(_community(spark, sf_dir), _personal(spark, sf_dir))


def item_cf_recommend(spark, sf_dir):
    rec = SIM.item_cf_recommend(_community(spark, sf_dir), _personal(spark, sf_dir), _items(spark, sf_dir))
    return rec.select("rank", S.ITEM, S.TITLE, _r("prediction", PRED_DIGITS))


def dedupe_ratings(spark, sf_dir):
    return SIM.dedupe_ratings(_community(spark, sf_dir))


# ---- ALS: what has an exact answer (the metrics themselves are in the jobs) ----------------


def _als_splits(spark, sf_dir):
    """Training (the target user's rows included), validation and test. The ratings are bound and
    labelled in one pass, written once and read from there by the fits and the checks. Of the time only the
    bucket meets the orders: nothing else of it is needed."""
    path = scratch_path(spark, "als-ratings")
    rows = B.bind_ratings(spark, sf_dir, of_line=lambda lines: SP.with_bucket(lines).drop(S.TS))
    rows = SP.with_split(rows).select(*ALS_COLS, "split")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    own = F.col(S.USER) == B.TARGET_USER
    training = rows.filter(own | (F.col("split") == "train"))
    return [d.select(*ALS_COLS) for d in (training, *(rows.filter(~own & (F.col("split") == x)) for x in ("validation", "test")))]


def _als_bytes(spark, sf_dir):
    """Size of the tables that the ratings come from."""
    base = sf_dir.rstrip("/")
    return input_bytes_of(spark, *(f"{base}/{t}.parquet" for t in ("lineitem", "orders")))


def _blocks(spark, sf_dir):
    """Blocks of a fit, from the size of the tables that the ratings come from."""
    return M.blocks_for(_als_bytes(spark, sf_dir))


def _fitted(spark, sf_dir):
    """A model, its training rows and the validation rows."""
    training, validation, _ = _als_splits(spark, sf_dir)
    return M.fit_als(training, **ALS_PARAMS, num_blocks=_blocks(spark, sf_dir)), training, validation


def als_factors(spark, sf_dir):
    """Both sides of a fitted model; a user's factors must solve the user's equations."""
    model, training, _ = _fitted(spark, sf_dir)
    size = F.size("features").cast("bigint").alias("n_features")
    users = model.userFactors.select(F.col("id").cast("bigint").alias("id"), size)
    solved = M.solved_users(model, training, ALS_PARAMS["reg"])
    users = users.join(solved, on="id", how="left").select(F.lit("user").alias("side"), "id", "n_features", "solves")
    items = model.itemFactors.select(F.col("id").cast("bigint").alias("id"), size)
    return users.unionByName(items.select(F.lit("item").alias("side"), "id", "n_features", F.lit(None).cast("boolean").alias("solves")))


def als_predict(spark, sf_dir):
    """Every validation row, whether it can be scored (user and item seen in training), and whether its
    prediction is the product of the two factor vectors."""
    model, _, validation = _fitted(spark, sf_dir)
    scored = M.predict_with_dots(model, validation.select(S.USER, S.ITEM, S.RATING))
    ids = [F.col(c).cast("bigint").alias(c) for c in (S.USER, S.ITEM)]
    right = M.agrees(F.col("prediction"), F.col("dot"), F.col("dot_scale"))
    return scored.select(*ids, S.RATING, (~F.isnan("prediction")).alias("scored"), right.alias("agrees"))


def als_evaluate(spark, sf_dir):
    """Rows scored and in all, whether the metrics agree with each other, and with those of the factors'
    products."""
    model, _, validation = _fitted(spark, sf_dir)
    m = M.checked_errors(model, validation)
    same = F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) < 1e-9
    spread = F.abs(F.col("reference_mse") * F.col("n_total") - F.col("mse") * F.col("n_scored")) < 1e-6 * F.col("n_total")
    return m.select("n_scored", "n_total", (same & spread).alias("consistent"), "errors_agree")


def als_grid_search(spark, sf_dir):
    """The trials of the whole grid, each with its errors recomputed, and whether the one that is best is
    the first of those with the lowest error."""
    training, validation, test = _als_splits(spark, sf_dir)
    parallelism = M.fits_at_once(_als_bytes(spark, sf_dir), GRID_PARALLELISM)
    trials = M.grid_search(
        training,
        validation,
        test,
        num_blocks=_blocks(spark, sf_dir),
        parallelism=parallelism,
        reliable_inputs=False,  # read from the written ratings
        trials_path=scratch_path(spark, "als-trials"),
        check_errors=True,
    ).trials
    first = F.min_by("grid_pos", F.struct("rmse", "grid_pos"))
    best = trials.agg(((F.count_if("is_best") == 1) & (first == F.min(F.when(F.col("is_best"), F.col("grid_pos"))))).alias("ok"))
    return trials.select(
        *(F.col(c).cast("bigint").alias(c) for c in ("grid_pos", "rank", "max_iter", "num_blocks")),
        "reg",
        "n_scored",
        "n_total",
        "errors_agree",
        best.scalar().alias("best_is_lowest"),
    )


def als_recommend(spark, sf_dir):
    """The target user's list: gap-free ranks, falling predictions, items of the training rows, each one of
    the exact best 50 and none of these missing."""
    model, training, _ = _fitted(spark, sf_dir)
    users = _personal(spark, sf_dir).select(S.USER).distinct()
    recs = M.recommend(model, users, n=M.TOP_N, items=_items(spark, sf_dir))
    recs = M.checked_recommendations(recs, model, B.TARGET_USER, n=M.TOP_N)
    before = F.lag("prediction").over(Window.partitionBy(S.USER).orderBy("rank"))
    known = training.select(S.ITEM).distinct().withColumn("_known", F.lit(True))
    recs = recs.withColumn("falling", F.coalesce(F.col("prediction") <= before, F.lit(True))).join(known, on=S.ITEM, how="left")
    return recs.select(
        F.col(S.USER).cast("bigint").alias(S.USER),
        "rank",
        "falling",
        F.coalesce("_known", F.lit(False)).alias("known"),
        "in_exact_top",
        "list_complete",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and sinks
    "scan_ratings": scan_ratings,
    "scan_items": scan_items,
    "scan_personal_ratings": scan_personal_ratings,
    "sink_roundtrip": sink_roundtrip,
    "preferences_from_responses": preferences_from_responses,
    # projections, filters, scalar functions
    "split_genres": split_genres,
    "explode_genres": explode_genres,
    "items_with_genres": items_with_genres,
    "timestamp_bucket": timestamp_bucket_q,
    "raters_of_seeds": raters_of_seeds,
    "popular_items": popular_items,
    "centered_ratings": centered_ratings,
    "format_rows": format_rows,
    # joins
    "ratings_by_genre": ratings_by_genre,
    "actual_vs_predicted": actual_vs_predicted,
    "attach_titles": attach_titles,
    "co_rated_pairs": co_rated_pairs,
    # aggregations
    "ratings_per_item": ratings_per_item,
    "user_rating_totals": user_rating_totals,
    "genre_avg_rating": genre_avg_rating,
    "genre_user_stats": genre_user_stats,
    "genre_top_items_packed": genre_top_items_packed,
    "dataset_counts": dataset_counts,
    "rating_error_metrics": rating_error_metrics,
    "distinct_users": distinct_users,
    # top-k
    "genre_top_items": genre_top_items,
    "genre_top_users": genre_top_users,
    "item_neighbors_topk": item_neighbors_topk,
    # set operations, splits
    "training_with_personal": training_with_personal,
    "split_assignment": split_assignment,
    "split_sizes": split_sizes,
    # matrix, similarity
    "matrix_dims": matrix_dims,
    "item_column_summary": item_column_summary,
    "item_similarity": item_similarity,
    "item_cf_recommend": item_cf_recommend,
    "dedupe_ratings": dedupe_ratings,
    # factorisation
    "als_factors": als_factors,
    "als_predict": als_predict,
    "als_evaluate": als_evaluate,
    "als_grid_search": als_grid_search,
    "als_recommend": als_recommend,
}
