"""File-to-file jobs: the reference's programs as complete Spark jobs.

Each job reads the ratings / items CSV files (or any DataFrame source), runs the operators and
writes the result with ``write_table``; the output path is always a parameter. These are what
a user runs with ``spark-submit``; the registered queries in ``prefkit.plans.queries`` are the
same operator chains over the test tables.

Staged inputs and checkpoints are written under a fresh ``prefkit-*`` sub-folder of the shared
folder for each run; they are left for the folder's own retention policy to remove (a job
cannot delete them safely while a retried stage might still read them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefkit import schemas as S
from prefkit.operators import aggregates as A
from prefkit.operators import factorize as M
from prefkit.operators import matrix as X
from prefkit.operators import similarity as SIM
from prefkit.operators import splits as SP
from prefkit.operators import topk as W
from prefkit.sources import read_items, read_personal_ratings, read_ratings
from prefkit.session import input_bytes_of, stored
from prefkit.sources.sinks import write_table


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back. Jobs that scan
    their ratings several times then parse the CSV once, and their lineage starts at a reliable
    columnar table."""
    return stored(df, f"staged-{name}")


def _ratings(spark: SparkSession, path: str, stage: bool) -> DataFrame:
    r = read_ratings(spark, path)
    return _staged(r, "ratings") if stage else r


def genre_average_job(spark: SparkSession, ratings_path: str, items_path: str, out: str) -> DataFrame:
    """Average rating per genre, written as ``genre<TAB>avg<TAB>n`` lines."""
    res = A.genre_avg_rating(read_ratings(spark, ratings_path), read_items(spark, items_path))
    write_table(res, out)
    return res


def genre_top_items_job(spark: SparkSession, ratings_path: str, items_path: str, out: str, k: int = 5) -> DataFrame:
    """The k most-rated items per genre, one ``genre<TAB>title:n, ...`` line per genre."""
    res = W.genre_top_items_packed(read_ratings(spark, ratings_path), read_items(spark, items_path), k)
    write_table(res, out)
    return res


def genre_top_users_job(
    spark: SparkSession, ratings_path: str, items_path: str, out: str, k: int = 5, stage: bool = True
) -> DataFrame:
    """The k most active users per genre with genre and overall statistics (the ratings are
    scanned twice, so with ``stage`` they are parsed once into a parquet table first)."""
    res = W.genre_top_users(_ratings(spark, ratings_path, stage), read_items(spark, items_path), k)
    write_table(res, out)
    return res


def matrix_statistics_job(spark: SparkSession, ratings_path: str, out: str, threshold: int = 300) -> dict:
    """Matrix dimensions (returned) and the items whose non-zero count exceeds ``threshold``
    (written as ``item<TAB>nnz`` in item order)."""
    ratings = read_ratings(spark, ratings_path)
    dims = X.matrix_dims(ratings).first().asDict()
    write_table(X.popular_items(ratings, threshold), out)
    return dims


def item_cf_job(
    spark: SparkSession,
    ratings_path: str,
    personal_path: str,
    items_path: str,
    out: str,
    k: int = 10,
    n: int = 50,
    stage: bool = True,
) -> DataFrame:
    """Neighbour-based top-n for the target user, written as ``rank<TAB>item<TAB>title<TAB>prediction``."""
    res = SIM.item_cf_recommend(
        _ratings(spark, ratings_path, stage), read_personal_ratings(spark, personal_path), read_items(spark, items_path), k, n
    )
    write_table(res, out)
    return res


def als_job(
    spark: SparkSession,
    ratings_path: str,
    personal_path: str,
    items_path: str,
    out: str,
    n: int = M.TOP_N,
    parallelism: int = 1,
    stage: bool = True,
    num_blocks: int | None = None,
    trials: str | None = None,
) -> dict:
    """Split on the timestamp digit, add the target user's rows to training, grid-search ALS,
    test the best model and write the target user's top-n with titles. Written next to these: the
    trial table and both factor tables of the best model. Returns the best cell and the split sizes.

    ``num_blocks`` (user and item blocks) follows from the size of the ratings file unless it is given,
    and is recorded in the trial rows. ``trials`` names a folder in which finished cells are kept: the job
    started again with it fits only those that are missing."""
    ratings = _ratings(spark, ratings_path, stage)
    num_blocks = num_blocks or M.blocks_for(input_bytes_of(spark, ratings_path))
    personal = read_personal_ratings(spark, personal_path)
    train, validation, test = SP.split_frames(ratings)
    training = train.unionByName(personal.select(*train.columns))
    result = M.grid_search(
        training, validation, test, parallelism=parallelism, num_blocks=num_blocks, trials_path=trials, check_errors=True
    )
    write_table(result.trials, f"{out.rstrip('/')}/trials")
    users = personal.select(S.USER).distinct()
    recs = M.recommend(result.best_model, users, n=n, items=read_items(spark, items_path))
    write_table(recs.select(S.USER, "rank", S.ITEM, S.TITLE, F.round("prediction", 6).alias("prediction")), f"{out.rstrip('/')}/recommendations")
    for side, factors in (("user", result.best_model.userFactors), ("item", result.best_model.itemFactors)):
        write_table(factors, f"{out.rstrip('/')}/{side}_factors", fmt="parquet")
    sizes = {r["split"]: r["n_ratings"] for r in SP.split_sizes(ratings).collect()}  # three rows
    return {"best": result.best, "sizes": sizes}
