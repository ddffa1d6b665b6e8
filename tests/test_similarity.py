from pyspark.sql import functions as F

from frames import rows
from prefkit.operators import similarity as SIM


def test_dedupe_latest_wins(spark):
    df = spark.createDataFrame(
        [(1, 1, 2.0, 10), (1, 1, 4.0, 30), (1, 1, 3.0, 20), (1, 2, 1.0, 5)],
        "user_id bigint, item_id bigint, rating double, ts bigint",
    )
    assert rows(SIM.dedupe_ratings(df)) == [(1, 1, 4.0, 30), (1, 2, 1.0, 5)]


def test_centered_ratings(ratings):
    c = {(r.user_id, r.item_id): round(r.centered, 6) for r in SIM.centered_ratings(ratings).collect()}
    assert c[(1, 1)] == 0.0 and c[(10, 6)] == 0.5 and c[(2, 1)] == -1.333333


def test_item_similarity_fixture(ratings, personal):
    got = {(r.seed_id, r.item_id): r.sim for r in SIM.item_similarity(ratings, personal).collect()}
    assert got == {
        (1, 1): 1.0,
        (1, 3): -0.759256602,
        (1, 5): -1.0,
        (1, 6): -0.96265094,
        (3, 1): -0.759256602,
        (3, 2): -1.0,
        (3, 3): 1.0,
        (3, 6): -0.08304548,
    }


def test_similarity_symmetric_and_bounded(ratings, personal):
    sims = {(r.seed_id, r.item_id): r.sim for r in SIM.item_similarity(ratings, personal).collect()}
    for (i, j), s in sims.items():
        assert -1.0 <= s <= 1.0
        if (j, i) in sims:
            assert sims[(j, i)] == s


def test_raters_of_seeds(ratings, personal):
    assert SIM.raters_of_seeds(ratings, personal).count() == 6


def test_co_rated_pairs_includes_self(ratings, personal):
    p = SIM.co_rated_pairs(ratings, personal)
    assert p.filter("seed_id = item_id").count() == 6
    # each (user, seed) pair meets every item that user rated
    assert p.count() == 17  # seed 1: users 1, 2, 3 rate 3 items each; seed 3: users 1, 2 (3 items), 10 (2)


def test_item_cf_recommend(ratings, personal, items):
    rec = SIM.item_cf_recommend(ratings, personal, items)
    got = [(r.item_id, round(r.prediction, 6)) for r in rec.orderBy("rank").collect()]
    assert got == [(1, 1.978953), (3, -1.021047), (2, -2.0), (6, -4.761751), (5, -5.0)]
    assert rec.filter("item_id = 1").first().title == "Paper Kite (1995)"


def test_recommend_at_most_n(ratings, personal, items):
    rec = SIM.item_cf_recommend(ratings, personal, items, n=2)
    assert rows(rec, "rank", "item_id") == [(1, 1), (2, 3)]


def test_unknown_target_user_gives_nothing(spark, ratings, items):
    nobody = spark.createDataFrame([], "user_id bigint, item_id bigint, rating double, ts bigint")
    assert SIM.item_cf_recommend(ratings, nobody, items).count() == 0


def test_neighbors_topk(ratings, personal):
    sims = SIM.item_similarity(ratings, personal)
    top = SIM.item_neighbors_topk(sims, k=1)
    assert rows(top.filter("item_id = 1"), "seed_id", "sim") == [(1, 1.0)]
    assert top.groupBy("item_id").count().filter(F.col("count") > 1).count() == 0


def test_shuffle_joins_give_the_same_answers(ratings, personal, items, no_broadcast):
    calls = (
        lambda: SIM.item_cf_recommend(ratings, personal, items),
        lambda: SIM.raters_of_seeds(ratings, personal),
        lambda: SIM.item_similarity(ratings, personal),
    )
    with no_broadcast():
        shuffled = [rows(f()) for f in calls]
    assert shuffled == [rows(f()) for f in calls]


def test_user_with_many_seeds_is_split(spark, no_broadcast):
    """Few rows, many seeds: the pairs decide how many salts a user gets, not the rows."""
    data = spark.range(0, 400).selectExpr("7L AS user_id", "id AS item_id", "(id % 9) / 2 + 0.5 AS rating", "id AS ts")
    more = spark.range(0, 50).selectExpr("id + 100 AS user_id", "id AS item_id", "3.0 AS rating", "id AS ts")
    ratings = data.unionByName(more).selectExpr("user_id", "item_id", "cast(rating AS double) rating", "ts")
    personal = spark.range(0, 200).selectExpr("0L AS user_id", "id AS item_id", "4.0D AS rating", "id AS ts")
    plain = SIM.co_rated_pairs(ratings, personal)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the data are small
    try:
        with no_broadcast():
            split = SIM.co_rated_pairs(ratings, personal, rows_per_task=5_000)  # 400 rows, but 80,000 pairs
            per_task = split.filter("user_id = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert plain.count() == split.count() == 400 * 200 + 50
    assert per_task <= 80_000 / 2
    assert rows(plain.groupBy("seed_id").count()) == rows(split.groupBy("seed_id").count())
