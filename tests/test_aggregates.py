import pytest
from pyspark.sql import functions as F

from frames import rows
from prefkit.functions.columns import genre_list
from prefkit.operators import aggregates as A
from prefkit.operators import items as I


def test_genre_list_drops_empty_entries(spark):
    df = spark.createDataFrame([("A||B",), ("A|B||",), ("A|A",), ("(no genres listed)",), (None,)], "genres string")
    got = [r.g for r in df.select(genre_list("genres").alias("g")).collect()]
    assert got == [["A", "B"], ["A", "B"], ["A", "A"], ["(no genres listed)"], None]


def test_explode_and_filter(items):
    assert I.items_with_genres(items).count() == 5
    assert rows(I.explode_genres(items).filter("item_id = 1")) == [(1, "Adventure"), (1, "Animation"), (1, "Comedy")]
    assert I.explode_genres(items).count() == 10


def test_genre_avg_rating(ratings, items):
    got = {r.genre: (round(r.avg_rating, 6), r.n_ratings) for r in A.genre_avg_rating(ratings, items).collect()}
    assert got == {
        "Adventure": (3.416667, 6),
        "Animation": (3.666667, 3),
        "Comedy": (3.666667, 3),
        "Crime": (3.571429, 7),
        "Documentary": (3.0, 1),
        "Drama": (4.166667, 3),
    }


def test_shuffle_joins_give_the_same_answers(ratings, items, no_broadcast):
    """Results do not depend on which side Spark broadcasts."""
    calls = (A.genre_avg_rating, A.genre_user_stats, lambda r, i: I.attach_titles(A.ratings_per_item(r), i))
    with no_broadcast():
        shuffled = [rows(f(ratings, items)) for f in calls]
    assert shuffled == [rows(f(ratings, items)) for f in calls]


def test_rows_without_a_rating_count_nowhere_in_averages(spark, ratings, items):
    extra = spark.createDataFrame([(77, 2, None, 5), (77, 4, None, 6)], ratings.schema)
    more = ratings.unionByName(extra)
    want = {r.genre: tuple(r) for r in A.genre_avg_rating(ratings, items).collect()}
    got = {r.genre: tuple(r) for r in A.genre_avg_rating(more, items).collect()}
    assert all(got[g] == want[g] for g in want)
    by_user = {r.user_id: r.avg_rating for r in A.user_rating_totals(more).collect()}
    assert by_user[77] is None


def test_dataset_counts_plan_expands_nothing(ratings):
    from prefkit.plans.inspect import plan_text

    out = A.dataset_counts(ratings)
    assert "Expand" not in plan_text(out)
    assert tuple(out.first()) == (11, 4, ratings.select("item_id").distinct().count())


def test_user_rating_totals(ratings):
    got = {r.user_id: (r.rating_sum, r.n_ratings, round(r.avg_rating, 6)) for r in A.user_rating_totals(ratings).collect()}
    assert got == {1: (12.0, 3, 4.0), 2: (10.0, 3, 3.333333), 3: (8.0, 3, 2.666667), 10: (7.0, 2, 3.5)}


def test_ratings_per_item_and_counts(ratings):
    assert rows(A.ratings_per_item(ratings)) == [(1, 3), (2, 1), (3, 3), (5, 1), (6, 3)]
    c = A.dataset_counts(ratings).first()
    assert (c.n_ratings, c.n_users, c.n_items) == (11, 4, 5)
    assert rows(A.distinct_users(ratings)) == [(1,), (2,), (3,), (10,)]


def test_genre_user_stats(ratings, items):
    s = A.genre_user_stats(ratings, items).filter("genre = 'Crime'")
    got = {r.user_id: (r.n_ratings, r.rating_sum) for r in s.collect()}
    assert got == {1: (2, 8.0), 2: (2, 8.0), 3: (1, 2.0), 10: (2, 7.0)}


def test_ratings_by_genre_inner(ratings, items):
    j = A.ratings_by_genre(ratings, items)
    # item 5 has no genre: its rating drops out; item 1 has three genres
    assert j.filter("item_id = 5").count() == 0
    assert j.filter("item_id = 1").count() == 9
    assert j.count() == 23


def test_attach_titles_missing_is_null(spark, items):
    df = spark.createDataFrame([(1,), (99,)], "item_id bigint")
    got = dict(rows(I.attach_titles(df, items), "item_id", "title"))
    assert got == {1: "Paper Kite (1995)", 99: None}


@pytest.mark.parametrize("order", [0, 1])
def test_genre_avg_independent_of_order_and_partitioning(ratings, items, order):
    shuffled = ratings.orderBy(F.rand(order)).repartition(3 + order)
    assert rows(A.genre_avg_rating(shuffled, items)) == rows(A.genre_avg_rating(ratings, items))
