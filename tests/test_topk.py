from pyspark.sql import functions as F

from frames import rows
from prefkit.operators import topk as W


def test_genre_top_items(ratings, items):
    got = rows(W.genre_top_items(ratings, items, k=5), "genre", "rank", "item_id", "n_ratings")
    assert got == [
        ("Adventure", 1, 1, 3),
        ("Adventure", 2, 6, 3),
        ("Animation", 1, 1, 3),
        ("Comedy", 1, 1, 3),
        ("Crime", 1, 3, 3),
        ("Crime", 2, 6, 3),
        ("Crime", 3, 2, 1),
        ("Documentary", 1, 2, 1),
        ("Drama", 1, 3, 3),
    ]


def test_genre_top_items_k_limits(ratings, items):
    got = rows(W.genre_top_items(ratings, items, k=1), "genre", "item_id")
    assert ("Crime", 3) in got and len(got) == 6


def test_genre_top_items_packed(ratings, items):
    got = dict(rows(W.genre_top_items_packed(ratings, items, k=5)))
    assert got["Crime"] == "Ember (1995):3, Salt, the Wind, and Stone, The (1966):3, Harbour Papers, The (2012):1"
    assert got["Drama"] == "Ember (1995):3"


def _users(df, genre):
    d = df.filter(F.col("genre") == genre).orderBy("rank")
    return [
        (r.user_id, r.n_ratings, round(r.genre_avg, 6), round(r.overall_avg, 6), r.overall_n) for r in d.collect()
    ]


def test_genre_top_users_text_tie_order(ratings, items):
    top = W.genre_top_users(ratings, items, k=5)
    assert _users(top, "Crime") == [
        (1, 2, 4.0, 4.0, 3),
        (10, 2, 3.5, 3.5, 2),  # "10" sorts before "2" as text
        (2, 2, 4.0, 3.333333, 3),
        (3, 1, 2.0, 2.666667, 3),
    ]
    assert _users(top, "Adventure") == [
        (2, 2, 2.75, 3.333333, 3),
        (3, 2, 3.5, 2.666667, 3),
        (1, 1, 4.0, 4.0, 3),
        (10, 1, 4.0, 3.5, 2),
    ]


def test_genre_top_users_shuffle_path(ratings, items, no_broadcast):
    with no_broadcast():
        shuffled = rows(W.genre_top_users(ratings, items, k=2))
    assert shuffled == rows(W.genre_top_users(ratings, items, k=2))


def test_ranks_gap_free(ratings, items):
    top = W.genre_top_items(ratings, items, k=2)
    for g in top.groupBy("genre").agg(F.sort_array(F.collect_list("rank")).alias("r")).collect():
        assert g.r == list(range(1, len(g.r) + 1))
