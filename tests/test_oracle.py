"""Every registered query with an oracle against DuckDB on the smallest driver scale."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from prefkit.plans import oracle, queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert info["ok"], info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "avg_rating", "n_ratings"]
    got = {r.genre: (r.avg_rating, r.n_ratings) for r in df.collect()}
    assert got["ECONOMY"] == (2.803536346, 1018)


def test_every_query_has_an_oracle():
    assert set(registered.QUERIES) == set(oracle.ORACLE_SQL)
    assert set(registered.QUERIES) <= set(E.queries()) and set(oracle.ORACLE_SQL) <= set(E.oracle_sql())


SENSITIVE = ["scan_ratings", "split_assignment", "dedupe_ratings", "item_cf_recommend", "preferences_from_responses",
             "split_genres", "rating_error_metrics", "item_column_summary"]


def test_results_do_not_depend_on_session_zone_or_ansi(spark, con):
    """Timestamps, casts and divisions give the same answers in a non-UTC zone with ANSI off."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for name in SENSITIVE:
            info = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
            assert info["ok"], info
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
