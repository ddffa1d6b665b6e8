"""Physical-plan checks: broadcast only where bounded, partial aggregation, WindowGroupLimit,
no Python UDF anywhere, filters and column pruning reaching the parquet scan."""

import pytest

from prefkit.operators import topk as W
from prefkit.plans.inspect import plan_text
from prefkit.plans import queries as Q
from prefkit.sources import bindings as B

SF = "/root/testdata/sf0.001"
# Queries that write files and read them back: their plan is that of a text scan.
WRITES = ("sink_roundtrip", "scan_ratings", "scan_items", "scan_personal_ratings")


@pytest.mark.parametrize("name", sorted(k for k in Q.QUERIES if not k.startswith("als_") and k not in WRITES))
def test_no_python_udf(spark, name):
    text = plan_text(Q.QUERIES[name](spark, SF))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    # no cross joins anywhere
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_titles_broadcast(spark):
    assert "BroadcastHashJoin" in plan_text(Q.attach_titles(spark, SF))


def test_window_group_limit(spark):
    for q in (Q.genre_top_items, Q.item_neighbors_topk):
        assert "WindowGroupLimit" in plan_text(q(spark, SF)), q.__name__
    ranked = W.genre_ranked_users(B.community_ratings(spark, SF), B.bind_items(spark, SF))
    assert "WindowGroupLimit" in plan_text(ranked)


def test_partial_aggregation_before_shuffle(spark):
    text = plan_text(Q.genre_avg_rating(spark, SF))
    assert "partial_sum" in text and "partial_count" in text


def test_filter_and_pruning_reach_scan(spark):
    text = plan_text(B.personal_ratings(spark, SF))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,0)" in text
    # lineitem scan reads only the five bound columns
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_salted_join_in_plan(spark, ratings):
    from prefkit.operators import similarity as SIM

    text = plan_text(SIM.centered_ratings(ratings, rows_per_task=1))
    assert "xxhash64" in text and "generate" in text.lower()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(k for k in Q.QUERIES if not k.startswith("als_")))
def test_nothing_stays_cached_and_bindings_force_no_exchange(spark, name):
    spark.catalog.clearCache()
    out = Q.QUERIES[name](spark, SF)
    assert "REPARTITION" not in plan_text(out)
    out.write.format("noop").mode("overwrite").save()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_column_summary_runs_nothing_before_it_is_asked(spark, ratings):
    from prefkit.operators import matrix as X

    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("lazy", "lazy")
    X.item_column_summary(ratings)
    before = tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(before) == []


def final_plan(df):
    """The plan as adaptive execution ran it, without the plan that it began with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(df, column="l_orderkey"):
    """How often the line items (which the ratings are bound from) are read when the query runs."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count(f"Relation [{column}"), final_plan(df)


@pytest.mark.parametrize("name, ratings, personal", [("popular_items", 1, 0), ("dataset_counts", 2, 0)])
def test_ratings_are_read_as_often_as_needed(spark, name, ratings, personal):
    found, plan = scans(Q.QUERIES[name](spark, SF))
    assert found == ratings + personal and "Expand" not in plan


def test_column_summary_reads_the_ratings_once(spark):
    """The subquery that counts the users takes the exchange of the deduplication."""
    plan = final_plan(Q.item_column_summary(spark, SF))
    assert "ReusedExchange" in plan and plan.count("partial_max(struct(") <= 1


def test_popular_items_sorts_nothing_but_its_result(spark):
    assert "SortAggregate" not in final_plan(Q.popular_items(spark, SF))


def test_similarity_reads_the_ratings_once(spark, monkeypatch):
    """One pass collapses the ratings; the other parts read what it wrote."""
    from prefkit.operators import similarity as SIM

    passes = []
    collapse = SIM.collapsed_ratings
    monkeypatch.setattr(SIM, "collapsed_ratings", lambda r: passes.append(1) or collapse(r))
    for name in ("co_rated_pairs", "item_similarity", "item_cf_recommend"):
        passes.clear()
        text = plan_text(Q.QUERIES[name](spark, SF))
        # Line items are left in the plan for the target user's rows alone.
        assert passes == [1] and "prefkit-rated-pairs" in text
        assert text.count("PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,0)") == text.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>")


def test_totals_are_summed_for_ranked_users_only(spark):
    """The ratings are filtered by the ranked users before the totals are summed."""
    plan = final_plan(Q.genre_top_users(spark, SF))
    assert "LeftSemi" in plan and plan.index("partial_avg") < plan.index("LeftSemi")
