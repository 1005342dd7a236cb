"""Guards on the physical plans: the scale properties must not regress."""

import pytest

from recspark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["vector_similar_items", "content_similar_items",
                                  "stream_candidates", "stream_recs_batch",
                                  "leave_n_out_split", "items_with_tags", "genre_top_n",
                                  "factor_user_recs", "als_user_recs", "als_recs_for_users",
                                  "als_recs_for_items"])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["genre_top_n", "vector_similar_items", "recent_ratings",
                                  "stream_candidates", "leave_n_out_split"])
def test_top_k_is_partial_before_exchange(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rmse_scans_its_table_once(spark):
    assert _plan(spark, "rmse_item_mean_split").count("lineitem.parquet") == 1


def test_scans_are_pruned(spark):
    plan = _plan(spark, "item_popularity_by_month")
    assert "l_extendedprice" not in plan and "l_comment" not in plan
    assert "l_shipdate" in plan
