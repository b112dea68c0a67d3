"""Plan-shape checks over every registered query (sf0.001, plans only)."""

import pytest

import __spark_entry__ as entry
from salescast.plans import catalog
from tests.conftest import SF_SMALL

# model fits execute while the plan is built; their plans are checked elsewhere
SKIP = {"ml4_gbt_holdout", "ml6_random_forest_holdout", "ml7_elastic_net_holdout",
        "ml7b_decision_tree_holdout", "ml5_second_booster_holdout", "ml11_feature_importance", "ml16_model_search",
        "fc3_model_forecast", "st1_stream_scoring", "ml16_rolling_origin_search",
        "ml14_model_accuracy_by_grain", "io8_saved_model_scores", "ml4_validation_curve", "ml5_validation_curve",
        "st1_request_stream"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SKIP))
def test_no_cartesian_nested_loop_or_python(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"


def test_aggregations_are_partial_before_shuffle(spark):
    df = entry.queries()["ag4_revenue_by_category"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_session_defaults_enable_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_shuffle_sizing_bounds():
    from salescast.session import sizing
    assert sizing(20_000_000, 8)["spark.sql.shuffle.partitions"] == "16"          # small: 2 waves
    assert sizing(10 * 2**30, 8)["spark.sql.shuffle.partitions"] == "40"          # 10 GiB / 256 MiB
    assert sizing(100 * 10**12, 8000)["spark.sql.shuffle.partitions"] == "372530"  # 256 MiB each at any size


def test_session_keeps_a_given_partition_count(spark):
    from salescast.session import get_session, size_shuffles
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(get_session(), [SF_SMALL])  # the session was started with a count of its own
    assert spark.conf.get("spark.sql.shuffle.partitions") == before == "8"


def test_driver_only_folder_is_refused_off_local():
    from types import SimpleNamespace

    from salescast.session import _local_fallback
    with pytest.raises(RuntimeError):
        _local_fallback(SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077")))
