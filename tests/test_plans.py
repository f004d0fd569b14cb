"""Physical-plan guards: the shapes that keep the queries scalable."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_top_n_uses_window_group_limit(spark):
    p = plan(E.queries()["top_n_per_hour"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", ["road_grid_points", "safe_points", "accident_density", "road_grid_pairs"])
def test_spatial_joins_are_equi_joins(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p or "ShuffledHashJoin" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = E.queries()["threshold_filter"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p or "ReadSchema: struct<event_id:bigint,ts:" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_no_python_udf_in_feature_projection(spark):
    p = plan(E.queries()["features_acc"](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_fanout_does_not_shuffle_child_rows(spark):
    p = plan(E.queries()["bronze_accidents"](spark, SF_SMALL))
    # the child side reaches the join as an aggregate (one row per key)
    assert "HashAggregate" in p and "count(1)" in p


def test_distribution_reads_its_input_once(spark):
    """What is returned reads the stored value counts; the input is no part of its plan."""
    from georisk.operators import profile
    from georisk.sources import bindings as B
    p = plan(profile.distribution_stats(B.preds(spark, SF_SMALL), "probability"))
    assert "events.parquet" not in p and "parquet" in p
    rows = [(v,) for v in (1.0, 2.0, 2.0, 4.0, 9.0)] + [(None,)]
    got = profile.distribution_stats(spark.createDataFrame(rows, "x double"), "x").first()
    assert tuple(got) == (1.0, 9.0, 3.6, 2.0, 7.0, 1)
    assert tuple(profile.distribution_stats(spark.createDataFrame([], "x double"), "x").first()) == (None,) * 5 + (0,)


def test_cell_join_is_plain_without_hot_cells(spark):
    from pyspark.sql import functions as F

    from georisk.operators import spatial
    a = spark.range(2000).select(F.col("id").alias("i"), (F.col("id") % 50).alias("_cx"), F.lit(0).alias("_cy"))
    b = a.select(F.col("i").alias("j"), "_cx", "_cy")
    cold, hot = spatial.cell_join(a, b), spatial.cell_join(a, b, hot_pairs=500)
    assert "_salt" not in plan(cold) and "_salt" in plan(hot)
    assert cold.count() == hot.count() == 80_000
    assert hot.select("i", "j").distinct().count() == 80_000
