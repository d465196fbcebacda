"""Physical-plan checks: pruning, pushdown, where Python runs, and that no
headline plan funnels a whole table through one partition or a cross join."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wattlake.plans.registry import queries
from wattlake.sources import fixtures as fx
from wattlake.sources import io
from wattlake.session import scratch_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_meter_scan_prunes_columns(spark):
    p = plan(fx.meter_readings(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_partitioned_sink_prunes_partitions(spark):
    path = io.write_table(fx.meter_readings(spark, SF_SMALL), scratch_dir(spark, "t-part"), by=["meter"])
    p = plan(io.read_table(spark, path).where(F.col("meter") == 1))
    assert "PartitionFilters: [isnotnull(meter" in p and "(meter" in p


def test_linear_fill_plan_is_jvm_only(spark):
    p = plan(queries()["weather_pipeline"](spark, SF_SMALL))
    assert "Python" not in p and "ArrowEval" not in p and "FlatMapGroupsInPandas" not in p


def test_cubic_fill_has_one_pandas_stage(spark):
    p = plan(queries()["weather_pipeline_cubic"](spark, SF_SMALL))
    assert p.count("FlatMapGroupsInPandas") == 1


@pytest.mark.parametrize("key", ["join_building", "feature_pipeline", "presence_map", "holiday_flag",
                                 "missing_readings_report", "normalize_by_area", "positional_slice",
                                 "rare_label_encode", "copy_site_column", "interpolate_linear"])
def test_no_cross_join_or_single_partition_exchange(spark, key):
    p = plan(queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    # no window over the whole input (a Window with an empty partition spec
    # runs in one task)
    for line in p.splitlines():
        if line.strip().lstrip("+-: ").startswith("Window ["):
            assert "], [], [" not in line, line


def test_weather_broadcast_only_with_a_proven_bound(spark):
    from wattlake.operators import timeseries as ts
    from wattlake.operators.joins import merge_data
    from wattlake.plans.q_pipelines import weather_bound, weather_done
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        m, b, w = fx.meter_readings(spark, SF_SMALL), fx.buildings(spark, SF_SMALL), weather_done(spark, SF_SMALL)
        bound = weather_bound(spark, SF_SMALL)
        assert bound == ts.site_hour_grid(ts.to_local_time(fx.weather(spark, SF_SMALL)), fx.INTERVAL_START,
                                          fx.INTERVAL_END).count()
        with_bound = plan(merge_data(m, w, b, weather_rows=bound))
        without = plan(merge_data(m, w, b))
        assert "BroadcastHashJoin" in with_bound
        assert "SortMergeJoin" in without
        assert "SortMergeJoin" in plan(merge_data(m, w, b, weather_rows=10 ** 9))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
