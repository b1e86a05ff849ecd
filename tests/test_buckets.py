"""Bucketed tables: what is stored is not exchanged again."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import buckets, sinks
from panelwright.operators.panel import panel_by_joins
from panelwright.plans import upkeep
from plan_text import executed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_panel_of_stored_inputs_needs_no_exchange(spark, no_broadcast):
    grid, inputs = upkeep.bucketed_inputs(spark, SF)
    plan = executed(panel_by_joins(grid, inputs, upkeep.KEYS))
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == len(inputs)


def test_a_merge_exchanges_the_batch_only(spark, no_broadcast, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    current = buckets.write_bucketed(df, str(tmp_path / "t"), ["id"])
    batch = spark.range(990, 1010).select("id", F.lit(-1).cast("long").alias("v"))
    merged = buckets.bucketed_merge(current, batch, ["id"])
    assert executed(merged).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, sinks.keyed_merge(df, batch, ["id"]).collect()))
    files = list((tmp_path / "t").glob("*.parquet"))
    assert len(files) <= buckets.default_buckets(spark)


def test_the_table_can_be_declared_again(spark, no_broadcast, tmp_path):
    df = spark.range(100).select(F.col("id").alias("a key"), F.lit("x").alias("v"))
    first = buckets.write_bucketed(df, str(tmp_path / "t"), ["a key"], 8)
    again = buckets.declared(spark, str(tmp_path / "t"), first.schema, ["a key"], 8)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    assert "Exchange" not in executed(again.groupBy("a key").count())


def test_null_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k INT, v STRING")
    current = buckets.write_bucketed(df, str(tmp_path / "t"), ["k"])
    merged = buckets.bucketed_merge(current, spark.createDataFrame([(1, "c")], "k INT, v STRING"), ["k"])
    assert sorted(map(repr, map(tuple, merged.collect()))) == ["(1, 'c')", "(None, 'b')"]
    with pytest.raises(Exception, match="NULL in merge key k"):
        buckets.bucketed_merge(current, df, ["k"]).collect()
