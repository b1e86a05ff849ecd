"""Plan shapes that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import conform, index, ordinals, panel, quality, reshape, sinks
from panelwright.plans import given_tables as given
from panelwright.plans import gold
from panelwright.session import stored
from plan_text import exchanges, executed

SF = "/root/testdata/sf0.001"
KEYS = ["entity", "year"]


@pytest.fixture
def no_broadcast(spark):
    """What Catalyst plans once no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def grouped_inputs(spark, tmp_path, n):
    frames = []
    for i in range(n):
        path = str(tmp_path / f"in{i}")
        spark.range(50).select(F.col("id").alias("entity"), F.lit(2000).alias("year"), F.lit(float(i)).alias("m")).write.parquet(path)
        frames.append((spark.read.parquet(path).groupBy(*KEYS).agg(F.sum("m").alias(f"m{i}")), [f"m{i}"]))
    return frames


def test_panel_exchanges_every_row_once_and_sorts_none(spark, tmp_path, no_broadcast):
    inputs = grouped_inputs(spark, tmp_path, 7)
    grid = spark.read.parquet(str(tmp_path / "in0")).select(*KEYS)
    by_union = panel.panel_by_union(grid, inputs, KEYS)
    plan = executed(by_union)
    assert exchanges(by_union) == 8 and "Exchange" not in plan[:plan.index("Union")]
    assert "Sort" not in plan and "Join" not in plan
    assert executed(panel.panel_by_joins(grid, inputs, KEYS)).count("SortMergeJoin") == 7
    assert by_union.count() == 50


def test_scaffold_does_not_shuffle_entities_or_join(spark):
    entities = given.table(spark, SF, "customer").select("c_custkey")
    plan = executed(reshape.scaffold(entities, "c_custkey", reshape.year_range(spark, 2000, 2003)))
    assert "hashpartitioning" not in plan and "Join" not in plan and "Generate explode" in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = executed(given.nation_prizes(spark, SF))
    assert "GreaterThan(o_totalprice,497000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_nested_columns_are_pruned(spark, tmp_path):
    from panelwright.operators.flatten import flatten_indicator
    from panelwright.sources.schemas import INDICATOR
    path = str(tmp_path / "i")
    spark.createDataFrame([], INDICATOR).write.parquet(path)
    plan = executed(flatten_indicator(spark.read.schema(INDICATOR).parquet(path), "population"))
    assert "ReadSchema: struct<country:struct<value:string>,countryiso3code:string,date:string,value:double>" in plan


def test_orders_are_aggregated_before_they_are_joined(spark, no_broadcast):
    plan = executed(given.nation_order_measures(spark, SF))
    join = plan.index("Join [o_custkey")
    assert "partial_sum" in plan[join:], "a hot customer must reach the join as one row per year"


def test_flags_of_several_sources_share_one_aggregation(spark, no_broadcast):
    orders = given.table(spark, SF, "orders")
    flags = conform.flag_presence(
        given.table(spark, SF, "customer"), "c_custkey",
        {f"f{i}": (orders.filter(F.col("o_totalprice") > i), "o_custkey") for i in range(3)})
    assert exchanges(flags) == 2  # the keys of all sources, and the entities


def test_distinct_names_share_their_exchange_with_the_anti_join(spark, no_broadcast):
    required = given.table(spark, SF, "orders").select(F.col("o_orderkey").alias("model"))
    done = given.table(spark, SF, "lineitem").select(F.col("l_orderkey").alias("model"))
    assert exchanges(quality.missing_inputs(required, done, "model")) == 2


def test_top_k_limits_groups_before_the_exchange(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(100).select((F.col("id") % 3).alias("g"), F.rand(1).alias("score")).write.parquet(path)
    plan = executed(index.top_k_within(spark.read.parquet(path), "g", "score", 2))
    assert plan.count("WindowGroupLimit") == 2


def test_ranking_needs_no_window_and_reads_the_rows_twice(spark, tmp_path, monkeypatch):
    path, made = str(tmp_path / "s"), []
    spark.range(100).select((F.col("id") % 3).alias("g"), F.rand(1).alias("score")).write.parquet(path)
    for module in (index, ordinals):
        monkeypatch.setattr(module, "stored", lambda df, name: made.append(executed(df)) or stored(df, name))
    made.append(executed(index.rank_within(spark.read.parquet(path), "g", "score")))
    assert not any("Window" in plan or "SinglePartition" in plan for plan in made)
    assert sum(plan.count(f"{tmp_path}/s]") for plan in made) == 2


def test_ranking_spreads_a_group_that_has_nearly_all_rows(spark, tmp_path, monkeypatch):
    path, tables = str(tmp_path / "s"), []
    hot = F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(7)
    spark.range(20_000).select(hot.alias("g"), F.rand(1).alias("score")).write.parquet(path)
    monkeypatch.setattr(ordinals, "stored", lambda df, name: tables.append(stored(df, name)) or tables[-1])
    ranked = index.rank_within(spark.read.parquet(path), "g", "score", slices=16)
    assert ranked.where("g = 7").agg(F.max("rank")).first()[0] == 19_600
    sizes = [r["count"] for r in tables[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_merge_reads_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", (F.col("id") % 5).cast("int").alias("year"))
    sinks.write_table(df, path, partition_cols=["year"])
    current = spark.read.parquet(path).filter(F.col("year").isin([1, 2]))
    assert "PartitionFilters: [year" in executed(current)


def test_filters_on_the_score_do_not_copy_the_fit(spark, tmp_path):
    """One subquery for the fit, however the result is used."""
    path = str(tmp_path / "p")
    measures = ", ".join(f"cast(id as double) as {m}" for m in gold.contract.MEASURES)
    spark.range(20).selectExpr("id as entity", "2000 as year", *measures.split(", ")).write.parquet(path)
    scored = gold.composite_index(spark.read.parquet(path)).filter(f"{gold.contract.SCORE} > 0.5")
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery#") == 1
    assert scored.count() > 0
