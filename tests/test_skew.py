"""One customer, supplier and order with a third of all rows, no broadcasting, hot partitions split."""

import shutil
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from compare import differences, duck

SF = Path("/root/testdata/sf0.001")

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}

SKEWED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM orders",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN l_partkey % 3 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM lineitem",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM events",
}

AFFECTED = [
    "composite_index", "customer_composite_index", "panel_left_joins", "customer_panel_left_joins", "rank_by_year",
    "top_k_by_year", "fact_innovation", "entity_presence_flags", "country_master", "conform_inner", "conform_by_name",
    "agg_then_join", "distinct_count_by_group", "resident_split", "flatten_patents", "unpivot_years", "duplicate_keys",
    "missing_inputs", "audit_counts", "latest_per_key", "incremental_upsert", "keyed_merge", "idempotent_landing",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = duck(str(SF))
    for file in SF.glob("*.parquet"):
        if file.stem in SKEWED:
            source.execute(f"COPY ({SKEWED[file.stem]}) TO '{folder / file.name}' (FORMAT parquet)")
        else:
            shutil.copy(file, folder / file.name)
    return str(folder)


@pytest.fixture(scope="module")
def split_hot_partitions(spark):
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k in SETTINGS:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", AFFECTED)
def test_hot_keys_change_no_result(spark, skewed, split_hot_partitions, name):
    assert differences(queries()[name](spark, skewed), duck(skewed), oracle_sql()[name]) == []


def test_a_hot_order_is_split_over_tasks(spark, skewed, split_hot_partitions):
    from panelwright.plans.given_tables import shipped_by_supplier
    df = shipped_by_supplier(spark, skewed)
    df.collect()
    assert "skewed" in df._jdf.queryExecution().executedPlan().toString()


def test_the_tables_are_skewed(skewed):
    share = duckdb.sql(f"SELECT avg((l_orderkey = 7)::INT) FROM '{skewed}/lineitem.parquet'").fetchall()[0][0]
    assert share > 0.3
