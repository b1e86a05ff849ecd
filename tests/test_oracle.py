"""Every query against its SQL on the smallest tables, and what no plan may contain."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from compare import differences, duck
from panelwright.plans import given_tables
from panelwright.plans.catalog import ORACLE, QUERIES
from plan_text import executed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    assert differences(df, con, oracle_sql()[name]) == []
    plan = executed(df)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert forbidden not in plan


def test_entry(spark):
    years = given_tables.years(spark, SF).count()
    assert years >= 7 and entry(spark).count() == 25 * years


YEARLY = (
    "unpivot_years", "flatten_patents", "panel_left_joins", "panel_union_long", "customer_panel_left_joins",
    "composite_index", "top_k_by_year", "fact_innovation",
)


@pytest.fixture(scope="module")
def later(spark, tmp_path_factory):
    """The smallest tables with all dates six years later."""
    folder = tmp_path_factory.mktemp("later")
    for name in ("nation", "region", "customer", "supplier", "part", "orders", "lineitem"):
        df = given_tables.table(spark, SF, name)
        dates = {c: df[c] + F.expr("INTERVAL 6 YEARS") for c, kind in df.dtypes if kind == "timestamp_ntz"}
        pq.write_table(df.withColumns(dates).toArrow(), folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [q for q in YEARLY if q in QUERIES])
def test_no_year_is_cut(spark, later, name):
    assert differences(QUERIES[name](spark, later), duck(later), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(given_tables.SCHEMAS))
def test_declared_schemas_are_those_of_the_files(spark, name):
    declared = given_tables.table(spark, SF, name).dtypes
    assert declared == spark.read.parquet(f"{SF}/{name}.parquet").dtypes
