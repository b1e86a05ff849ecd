"""Column functions on small inline frames."""

import pytest
from pyspark.sql import functions as F

from panelwright.functions import paths
from panelwright.functions.keys import config_fingerprint, row_fingerprint, surrogate_key
from panelwright.functions.names import light_name, strict_name
from panelwright.functions.numbers import per_million, percent_of, positive_long, ratio, to_year


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_name_keys(spark):
    rows = [("Côte d'Ivoire",), (" bosnia & herz ",), ("\tx",), (None,)]
    got = values(spark, rows, "n string", strict_name(F.col("n")), light_name(F.col("n")))
    assert got == [
        ("CTE DIVOIRE", "CÔTE D'IVOIRE"),
        ("BOSNIA  HERZ", "BOSNIA & HERZ"),
        ("\tX", "\tX"),
        (None, None),
    ]


def test_positive_long_keeps_whole_numbers_above_zero(spark):
    rows = [("7",), (" 7 ",), ("0",), ("-1",), ("",), ("x",), ("1.5",), ("1e3",), ("1,234",), (None,)]
    got = [r[0] for r in values(spark, rows, "t string", positive_long(F.col("t")))]
    assert got == [7, 7] + [None] * 8


def test_to_year_gives_null_for_quarters(spark):
    got = [r[0] for r in values(spark, [("2000",), ("2000Q1",), (None,)], "t string", to_year(F.col("t")))]
    assert got == [2000, None, None]


@pytest.mark.parametrize(
    "n, d, expected", [(3.0, 2.0, (1.5, 1_500_000.0, 150.0)), (3.0, 0.0, None), (3.0, -2.0, None), (3.0, None, None), (None, 2.0, None)])
def test_guarded_division(spark, n, d, expected):
    a, b = F.col("a"), F.col("b")
    got = values(spark, [(n, d)], "a double, b double", ratio(a, b), per_million(a, b), percent_of(a, b))
    assert got == [expected or (None, None, None)]


@pytest.mark.parametrize("url, expected", [
    ("https://acct.blob.core.windows.net/Bronze/a/B.json", "abfss://bronze@acct.dfs.core.windows.net/a/B.json"),
    ("https://acct.blob.core.windows.net/Bronze", "abfss://bronze@acct.dfs.core.windows.net/"),
    ("https://acct.blob.core.windows.net/", "abfss://@acct.dfs.core.windows.net/"),
    ("https://acct.blob.core.windows.net//Box//x", "abfss://box@acct.dfs.core.windows.net//x"),
    ("https://acct.host/c/p?sig=1#f", "abfss://c@acct.dfs.core.windows.net/p"),
    ("not a location", None),
    (None, None),
])
def test_lake_uri(spark, url, expected):
    assert values(spark, [(url,)], "u string", paths.lake_uri(F.col("u"))) == [(expected,)]


def test_path_builders(spark):
    rel, account = F.col("rel"), F.lit("Acct")
    got = values(
        spark, [("/a/b.csv",), ("a/b.csv",)], "rel string",
        paths.absolute_url(rel, account),
        paths.blob_url(F.lit("Box"), rel, account),
        paths.table_uri(F.lit("silver"), F.lit("YEAR"), account),
        paths.prefixed(F.array(rel, F.lit("/c/")), F.lit("base")),
    )
    for absolute, blob, table, prefixed in got:
        assert absolute == "https://Acct.blob.core.windows.net/a/b.csv"
        assert blob == "https://Acct.blob.core.windows.net/box/a/b.csv"
        assert table == "abfss://silver@acct.dfs.core.windows.net/YEAR"
        assert prefixed == ["base/a/b.csv", "base/c"]
    assert values(spark, [("x/y",)], "rel string", paths.account_uri(rel, F.lit("a"))) == [
        ("abfss://a@a.dfs.core.windows.net/x/y",)]


def test_landing_path(spark):
    got = values(
        spark, [("NOBELPRIZE", "2025-09-20")], "s string, d string",
        paths.landing_path(F.col("s"), F.col("d").cast("date"), F.lit("laureates"), F.lit("run"), F.lit("d2b028b2")))
    assert got == [("nobelprize/2025/09/20/laureates_run_d2b028b2.json",)]


def test_config_fingerprint_known_value():
    payload = {
        "domain_source": "NOBELPRIZE", "dataset_name": "laureates", "domain_source_type": "api",
        "request_payload": {"limit": 100, "offset": 0},
    }
    assert config_fingerprint(payload) == "d2b028b2"


def test_row_fingerprint_ignores_column_order_but_not_nulls(spark):
    rows = [(1, "a"), (1, None)]
    got = values(spark, rows, "x int, y string", row_fingerprint("x", "y"), row_fingerprint("y", "x"), row_fingerprint("x", "y", length=8))
    assert all(a == b and len(a) == 64 and a.startswith(c) for a, b, c in got)
    assert got[0][0] != got[1][0]


def test_surrogate_key_is_stable(spark):
    df = spark.range(100).select(surrogate_key("id").alias("k"))
    again = spark.range(100).repartition(7).select(surrogate_key("id").alias("k"))
    assert {r.k for r in df.collect()} == {r.k for r in again.collect()}
