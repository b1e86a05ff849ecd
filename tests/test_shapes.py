"""Records out of pages of unknown shape."""

from pyspark.sql import functions as F

from panelwright.sources import shapes

PAGES = [
    ("meta", '[{"page": 1}, [{"a": 1}, {"a": "2", "b": {"c": null}}]]'), ("data", '{"data": [{"x": 3}], "n": 1}'),
    ("list", '[{"a": 4}, {"x": "5"}]'), ("one", '{"a": 6.0}'), ("empty list", "[]"), ("empty data", '{"data": []}'),
    ("mixed", '[{"a": 7}, 8, null, "t", [{"a": 9}], {"a": "no number"}]'), ("html", "<html>"), ("null", None), ("", ""),
    ("value", "17"), ("json null", "null"), ("data is no list", '{"data": 5, "a": 10}'),
    ("deep", '{"a": 11, "more": {"data": [{"a": 12}]}}'),
]


def pages(spark):
    return spark.createDataFrame(PAGES, "name STRING, page STRING")


def test_records(spark):
    records = shapes.records_of_any_page(pages(spark), "page", keep=("name",))
    got = records.select("name", shapes.field("record", ["$.a", "$.x"], "bigint").alias("a")).collect()
    found = {}
    for r in got:
        found.setdefault(r["name"], []).append(r["a"])
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        "meta": [1, 2], "data": [3], "list": [4, 5], "one": [6], "mixed": [7, None], "data is no list": [10], "deep": [11],
    }
    assert shapes.records_of_any_page(pages(spark).where("false"), "page").count() == 0


def test_lists_are_looked_for_in_the_given_places(spark):
    records = shapes.records_of_any_page(pages(spark).where("name = 'deep'"), "page", ("$.more.data",))
    assert [r["a"] for r in records.select(shapes.field("record", ["$.a"], "int").alias("a")).collect()] == [12]


def test_unreadable_pages(spark):
    names = {r["name"] for r in shapes.unreadable_pages(pages(spark), "page").collect()}
    assert names == {"html", "null", "", "value", "json null"}


def test_shapes_are_merged_per_group(spark):
    records = shapes.records_of_any_page(pages(spark), "page", keep=("name",)).withColumn("g", F.col("name") == "meta")
    found = {r["g"]: r["shape"] for r in shapes.observed_shape(records, "record", ["g"]).collect()}
    assert found[True] == "OBJECT<a: VARIANT, b: OBJECT<c: VOID>>" and found[False].startswith("OBJECT<a: VARIANT, ")
