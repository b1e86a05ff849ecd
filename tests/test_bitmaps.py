"""Distinct counts from bitmaps against counting distinct ids."""

import random

from pyspark.sql import functions as F

from panelwright.operators import bitmaps
from plan_text import executed

SCHEMA = "g STRING, day INT, id LONG"


def data(seed=3, n=900):
    rng = random.Random(seed)
    ids = [0, 1, 32766, 32767, 32768, 32769, 65536, 10**6, 10**12, -1, -32768, -32769]
    return [
        (rng.choice(["x", "y", None]), rng.randrange(12), rng.choice(ids + [None] + list(range(20, 60)))) for _ in range(n)
    ]


def counts(rows, key):
    found = {}
    for r in rows:
        found.setdefault(key(r), set()).add(r[2])
    return {k: len(v - {None}) for k, v in found.items()}


def test_counts_of_days_and_of_all_days(spark):
    rows = data() + [("only nulls", 3, None)]
    daily = bitmaps.id_bitmaps(spark.createDataFrame(rows, SCHEMA), ["g", "day"], F.col("id"))
    by_day = {(r["g"], r["day"]): r["n_distinct"] for r in bitmaps.distinct_counts(daily, ["g", "day"]).collect()}
    assert by_day == counts(rows, lambda r: r[:2])
    assert {r["g"]: r["n_distinct"] for r in bitmaps.distinct_counts(daily, ["g"]).collect()} == counts(rows, lambda r: r[0])
    assert daily.agg(F.sum("n_rows")).first()[0] == len(rows)


def test_union_is_associative_and_repeats_change_nothing(spark):
    rows = data(5)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [bitmaps.id_bitmaps(df.where(F.col("day") % 3 == k), ["g", "day"], F.col("id")) for k in range(3)]
    whole = bitmaps.id_bitmaps(df, ["g", "day"], F.col("id"))
    one = bitmaps.distinct_counts(parts[0].union(parts[1]).union(parts[2]), ["g"])
    two = bitmaps.distinct_counts(bitmaps.united(parts[2].union(parts[0]), ["g"]).union(bitmaps.united(parts[1], ["g"])), ["g"])
    again = bitmaps.distinct_counts(whole.union(whole), ["g"])
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect())) == sorted(map(repr, again.collect()))


def test_trailing_windows(spark):
    rows = data(7, 200)
    daily = bitmaps.id_bitmaps(spark.createDataFrame(rows, SCHEMA), ["g", "day"], F.col("id"))
    got = {(r["g"], r["day"]): r["n"] for r in bitmaps.trailing_counts(daily, ["g"], "day", 4, "n").collect()}
    expected = {
        (g, d): len({i for h, e, i in rows if h == g and d - 3 <= e <= d and i is not None}) for g, d in {r[:2] for r in rows}
    }
    assert got == expected


def test_memory_is_one_bitmap_per_bucket(spark):
    df = spark.range(100_000).select(F.lit("x").alias("g"), F.lit(1).alias("day"), "id")
    daily = bitmaps.id_bitmaps(df.union(df), ["g", "day"], F.col("id"))
    row = bitmaps.memory_bound(daily, ["g"]).first()
    assert (row["bitmaps"], row["bytes"]) == (5, 5 * 4096) and daily.agg(F.max(F.length("bits"))).first()[0] == 4096
    assert executed(daily).count("partial_bitmap_construct_agg") == 1


def test_texts_are_numbered_without_gaps(spark):
    words = ["b", "a", "c", "a", None, "ä", "", "b"]
    df = spark.createDataFrame([(w, 1) for w in words], "w STRING, day INT")
    numbers = bitmaps.numbered(df, "w")
    assert [r["w"] for r in sorted(numbers.collect(), key=lambda r: r["number"])] == ["", "a", "b", "c", "ä"]
    assert sorted(r["number"] for r in numbers.collect()) == list(range(5))
    known = bitmaps.with_numbers(df, numbers, "w")
    assert known.count() == 8 and known.where("w IS NULL").first()["number"] is None
    daily = bitmaps.id_bitmaps(known, ["day"], F.col("number"))
    assert bitmaps.distinct_counts(daily, []).first()[0] == 5
