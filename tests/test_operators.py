"""Flattening, conforming, panel, index, ranking, checks and audit on golden cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.operators import audit, index, ordinals, quality
from panelwright.operators.conform import aggregate_then_conform, conform, flag_presence
from panelwright.operators.flatten import flatten_indicator, flatten_laureates, flatten_patents
from panelwright.operators.panel import panel_by_joins, panel_by_union
from panelwright.operators.reshape import (
    explode_rows,
    scaffold,
    unpivot_years,
    year_columns,
    year_range,
    year_range_of,
)
from panelwright.plans import gold
from panelwright.sources.schemas import INDICATOR, LAUREATE

ISO = contract.ISO
KEYS = ["entity", "year"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- flattening and reshaping


def indicators(spark):
    def record(iso, date, value):
        return (("i", "v"), ("c", "Côte d'Ivoire"), iso, date, value, "", "", 0)
    return spark.createDataFrame(
        [record("CIV", "2000", 1.0), record("", "2000", 2.0), record(None, "2000", 3.0), record("CIV", "2000Q1", None)],
        INDICATOR)


def test_indicator_drops_null_codes_only_and_casts_the_year(spark):
    got = flatten_indicator(indicators(spark), "population")
    assert got.columns == ["country_name", ISO, "year", "value", "country_name_normalized"]
    assert rows(got.select(f"`{ISO}`", "year", "value")) == [("", 2000, 2.0), ("CIV", 2000, 1.0), ("CIV", None, None)]
    assert got.first().country_name_normalized == "CTE DIVOIRE"


def test_indicator_value_name_and_pass_through(spark):
    raw = indicators(spark)
    assert "unemployment_rate" in flatten_indicator(raw, "unemployment").columns
    assert flatten_indicator(raw, "not listed").columns == raw.columns
    assert flatten_laureates(raw, "other").columns == raw.columns
    assert flatten_patents(raw, "other").columns == raw.columns


def test_laureates(spark):
    def person(id, born, now, years):
        place = None if born is None and now is None else {"country": {"en": born}, "countryNow": {"en": now}}
        prizes = None if years is None else [{"awardYear": y} for y in years]
        return {"id": id, "birth": {"place": place}, "nobelPrizes": prizes}
    df = spark.createDataFrame(
        [person("two", " Prussia", "Germany", ["1903", "1911"]), person("none", "X", None, []), person("missing", "X", None, None),
         person("now", None, "Poland ", ["1905"]), person("nowhere", None, None, ["1901"])], LAUREATE)
    assert rows(flatten_laureates(df)) == [
        ("now", "Poland ", 1905, "POLAND"), ("two", " Prussia", 1903, "PRUSSIA"), ("two", " Prussia", 1911, "PRUSSIA")]


def test_patents(spark):
    cells = [("A", "A", "7", "x"), ("A", "B", " 7 ", "0"), (None, "A", "7", "-1"), ("A", None, "5", ""), ("B", " b ", "1", None)]
    df = spark.createDataFrame([(o, "c", g, y1, y2) for o, g, y1, y2 in cells],
                               "Office string, `Office (Code)` string, Origin string, `1980` string, `1981` string")
    got = flatten_patents(df).select("Office", "Origin", "year", "patents_count", "resident_patents", "abroad_patents", "country_code")
    assert rows(got) == sorted([
        ("A", "A", 1980, 7, 7, 0, "A"), ("A", "B", 1980, 7, 0, 7, "B"), (None, "A", 1980, 7, 0, 0, "A"),
        ("A", None, 1980, 5, 0, 0, None), ("B", " b ", 1980, 1, 0, 1, "B")], key=str)


def test_unpivot_finds_year_columns_by_name(spark):
    df = spark.createDataFrame([("a", "1", None, "z")], "id string, `1999` string, `2000` string, `19x9` string")
    assert year_columns(df) == ["1999", "2000"]
    assert rows(unpivot_years(df, ["id"], "v")) == [("a", 1999, "1"), ("a", 2000, None)]


def test_explode_drops_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert rows(explode_rows(df, "xs", "x").select("id", "x")) == [(1, 1), (1, 2)]


def test_years_and_scaffold(spark):
    assert rows(year_range(spark, 2000, 2002)) == [(2000, 0), (2001, 1), (2002, 2)]
    assert year_range(spark, 1901).count() >= 125
    seen = spark.createDataFrame([(2000,), (2002,)], "year int")
    assert rows(year_range_of(seen, "year")) == [(2000, 0), (2001, 1), (2002, 2)]
    entities = spark.createDataFrame([("a",), ("b",)], f"`{ISO}` string")
    assert rows(scaffold(entities, ISO, seen)) == [("a", 2000), ("a", 2002), ("b", 2000), ("b", 2002)]


# ---- conforming


def test_flags_share_one_aggregation_and_ignore_null_keys(spark):
    entities = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    hot = spark.createDataFrame([("a",)] * 50 + [(None,)] * 5, "x string")
    other = spark.createDataFrame([("b",), ("c",)], "y string")
    got = flag_presence(entities, "k", {"in_hot": (hot, "x"), "in_other": (other, "y")})
    assert rows(got) == [("a", 1, 1, 0), ("b", 2, 0, 1), (None, 3, 0, 0)]


def test_conform_removes_unknown_codes(spark):
    facts = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("a", 4)], "iso string, v int")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    assert rows(conform(facts, dim, "iso", "code", [dim["name"], facts["v"]])) == [("A", 1), ("A", 4)]
    total = aggregate_then_conform(facts, ["iso"], [F.sum("v").alias("v")], dim, "iso", "code", [F.col("name"), F.col("v")])
    assert rows(total) == [("A", 5)]


# ---- panel


def panel_frames(spark):
    grid = spark.createDataFrame([(e, y) for e in "ab" for y in (1, 2)], "entity string, year int")
    x = spark.createDataFrame([("a", 1, 1.5), ("b", 9, 2.5)], "entity string, year int, x double")
    yz = spark.createDataFrame([("a", 1, 7, None), ("b", 2, None, "t")], "entity string, year int, y long, z string")
    return grid, [(x, ["x"]), (yz, ["y", "z"])]


def test_both_panel_forms_agree(spark):
    grid, inputs = panel_frames(spark)
    by_union, by_joins = panel_by_union(grid, inputs, KEYS), panel_by_joins(grid, inputs, KEYS)
    assert by_union.dtypes == by_joins.dtypes
    assert rows(by_union) == rows(by_joins) == sorted([
        ("a", 1, 1.5, 7, None), ("a", 2, None, None, None), ("b", 1, None, None, None), ("b", 2, None, None, "t")], key=str)


def test_repeated_input_keys_fail_in_one_form_and_multiply_in_the_other(spark):
    grid, inputs = panel_frames(spark)
    double = inputs[0][0].union(inputs[0][0])
    assert panel_by_joins(grid, [(double, ["x"])], KEYS).count() == 5
    with pytest.raises(Exception, match="more than one row per key for 'x'"):
        panel_by_union(grid, [(double, ["x"])], KEYS).collect()
    off_grid = double.filter("year = 9")
    assert panel_by_union(grid, [(off_grid, ["x"])], KEYS).count() == 4


# ---- index


def expected_norms(column):
    logs = [math.log1p(v or 0.0) for v in column]
    low, high = min(logs), max(logs)
    return [None if v is None else 0.5 if high == low else (g - low) / (high - low) for v, g in zip(column, logs)]


@pytest.mark.parametrize("column", [
    [1.0, 3.0, None, 0.0], [2.0, 5.0], [2.0, None], [0.0, None], [4.0, 4.0], [None, None], [-0.5, 1.0, None]])
def test_log1p_minmax(spark, column):
    df = spark.createDataFrame(list(enumerate(column)), "i int, x double")
    got = [r.x_norm for r in index.log1p_minmax(df, ["x"]).orderBy("i").collect()]
    assert got == pytest.approx(expected_norms(column), abs=1e-12)


def test_log1p_accepts_any_column_name(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "`it's a-b` double")
    got = index.log1p_minmax(df, ["it's a-b"])
    assert sorted(r["it's a-b_norm"] for r in got.collect()) == [0.0, 1.0]
    with pytest.raises(Exception, match="value of it's a-b"):
        index.log1p_minmax(df.selectExpr("-`it's a-b` as `it's a-b`"), ["it's a-b"]).collect()


def test_log1p_domain(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (3.0,)], "x double")
    with pytest.raises(Exception, match="log1p is undefined for a value of x"):
        index.log1p_minmax(df, ["x"]).collect()
    got = sorted((r.x, r.x_norm) for r in index.log1p_minmax(df, ["x"], on_domain_error="null").collect())
    assert got == [(-1.0, None), (1.0, 0.0), (3.0, 1.0)]
    with pytest.raises(ValueError):
        index.log1p_minmax(df, ["x"], on_domain_error="zero")


def test_sub_index_counts_missing_as_zero_without_reweighting(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (0.5, 0.5)], "a double, b double")
    got = [r[0] for r in df.select(index.weighted_sum({"a": 0.6, "b": 0.4})).collect()]
    assert got == pytest.approx([0.6, None, 0.5])


@pytest.mark.parametrize("parts, expected", [
    ((None, None, 0.4, 0.7), 0.5), ((None,) * 4, None), ((1.0, 1.0, 1.0, 1.0), 1.0), ((0.0, None, None, None), 0.0)])
def test_score_reweights_over_what_is_present(spark, parts, expected):
    names = list(contract.SCORE_WEIGHTS)
    df = spark.createDataFrame([parts], ", ".join(f"{n} double" for n in names))
    assert df.select(index.reweighted_score(contract.SCORE_WEIGHTS)).first()[0] == pytest.approx(expected)


def brute_force_index(panel):
    """The index formula in plain Python over a list of dicts."""
    def over(a, b):
        return None if a is None or b is None or b <= 0 else a / b
    for r in panel:
        people = None if r["population"] is None else r["population"] / 1e6
        r["patents_per_million"] = over(r["patents_total"], people)
        r["resident_patents_per_million"] = over(r["resident_patents"], people)
        r["nobelists_per_million"] = over(r["nobel_laureates_count"], people)
        r["patent_expansion_ratio"] = over(r["abroad_patents"], r["resident_patents"])
        r["researchers_per_million"] = over(r["researchers_count"], people)
        share = over(r["rd_expenditure"], r["gdp"])
        r["rd_gdp_pct"] = None if share is None else share * 100
    for c in contract.SCALED:
        for r, n in zip(panel, expected_norms([r[c] for r in panel])):
            r[f"{c}_norm"] = n
    for r in panel:
        def weighted(weights):
            if all(r[c] is None for c in weights):
                return None
            return sum((r[c] or 0.0) * w for c, w in weights.items())
        r["patents_index"] = weighted(contract.PATENTS_WEIGHTS)
        r["research_index"] = weighted(contract.RESEARCH_WEIGHTS)
        r["rd_index"] = r["rd_gdp_pct_norm"]
        n = r["graduate_unemployment_rate_norm"]
        r["unemployment_index"] = None if n is None else 1 - n
        present = {c: w for c, w in contract.SCORE_WEIGHTS.items() if r[c] is not None}
        r[contract.SCORE] = sum(r[c] * w for c, w in present.items()) / sum(present.values()) if present else None
    return panel


def random_panel(seed, n=60):
    rng = random.Random(seed)
    def maybe(value):
        return None if rng.random() < 0.3 else value
    panel = []
    for i in range(n):
        panel.append({
            "entity": f"e{i % 12}", "year": 2000 + i // 12,
            "population": maybe(rng.choice([0.0, rng.uniform(1e5, 1e8)])), "gdp": maybe(rng.choice([0.0, rng.uniform(1, 1e9)])),
            "rd_expenditure": maybe(rng.uniform(0, 1e7)), "researchers_count": maybe(rng.uniform(0, 1e4)),
            "graduate_unemployment_rate": maybe(rng.uniform(0, 30)), "patents_total": maybe(rng.randrange(5000)),
            "resident_patents": maybe(rng.randrange(3)), "abroad_patents": maybe(rng.randrange(900)),
            "nobel_laureates_count": maybe(rng.randrange(4))})
    return panel


PANEL_SCHEMA = "entity string, year int, " + ", ".join(f"{m} double" for m in contract.MEASURES[:5]) + ", " + \
    ", ".join(f"{m} long" for m in contract.MEASURES[5:])


@pytest.mark.parametrize("seed", range(3))
def test_composite_index_matches_brute_force(spark, seed):
    panel = random_panel(seed)
    df = spark.createDataFrame([tuple(r[c] for c in [*KEYS, *contract.MEASURES]) for r in panel], PANEL_SCHEMA)
    shuffled = df.repartition(5, "graduate_unemployment_rate")
    scored = gold.composite_index(shuffled)
    assert len(scored.columns) == 29
    got = {(r.entity, r.year): r.asDict() for r in scored.collect()}
    for expected in brute_force_index(panel):
        actual = got[expected["entity"], expected["year"]]
        for name, value in expected.items():
            assert actual[name] == pytest.approx(value, abs=1e-9), name
        for c in contract.SCALED:
            assert (actual[c] is None) == (actual[f"{c}_norm"] is None)
        assert actual[contract.SCORE] is None or 0 <= actual[contract.SCORE] <= 1


# ---- ranking


def scores(spark, seed):
    """A third of the rows share one group and one score; some scores are missing."""
    rng = random.Random(seed)
    data = [(i, "hot" if i % 3 == 0 else f"g{rng.randrange(4)}",
             0.5 if i % 3 == 0 else rng.choice([None, 0.0, -0.0, rng.random(), rng.randrange(5) / 4])) for i in range(600)]
    data += [(1000 + i, "unscored", None) for i in range(3)]
    data += [(2000 + i, "hot", i / 700) for i in range(700)]
    return data, spark.createDataFrame(data, "id int, grp string, score double")


def brute_ranks(data):
    best = {}
    for _, g, s in data:
        best.setdefault(g, set())
        if s is not None:
            best[g].add(s)
    order = {g: sorted(v, reverse=True) for g, v in best.items()}
    return {i: len(order[g]) + 1 if s is None else order[g].index(s) + 1 for i, g, s in data}


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_rank_within_matches_brute_force(spark, slices):
    data, df = scores(spark, slices)
    got = index.rank_within(df, "grp", "score", slices=slices)
    assert {r.id: r["rank"] for r in got.collect()} == brute_ranks(data)


def test_top_k_keeps_all_ties(spark):
    data, df = scores(spark, 5)
    expected = {i: r for i, r in brute_ranks(data).items() if r <= 3 and dict((d[0], d[2]) for d in data)[i] is not None}
    got = index.top_k_within(df, "grp", "score", 3)
    assert {r.id: r["rank"] for r in got.collect()} == expected


# ---- checks and audit


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k", "v"])) == [(1, "a", 2)]
    assert quality.require_unique(df.filter("k = 2"), ["k"], "df").count() == 1
    with pytest.raises(ValueError, match="repeated key"):
        quality.require_unique(df, ["k"], "df")
    assert quality.require_rows(df, "df") is df
    for bad in (None, df.filter("k > 9")):
        with pytest.raises(ValueError, match="missing or empty input: x"):
            quality.require_rows(bad, "x")


def test_missing_inputs_are_listed(spark):
    required = spark.createDataFrame([("A",), ("B",), ("C",)], "model string")
    done = spark.createDataFrame([("B",), ("B",)], "model string")
    assert rows(quality.missing_inputs(required, done, "model")) == [("A",), ("C",)]
    with pytest.raises(ValueError, match=r"\[fact\].*\['A', 'C'\]"):
        quality.require_inputs(required, done, "model", "fact")
    quality.require_inputs(required.filter("model = 'B'"), done, "model", "fact")


def test_table_audit(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, None)], "k int, v string")
    got = audit.audit_all({"t": (df, ["k"]), "none": (df.limit(0), ["k"])}, "r1")
    assert rows(got.select("run_id", "model", "row_count", "key_count", "null_counts.k", "null_counts.v")) == [
        ("r1", "none", 0, 0, 0, 0), ("r1", "t", 3, 2, 1, 2)]


@pytest.mark.parametrize("statuses, overall, landing, model", [
    (["COMPLETED"], "COMPLETED", "COMPLETED", "COMPLETED"),
    (["COMPLETED", "SKIPPED"], "PARTIAL_SUCCESS", "COMPLETED", "FAILED"),
    (["SKIPPED", "FAILED"], "FAILED", "FAILED", "FAILED"),
    ([], "NO_RESULTS", "COMPLETED", "COMPLETED")])
def test_status_rollup(spark, statuses, overall, landing, model):
    results = spark.createDataFrame([("r", s, 10) for s in statuses], "run_id string, status string, duration_in_ms long")
    runs = spark.createDataFrame([("r",)], "run_id string")
    got = audit.status_rollup(results, "run_id", runs).first()
    assert tuple(got) == ("r", len(statuses), 10 * len(statuses), overall, landing, model)


def test_success_words(spark):
    df = spark.createDataFrame([("COMPLETED",), ("SKIPPED",), ("FAILED",)], "s string")
    assert [r[0] for r in df.select(audit.is_success(F.col("s"))).collect()] == [True, True, False]


@pytest.mark.parametrize("partitions", [None, 1, 5])
def test_positions_follow_the_order(spark, partitions):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 101) for k in range(60)]
    df = spark.createDataFrame(rows, "a INT, b INT")
    order = [F.col("a").asc_nulls_first(), F.col("b").desc()]
    got = ordinals.positions(df, order, partitions=partitions).collect()
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in got) == list(range(60))
    assert ordinals.positions(df.where("false"), order).count() == 0
