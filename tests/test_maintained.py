"""Indexes kept up to date over batches, against the full recompute."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators.index import log1p_minmax
from panelwright.operators.maintained import Extremes, MaintainedIndex

SCHEMA = "id LONG, year INT, a DOUBLE, b DOUBLE"


@pytest.fixture
def kept(spark, tmp_path):
    return MaintainedIndex(
        spark, str(tmp_path / "index"), ["id", "year"], ["year"], ["a", "twice"],
        lambda df: df.withColumn("twice", F.col("b") * 2),
        lambda df: df.withColumn("score", F.coalesce("a_norm", F.lit(0.0)) + F.coalesce("twice_norm", F.lit(0.0))),
    )


def apply(kept, rows):
    return kept.apply(kept.spark.createDataFrame(rows, SCHEMA))


def full(kept, rows):
    df = kept.spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)
    return {tuple(r) for r in kept.finish(log1p_minmax(kept.derive(df), kept.columns)).select("id", "year", "score").collect()}


def scores(kept):
    return {tuple(r) for r in kept.scores().select("id", "year", "score").collect()}


def test_batches_equal_the_full_recompute_and_read_no_more_than_needed(kept):
    rows = {(i, y): (float(i % 7), float(y - 2000 + i % 3)) for i in range(20) for y in (2000, 2001, 2002)}
    report = apply(kept, [(*k, *v) for k, v in rows.items()])
    assert report == {"panel_rows_read": 60, "rescanned": False, "rescored": True, "rows_scored": 60}

    def change(batch):
        rows.update({(i, y): (a, b) for i, y, a, b in batch})
        report = apply(kept, batch)
        assert scores(kept) == full(kept, rows)
        return report

    inside = change([(3, 2001, 2.5, 1.5), (99, 2001, 1.0, None)])
    assert inside == {"panel_rows_read": 20, "rescanned": False, "rescored": False, "rows_scored": 2}
    one_of_many = change([(6, 2002, 3.0, 2.0)])  # other rows still have the largest value
    assert not one_of_many["rescored"] and one_of_many["panel_rows_read"] == 20
    higher = change([(7, 2000, 50.0, 2.0)])
    assert higher["rescored"] and not higher["rescanned"] and higher["rows_scored"] == 61
    gone = change([(7, 2000, 1.0, 2.0)])  # the only row with the largest value
    assert gone["rescored"] and gone["rescanned"] and gone["panel_rows_read"] == 20 + 3 * 61
    replaced = change([(8, 2000, 60.0, 2.0)]), change([(8, 2000, 70.0, 2.0)])
    assert not any(r["rescanned"] for r in replaced)  # a new extreme makes up for the old one
    new_year = change([(1, 2010, None, 1.0)])
    assert new_year == {"panel_rows_read": 0, "rescanned": False, "rescored": False, "rows_scored": 1}
    assert apply(kept, []) == {"panel_rows_read": 0, "rescanned": False, "rescored": False, "rows_scored": 0}


def test_a_batch_may_be_repeated(kept):
    rows = {(i, 2000): (float(i), 1.0) for i in range(5)}
    batch = [(*k, *v) for k, v in rows.items()]
    apply(kept, batch)
    before = kept.extremes()
    report = apply(kept, batch)
    assert not report["rescored"] and kept.extremes() == before and scores(kept) == full(kept, rows)


@pytest.mark.parametrize("step", ["write_table", "_merge_scores"])
def test_a_batch_that_was_cut_off_is_made_good(kept, monkeypatch, step):
    from panelwright.operators import maintained

    rows = {(i, 2000): (float(i), 1.0) for i in range(5)}
    apply(kept, [(*k, *v) for k, v in rows.items()])

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(maintained if step == "write_table" else MaintainedIndex, step, fail)
        with pytest.raises(RuntimeError):
            apply(kept, [(2, 2000, 1.5, 1.0)])
    assert kept.extremes() is None
    rows[2, 2000] = (1.5, 1.0)
    assert apply(kept, [(2, 2000, 1.5, 1.0)])["rescanned"]
    assert scores(kept) == full(kept, rows)


def test_extremes_merge(spark):
    values = [3.0, None, -0.5, 7.0, 7.0, 0.0, -0.5, 2.0]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k INT, v DOUBLE")
    whole = Extremes.of(df, ["v"])
    assert whole.ends == {("v", "low"): (-0.5, 2), ("v", "high"): (7.0, 2)} and whole.rows == 8
    parts = [Extremes.of(df.where(F.col("k") % 3 == r), ["v"]) for r in range(3)]
    assert parts[0].merged(parts[1]).merged(parts[2]) == whole == parts[2].merged(parts[0].merged(parts[1]))
    assert Extremes.of(df.where("false"), ["v"]).merged(whole) == whole
    left = whole.without(df.where("k < 4"), 4)
    assert left.ends == {("v", "low"): (-0.5, 1), ("v", "high"): (7.0, 1)} and left.known
    assert not whole.without(df.where("v = 7"), 2).known


def test_known_bounds_scale_like_the_fit(spark):
    df = spark.createDataFrame([(0.1, 5.0), (None, 5.0), (123.456, 5.0), (7e9, 5.0)], "a DOUBLE, b DOUBLE")
    from panelwright.operators.index import log1p_scaled

    bounds = Extremes.of(df, ["a", "b"]).bounds()
    assert sorted(map(repr, log1p_scaled(df, bounds).collect())) == sorted(map(repr, log1p_minmax(df, ["a", "b"]).collect()))
    with pytest.raises(ValueError):
        log1p_scaled(df, {"a": (-1.0, 2.0)})
