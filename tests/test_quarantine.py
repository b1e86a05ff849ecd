"""Records that cannot be read are set aside, the others stay."""

import json

import pytest

from panelwright.plans import runs
from panelwright.sources import quarantine

SCHEMA = "k INT, s STRING, t STRUCT<a: INT>"
LINES = [
    ('{"k": 1, "s": "x", "t": {"a": 2}}', None), ('{"k": 2}', None), ("{}", None), ('{"k": 3, "more": [1]}', None),
    ('{"k": null, "s": null}', None), ('{"k": 4, "s": "cut', "no JSON"), ("plain text", "no JSON"),
    ('{"k": 5} trailing', "no JSON"), ('{"k": 5}{"k": 6}', "no JSON"),
    ('{"k": 5}, {"k": 6}', "no JSON"), ('{"k": 7, "s": "}, {"}', None), ('{"k": "five"}', "wrong type"), ('{"k": 6, "t": {"a": "b"}}', "wrong type"),
    ("[1, 2]", "no object"), ("17", "no object"), ('"text"', "no object"), ("null", "no object"),
]


def test_lines(spark, tmp_path):
    for part in (0, 1):
        (tmp_path / f"in{part}.json").write_text("\n".join(["", *[text for text, _ in LINES[part::2]], "  ", ""]))
    checked = quarantine.checked_lines(spark, str(tmp_path), SCHEMA)
    assert sorted(r["k"] or 0 for r in quarantine.good(checked).collect()) == [0, 0, 1, 2, 3, 7]
    found = quarantine.bad(checked).collect()
    assert {(r["text"], r["reason"]) for r in found} == {(t, r) for t, r in LINES if r}
    assert {r["file"][-8:] for r in found} == {"in0.json", "in1.json"}
    assert quarantine.good(checked).columns == ["k", "s", "t"]


def test_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": "x"}, {"k": 2, "t": {"a": 1}}, {"k" 3}, {"k": 4}]')
    checked = quarantine.checked_arrays(spark, str(tmp_path), SCHEMA)
    assert sorted(r["k"] for r in quarantine.good(checked).collect()) == [1, 2, 4]
    assert {(r["text"], r["reason"]) for r in quarantine.bad(checked).collect()} == {
        ('{"k": "x"}', "wrong type"), ('{"k" 3}', "no JSON")}


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,x,2\n3,y\n4,z,5,6\nno,w,7\n,,\n")
    checked = quarantine.checked_csv(spark, str(tmp_path), "a INT, b STRING, c INT")
    assert sorted((r["a"] or 0, r["c"] or 0) for r in quarantine.good(checked).collect()) == [(0, 0), (1, 2)]
    assert {r["text"] for r in quarantine.bad(checked).collect()} == {"3,y", "4,z,5,6", "no,w,7"}


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\nbroken\n')
    path = str(tmp_path / "aside")
    assert quarantine.quarantined(spark, path).count() == 0
    for run in ("r1", "r2", "r2"):
        checked = quarantine.checked_lines(spark, str(tmp_path / "a.json"), SCHEMA)
        assert quarantine.set_aside(checked, path, run, "d").count() == 1
    rows = quarantine.quarantined(spark, path).collect()
    assert sorted((r["run"], r["text"]) for r in rows) == [("r1", "broken"), ("r2", "broken")]


@pytest.fixture
def lake(tmp_path):
    def indicator(iso, value):
        return json.dumps({"country": {"value": iso}, "countryiso3code": iso, "date": "2000", "value": value})

    texts = {
        "wb.json": "\n".join([indicator("POL", 1.0), indicator("DEU", "n/a"), '{"cut', indicator("FRA", 3.0)]),
        "other.json": indicator("XXX", 99.0), "arr.json": f'[{indicator("ESP", 4.0)}, {indicator("ITA", "?")}]',
        "manual.json": indicator("YYY", 98.0),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    results = [("WORLDBANK", "population", ["wb.json", "arr.json", "gone.json"]), ("ELSEWHERE", "population", ["other.json"])]
    summary = {"status": "COMPLETED", "correlation_id": "r", "etl_layer": "bronze", "results": [
        {"status": "COMPLETED", "domain_source": s, "dataset_name": d, "output_paths": [str(tmp_path / p) for p in paths]}
        for s, d, paths in results]}
    (tmp_path / "summary.json").write_text(json.dumps(summary))
    return tmp_path


@pytest.mark.filterwarnings("ignore:left out")
def test_a_dataset_is_its_source_and_its_name(spark, lake):
    summary = spark.read.option("multiline", True).json(str(lake / "summary.json"))
    manifest = {"manual_data_paths": [{"domain_source": "ELSEWHERE", "dataset_name": "population", "file_path": "/manual.json"}]}
    aside = str(lake / "aside")
    frames = runs.silver_sources(spark, manifest, summary, str(lake), aside, "run-7")
    assert sorted(tuple(r)[-1] for r in frames["population"].select("value").collect()) == [1.0, 3.0, 4.0]
    assert frames["rd"] is None and frames["patents"] is None
    rows = quarantine.quarantined(spark, aside).collect()
    assert sorted((r["reason"], r["dataset"], r["run"]) for r in rows) == [
        ("no JSON", "population", "run-7"), ("wrong type", "population", "run-7"), ("wrong type", "population", "run-7")]
    manifest["manual_data_paths"][0]["domain_source"] = "WORLDBANK"
    by_hand = runs.silver_sources(spark, manifest, summary, str(lake))
    assert [r["value"] for r in by_hand["population"].select("value").collect()] == [98.0]
