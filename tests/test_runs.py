"""Both layers end to end on small source files, against a plain Python computation."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.plans import runs
from panelwright.sources.files import read_table
from panelwright.sources.summaries import read_summaries
from test_operators import brute_force_index

ISO = contract.ISO
COUNTRIES = {"POL": "Poland", "CIV": "Côte d'Ivoire", "DEU": "Germany", "XKX": "Nowhere"}
YEARS = (2000, 2001)


def value(dataset, iso, year):
    """Any fixed numbers; some are missing."""
    if iso == "XKX" or (dataset == "rd" and iso == "CIV"):
        return None
    base = {"population": 4e7, "pkb": 1e11, "rd": 1.5, "researchers": 3000.0, "unemployment": 9.0}[dataset]
    return base * (1 + list(COUNTRIES).index(iso)) + (year - 2000) * base / 10


PATENTS = [  # office, origin, 2000, 2001
    ("Poland", "Poland", "7", "9"), ("Germany", "Poland", "3", "x"), ("Germany", "Germany", "20", " 30 "),
    ("Poland", "Germany", "5", "0"), (None, "Germany", "2", "-4"), ("Poland", "Côte d'Ivoire", "4", "4"),
]
LAUREATES = [  # id, born, now, years
    ("1", "Poland", None, ["2000", "2001"]), ("2", None, "poland ", ["2000"]), ("3", "Germany", "Poland", ["2001"]),
    ("4", "Côte d'Ivoire", None, ["2000"]), ("5", None, None, ["2000"]), ("6", "Germany", None, []),
]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for folder in ("references", "manual", "bronze"):
        (root / folder).mkdir()
    (root / "references" / "codes.csv").write_text(
        f"{ISO},official_name_en,other\n" + "".join(f'{k},"{v}",z\n' for k, v in COUNTRIES.items()), encoding="utf-8")
    cells = [["Office", "Office (Code)", "Origin", "2000", "2001"]]
    cells += [[p[0] or "", "c", p[1], p[2], p[3]] for p in PATENTS]
    (root / "manual" / "patents.csv").write_text("\n".join(",".join(f'"{c}"' if c else "" for c in row) for row in cells), encoding="utf-8")

    results = []
    def landed(source, dataset, files):
        paths = []
        for i, records in enumerate(files):
            path = root / "bronze" / f"{dataset}{i}.json"
            path.write_text(json.dumps(records), encoding="utf-8")
            paths.append(str(path))
        results.append({"status": "COMPLETED", "correlation_id": "r", "duration_in_ms": 1, "record_count": 1,
                        "domain_source": source, "dataset_name": dataset, "output_paths": paths})
    for dataset in contract.INDICATOR_VALUE_COLUMN:
        def page(year):
            known = [{"country": {"value": n}, "countryiso3code": iso, "date": str(year), "value": value(dataset, iso, year)} for iso, n in COUNTRIES.items() if iso != "XKX"]
            return known + [{"country": {"value": "World"}, "countryiso3code": "", "date": str(year), "value": 1.0}]
        landed("WORLDBANK", dataset, [page(y) for y in YEARS])
    def person(id, born, now, years):
        return {"id": id, "birth": {"place": {"country": {"en": born}, "countryNow": {"en": now}}}, "nobelPrizes": [{"awardYear": y} for y in years]}
    landed("NOBELPRIZE", "laureates", [[person(*p) for p in LAUREATES]])
    summary = {"status": "COMPLETED", "env": "dev", "etl_layer": "bronze", "correlation_id": "r", "results": results}
    (root / "summary.json").write_text(json.dumps(summary))
    return root


SILVER = {
    "references_tables": {"country_codes": "/references/codes.csv"},
    "manual_data_paths": [{"domain_source": "PATENTS", "dataset_name": "patents", "file_path": "/manual/patents.csv"}],
}
GOLD = {
    "dims": [{"name": "dim_country", "source_models": ["COUNTRY"]}, {"name": "dim_year", "source_models": ["YEAR"]}],
    "facts": [{"name": "fact_innovation", "source_models": list(contract.SILVER_MODELS)}],
}


@pytest.fixture(scope="module")
def silver(spark, lake):
    return runs.run_silver(spark, SILVER, read_summaries(spark, str(lake / "summary.json")), str(lake), "run-s")


@pytest.fixture(scope="module")
def gold(spark, lake, silver):
    stored = read_summaries(spark, str(lake / "silver" / "outputs" / "summaries" / "run-s"))
    return runs.run_gold(spark, GOLD, stored, str(lake), "run-g")


def model(spark, lake, layer, name):
    return read_table(spark, str(lake / layer / name))


def test_silver_summary(silver):
    assert silver["status"] == "COMPLETED", silver
    counts = {r["model"]: r["record_count"] for r in silver["results"]}
    assert set(counts) == set(contract.SILVER_MODELS)
    assert (counts["COUNTRY"], counts["POPULATION"], counts["NOBEL_LAUREATES"], counts["PATENTS"]) == (4, 6, 4, 4)
    assert counts["YEAR"] == datetime.date.today().year - 1900


def test_country_flags(spark, lake, silver):
    got = {r[ISO]: tuple(r)[2:] for r in model(spark, lake, "silver", "COUNTRY").collect()}
    # The accent is stripped from the reference name only, so that name never matches.
    assert got == {"POL": (1, 1, 1, "POLAND"), "DEU": (1, 1, 1, "GERMANY"), "CIV": (1, 0, 0, None), "XKX": (0, 0, 0, None)}


def test_conformed_models(spark, lake, silver):
    laureates = model(spark, lake, "silver", "NOBEL_LAUREATES")
    assert sorted((r.laureate_id, r.year, r[ISO]) for r in laureates.collect()) == [
        ("1", 2000, "POL"), ("1", 2001, "POL"), ("2", 2000, "POL"), ("3", 2001, "DEU")]
    patents = model(spark, lake, "silver", "PATENTS")
    assert sorted((r[ISO], r.year, r.patents_total, r.resident_patents, r.abroad_patents) for r in patents.collect()) == [
        ("DEU", 2000, 27, 20, 5), ("DEU", 2001, 30, 30, 0), ("POL", 2000, 10, 7, 3), ("POL", 2001, 9, 9, 0)]
    assert "unemployment_rate" in model(spark, lake, "silver", "GRADUATE_UNEMPLOYMENT").columns


def test_fact(spark, lake, gold):
    assert gold["status"] == "COMPLETED", gold
    fact = model(spark, lake, "gold", "fact_innovation")
    assert len(fact.columns) == 29
    years = range(1901, datetime.date.today().year + 1)
    panel = []
    for iso, name in COUNTRIES.items():
        for year in years:
            row = {"iso": iso, "year": year, **dict.fromkeys(contract.MEASURES)}
            if year in YEARS:
                for measure, dataset in zip(contract.MEASURES, ["population", "pkb", "rd", "researchers", "unemployment"]):
                    row[measure] = value(dataset, iso, year)
            panel.append(row)
    totals = {("POL", 2000): (10, 7, 3, 2), ("POL", 2001): (9, 9, 0, 1), ("DEU", 2000): (27, 20, 5, None), ("DEU", 2001): (30, 30, 0, 1)}
    for row in panel:
        if (row["iso"], row["year"]) in totals:
            row.update(zip(contract.MEASURES[5:], totals[row["iso"], row["year"]]))
    got = {(r[ISO], r.year): r.asDict() for r in fact.collect()}
    assert len(got) == fact.count() == len(panel)
    for expected in brute_force_index(panel):
        actual = got[expected.pop("iso"), expected["year"]]
        for key, v in expected.items():
            assert actual[key] == pytest.approx(v, abs=1e-9), key


def test_dimensions(spark, lake, gold):
    assert model(spark, lake, "gold", "dim_country").count() == 4
    year = model(spark, lake, "gold", "dim_year").orderBy("year")
    assert tuple(year.first()) == (1901, 0)


def test_second_run_gives_the_same_fact(spark, lake, gold):
    before = sorted(map(str, model(spark, lake, "gold", "fact_innovation").collect()))
    stored = read_summaries(spark, str(lake / "silver" / "outputs" / "summaries" / "run-s"))
    runs.run_gold(spark, GOLD, stored, str(lake), "run-g2")
    assert sorted(map(str, model(spark, lake, "gold", "fact_innovation").collect())) == before


def test_partitioned_fact(spark, lake, silver, tmp_path):
    stored = read_summaries(spark, str(lake / "silver" / "outputs" / "summaries" / "run-s"))
    runs.run_gold(spark, GOLD, stored, str(tmp_path), "run-p", partition_cols={"fact_innovation": ["year"]})
    fact = model(spark, tmp_path, "gold", "fact_innovation")
    assert (tmp_path / "gold" / "fact_innovation" / "year=2000").is_dir()
    assert fact.filter("year = 2000").count() == 4


def test_a_failed_model_keeps_its_name_and_the_others(spark, lake, silver, tmp_path):
    summary = read_summaries(spark, str(lake / "summary.json")).withColumn(
        "results", F.filter("results", lambda r: r["dataset_name"] != "rd"))
    got = runs.run_silver(spark, {**SILVER, "references_tables": {"country_codes": str(lake / "references" / "codes.csv").replace("/", "file:///", 1)},
                                  "manual_data_paths": []}, summary, str(tmp_path), "run-f")
    status = {r["model"]: r["status"] for r in got["results"]}
    assert got["status"] == "FAILED"
    assert {m for m, s in status.items() if s == "FAILED"} == {"RD_EXPENDITURE", "PATENTS", "NOBEL_LAUREATES"}
    failed = next(r for r in got["results"] if r["model"] == "RD_EXPENDITURE")
    assert "missing or empty input: rd" in failed["error_details"]["error_message"]
    country = model(spark, tmp_path, "silver", "COUNTRY")
    assert "country_code" not in country.columns

    stored = read_summaries(spark, str(tmp_path / "silver" / "outputs" / "summaries" / "run-f"))
    fact = runs.run_gold(spark, GOLD, stored, str(tmp_path), "run-g")
    by_name = {r["model"]: r for r in fact["results"]}
    assert by_name["dim_country"]["status"] == "COMPLETED" and by_name["fact_innovation"]["status"] == "FAILED"
    assert "RD_EXPENDITURE" in by_name["fact_innovation"]["error_details"]["error_message"]


BRONZE = {"sources": [
    {"source_config_payload": {"domain_source_type": "api", "domain_source": source, "dataset_name": dataset,
                               "request_payload": {"n": dataset}}}
    for source, dataset in [("NOBELPRIZE", "laureates"), *[("WORLDBANK", d) for d in contract.INDICATOR_VALUE_COLUMN]]]}


def landed_pages(spark, lake):
    """The source files again, as fetched pages of the two shapes, plus an empty last page."""
    pages = {}
    for source in BRONZE["sources"]:
        dataset = source["source_config_payload"]["dataset_name"]
        records = [json.loads(p.read_text()) for p in sorted((lake / "bronze").glob(f"{dataset}*.json"))]
        wrapped = [{dataset: r} for r in [*records, []]] if dataset == "laureates" else [[{"page": 1}, r] for r in records] + [[{"page": 9}, None]]
        pages[dataset] = spark.createDataFrame([(json.dumps(w),) for w in wrapped], "page string")
    return pages


def test_all_three_layers_from_pages(spark, lake, gold, tmp_path):
    pages = landed_pages(spark, lake)
    first = runs.run_bronze(spark, BRONZE, pages, str(tmp_path), "b1", "2025-09-20")
    assert first["status"] == "COMPLETED", first
    assert {r["dataset_name"]: r["record_count"] for r in first["results"]} == {
        "laureates": 6, **{d: 8 for d in contract.INDICATOR_VALUE_COLUMN}}
    again = runs.run_bronze(spark, BRONZE, pages, str(tmp_path), "b2", "2025-09-20")
    assert {r["status"] for r in again["results"]} == {"SKIPPED"} and again["status"] == "COMPLETED"
    assert [r["output_paths"] for r in again["results"]] == [r["output_paths"] for r in first["results"]]

    manifest = {"references_tables": {"country_codes": f"file://{lake}/references/codes.csv"},
                "manual_data_paths": [{"domain_source": "PATENTS", "dataset_name": "patents", "file_path": f"file://{lake}/manual/patents.csv"}]}
    landed = read_summaries(spark, str(tmp_path / "bronze" / "outputs" / "summaries" / "b2"))
    assert runs.run_silver(spark, manifest, landed, str(tmp_path), "s")["status"] == "COMPLETED"
    stored = read_summaries(spark, str(tmp_path / "silver" / "outputs" / "summaries" / "s"))
    assert runs.run_gold(spark, GOLD, stored, str(tmp_path), "g")["status"] == "COMPLETED"
    facts = [sorted(map(str, model(spark, root, "gold", "fact_innovation").collect())) for root in (tmp_path, lake)]
    assert facts[0] == facts[1]


def test_landing_failures_and_empty_sources(spark, tmp_path):
    pages = {"laureates": spark.createDataFrame([(json.dumps({"laureates": []}),)], "page string"),
             "rd": spark.createDataFrame([("x",)], "other string")}
    got = runs.run_bronze(spark, BRONZE, pages, str(tmp_path), "b", "2025-09-20")
    status = {r["dataset_name"]: (r["status"], r["output_paths"]) for r in got["results"]}
    assert got["status"] == "FAILED"
    assert status["laureates"] == ("COMPLETED", []) and status["rd"] == status["pkb"] == ("FAILED", [])
    assert runs.landing.read_ledger(spark, str(tmp_path / "bronze" / "ledger")).count() == 0


def test_landed_patents_and_absent_paths(spark, tmp_path):
    (tmp_path / "patents.csv").write_text("Office,Office (Code),Origin,2000\nPoland,PL,Poland,7\n")
    results = [
        {"status": "COMPLETED", "domain_source": s, "dataset_name": d, "output_paths": [str(tmp_path / p) for p in paths]}
        for s, d, paths in (("PATENTS", "patents", ["absent.csv", "patents.csv"]), ("WORLDBANK", "rd", ["absent"]))
    ]
    kind = "status: STRING, domain_source: STRING, dataset_name: STRING, output_paths: ARRAY<STRING>"
    summary = spark.createDataFrame(
        [("COMPLETED", "b", "bronze", results)],
        f"status STRING, correlation_id STRING, etl_layer STRING, results ARRAY<STRUCT<{kind}>>",
    )
    with pytest.warns(UserWarning, match="left out"):
        sources = runs.silver_sources(spark, {"manual_data_paths": []}, summary, str(tmp_path))
    assert sources["rd"] is None and sources["population"] is None
    assert [(r["year"], r["patents_count"]) for r in sources["patents"].collect()] == [(2000, 7)]
