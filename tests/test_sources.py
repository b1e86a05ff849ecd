"""Scans, envelopes and run summaries on files written by the test."""

import json

import pytest
from pyspark.sql import functions as F

from panelwright.sources import envelopes, files, schemas, summaries

PAGE = {"indicator": {"id": "SP", "value": "Pop"}, "country": {"id": "PL", "value": "Poland"},
        "countryiso3code": "POL", "date": "2000", "value": 38.5, "unit": "", "obs_status": "", "decimal": 0}


def write(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


def test_json_array_has_one_row_per_element_over_all_paths(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.json", [PAGE, dict(PAGE, date=str(2000 + i))]) for i in range(2)]
    rows = files.read_json_array(spark, paths, schemas.INDICATOR).select("country.value", "date", "value").collect()
    assert sorted(tuple(r) for r in rows) == [("Poland", "2000", 38.5)] * 3 + [("Poland", "2001", 38.5)]


def test_landed_arrays_and_folders_of_lines_are_read_together(spark, tmp_path):
    array = write(tmp_path / "a.JSON", [PAGE, PAGE])
    (tmp_path / "lines").mkdir()
    write(tmp_path / "lines" / "part-0.txt", json.dumps(PAGE) + "\n" + json.dumps(PAGE) + "\n" + json.dumps(PAGE))
    folder = str(tmp_path / "lines")
    assert files.read_landed(spark, [array, folder], schemas.INDICATOR).count() == 5
    assert files.read_landed(spark, [folder], schemas.INDICATOR).count() == 3
    assert files.read_landed(spark, [array], schemas.INDICATOR).count() == 2


def test_raw_records_keep_all_fields(spark):
    pages = spark.createDataFrame([(json.dumps([{"page": 1}, [{"a": 1, "deep": {"b": [1, 2]}}]]),), ("[1]",)], "page string")
    assert [json.loads(r.record) for r in envelopes.raw_records(pages, "page").collect()] == [{"a": 1, "deep": {"b": [1, 2]}}]


def test_skipped_landings_stay_readable(spark):
    rows = spark.createDataFrame(
        [("SKIPPED", "s", "d", ["p"]), ("FAILED", "s", "e", ["q"])],
        "status string, domain_source string, dataset_name string, output_paths array<string>")
    assert summaries.valid_output_paths(rows).count() == 0
    assert [r.path for r in summaries.valid_output_paths(rows, include_skipped=True).collect()] == ["p"]


def test_csv_is_all_strings_unless_a_schema_is_given(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Office (Code),1980\nPL,7\n")
    assert files.read_csv(spark, path).dtypes == [("Office (Code)", "string"), ("1980", "string")]
    assert files.read_csv(spark, path, "code STRING, n INT").collect() == [("PL", 7)]


def test_format_dispatch(spark, tmp_path):
    assert files.read_by_extension(spark, write(tmp_path / "x.CSV", "a\n1\n")).collect() == [("1",)]
    assert files.read_by_extension(spark, write(tmp_path / "x.json", '{"a": 1}')).collect() == [(1,)]
    assert files.read_by_extension(spark, write(tmp_path / "y.json", [PAGE]), schemas.INDICATOR).count() == 1
    with pytest.raises(ValueError, match="unsupported file extension"):
        files.format_of("x.xlsx")
    with pytest.raises(ValueError, match="unknown table format"):
        files.read_table(spark, "x", "tape")
    assert files.read_named(spark, {"codes": str(tmp_path / "x.CSV")}, "codes").count() == 1
    assert files.read_named(spark, {}, "codes") is None


def test_lineage_names_run_and_file(spark, tmp_path):
    path = write(tmp_path / "l.json", '{"a": 1}')
    row = files.with_lineage(files.read_json_lines(spark, path, "a INT"), "r7", source_file=True).first()
    assert row.run_id == "r7" and row.source_file.endswith("l.json")


def test_binary_files_are_read_by_format(spark, tmp_path):
    write(tmp_path / "b.bin", "abc")
    assert files.read_table(spark, str(tmp_path / "b.bin"), "binaryFile").first().length == 3


def test_meta_pages(spark):
    pages = [json.dumps([{"page": 1}, [PAGE, PAGE]]), json.dumps([{"page": 2}, None]), json.dumps([{"page": 3}]),
             json.dumps({"message": "no"}), "not json", None]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(pages)], "page string, n int")
    got = envelopes.records_of_meta_pages(df, "page", schemas.INDICATOR, keep=("n",))
    assert [(r.n, r.countryiso3code) for r in got.collect()] == [(0, "POL"), (0, "POL")]


def test_keyed_pages(spark):
    pages = [json.dumps({"laureates": [{"id": "1"}, {"id": "2"}], "meta": {}}), json.dumps({"prizes": []})]
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    got = envelopes.records_of_keyed_pages(df, "page", "laureates", schemas.LAUREATE)
    assert sorted(r.id for r in got.collect()) == ["1", "2"]


def result(status, dataset, paths, source="WORLDBANK"):
    return {"status": status, "correlation_id": "c", "duration_in_ms": 5, "record_count": 1,
            "domain_source": source, "dataset_name": dataset, "output_paths": paths, "error_details": {}}


def test_summary_gives_paths_of_completed_results(spark, tmp_path):
    summary = {"status": "COMPLETED", "env": "dev", "etl_layer": "bronze", "correlation_id": "c", "duration_in_ms": 1,
               "results": [result("completed", "population", ["a", "b"]), result("FAILED", "rd", ["c"]),
                           result("COMPLETED", "pkb", ["d"]), result("SKIPPED", "x", [])]}
    read = summaries.read_summaries(spark, write(tmp_path / "s.json", summary))
    rows = summaries.result_rows(read)
    got = summaries.valid_output_paths(rows)
    assert sorted((r.dataset_name, r.path) for r in got.collect()) == [("pkb", "d"), ("population", "a"), ("population", "b")]
    assert [r.path for r in summaries.valid_output_paths(rows, ["pkb"]).collect()] == ["d"]
    assert rows.filter(summaries.is_landed(F.col("status"))).count() == 1


@pytest.mark.parametrize("run, statuses, valid", [
    ("Completed", ["COMPLETED", "completed"], True), ("COMPLETED", ["COMPLETED", "SKIPPED"], False),
    ("FAILED", ["COMPLETED"], False), ("COMPLETED", [], True)])
def test_whole_summary_validity(spark, run, statuses, valid):
    df = spark.createDataFrame([(run, [(s,) for s in statuses])], "status string, results array<struct<status: string>>")
    assert df.select(summaries.summary_is_valid(F.col("status"), F.col("results"))).first()[0] is valid


def test_routing_prefers_manual_paths_and_keeps_all_landed_ones(spark):
    def paths(rows):
        return spark.createDataFrame(rows, "dataset_name string, path string")
    required = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset_name string")
    got = summaries.route_sources(required, paths([("a", "m")]), paths([("a", "l"), ("b", "l1"), ("b", "l2")]), ["dataset_name"])
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("a", "m", "manual"), ("b", "l1", "landed"), ("b", "l2", "landed"), ("c", None, None)]


def test_json_lines_in_a_folder_with_a_json_suffix(spark, tmp_path):
    path = str(tmp_path / "x.json")
    spark.range(10).selectExpr("string(id) as a").repartition(2).write.json(path)
    assert files.read_landed(spark, [path], "a STRING").count() == 10
    assert files.read_by_extension(spark, path, "a STRING").count() == 10


def test_arrays_without_a_suffix(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    for k in range(2):
        (tmp_path / "pages" / f"p{k}").write_text('\n [\n {"a": "1"},\n {"a": "2"}\n]')
    assert files.read_landed(spark, [str(tmp_path / "pages")], "a STRING").count() == 4


def test_an_object_in_place_of_the_list_gives_no_rows(spark):
    pages = spark.createDataFrame([('[{"p": 1}, {"a": "x"}]', '{"d": {"a": "x"}}'), ('[{}, [{"a": "y"}]]', '{"d": [{"a": "y"}]}')], "m string, k string")
    assert [r["a"] for r in envelopes.records_of_meta_pages(pages, "m", "a STRING").collect()] == ["y"]
    assert [r["a"] for r in envelopes.records_of_keyed_pages(pages, "k", "d", "a STRING").collect()] == ["y"]
