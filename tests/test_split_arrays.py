"""Array files read by many tasks: no record is torn, none is lost."""

import json
from pathlib import Path

import pytest
from plan_text import executed
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from panelwright.plans import upkeep
from panelwright.sources import files, split_arrays

SETTING = "spark.sql.files.maxPartitionBytes"
ODD = [
    {"k": 1, "s": "plain"}, {"k": 2, "s": "braces } { ] [ }}}"}, {"k": 3, "s": 'quotes " and \\" and \\\\'},
    {"k": 4, "s": "ends with \\"}, {"k": 5, "s": "}"}, {"k": 6, "s": '"}'}, {"k": 7, "s": "ü 日本 🙂 }"}, {},
    {"k": 8, "s": "x" * 500, "t": {"a": [1, {"b": "]}"}, []], "c": {}}}, {"k": 9, "s": None, "t": {"a": [], "c": {"d": "{"}}},
    {"k": 10, "s": "line\nbreak\t}"},
]


@pytest.fixture
def small_splits(spark):
    spark.conf.set(SETTING, "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset(SETTING)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(spark, path):
    rows = split_arrays.array_records(spark, str(path)).collect()
    return [json.loads(r["text"]) for r in sorted(rows, key=lambda r: (r["file"], r["record"]))]


@pytest.mark.parametrize("layout, size", [({}, 33), ({"indent": 2}, 80), ({"separators": (",", ":")}, 1 << 20)])
def test_records_at_any_split_size(spark, small_splits, tmp_path, layout, size):
    spark.conf.set(SETTING, str(size))
    (tmp_path / "a.json").write_text(json.dumps(ODD, ensure_ascii=False, **layout))
    assert records(spark, tmp_path / "a.json") == ODD


def test_many_files_one_object_and_odd_ends(spark, small_splits, tmp_path):
    texts = {
        "a": json.dumps(ODD), "b": "[]", "c": "", "d": json.dumps(ODD[1]), "e": " \n [ \n" + json.dumps(ODD[2]) + " \n ] \n ",
        "f": '[{"k": 1}, 5, null, "x", {"k": 2}]', "g": '[{"k": 1}, {"k": 2, "s": "cut',
        "h": '[{"k": 1}, {"k": 2, "t": {"a": 1}', "i": '{"k": 1}',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = split_arrays.array_records(spark, str(tmp_path)).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["record"]):
        found.setdefault(r["file"][-6], []).append(json.loads(r["text"]))
    assert found == {
        "a": ODD, "d": [ODD[1]], "e": [ODD[2]], "f": [{"k": 1}, {"k": 2}], "g": [{"k": 1}], "h": [{"k": 1}], "i": [{"k": 1}],
    }


def test_same_rows_as_the_reader_of_whole_files(spark, small_splits, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(ODD))
    schema = "k INT, s STRING, t STRUCT<c: MAP<STRING, STRING>>"
    whole = files.read_json_array(spark, str(tmp_path), schema)
    split = split_arrays.read_split_array(spark, str(tmp_path), schema)
    assert split.schema == whole.schema and sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    spark.conf.set(SETTING, "16384")
    path = upkeep.one_array_file(spark, "/root/testdata/sf0.001")
    pieces = split_arrays._pieces(spark, [path])
    tasks = pieces.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 2 * sum(r["count"] for r in tasks) / len(tasks)


@pytest.mark.parametrize("pieces", [1, 2, 7])
@pytest.mark.parametrize("size", ["80", "1048576"])
def test_records_over_borders_of_blocks(spark, small_splits, tmp_path, monkeypatch, pieces, size):
    monkeypatch.setattr(split_arrays, "BLOCK_PIECES", pieces)
    spark.conf.set(SETTING, size)
    cut = json.dumps(ODD + ODD)[:-9]
    (tmp_path / "a.json").write_text(json.dumps(ODD + ODD, ensure_ascii=False))
    (tmp_path / "b.json").write_text(cut)
    assert records(spark, tmp_path) == ODD + ODD + ODD + ODD[:-1]


def test_a_large_split_is_put_in_order_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split_arrays, "BLOCK_PIECES", 64)
    monkeypatch.setattr(split_arrays, "TASK_BYTES", 4096)
    (tmp_path / "a.json").write_text(json.dumps([{"k": k} for k in range(2000)]))
    pieces = split_arrays._pieces(spark, [str(tmp_path)])
    assert pieces.select("file", "split").distinct().count() == 1
    assert pieces.groupBy(*split_arrays._BLOCK).count().agg(F.max("count")).first()[0] == 64
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert split_arrays._tasks(pieces) == 40
        assert [r["k"] for r in records(spark, tmp_path)] == list(range(2000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(most))
    monkeypatch.setattr(split_arrays, "TASK_BYTES", 1 << 20)
    assert split_arrays._tasks(pieces) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("n", [0, 1, 50])
def test_the_array_file_is_written_without_sorting(spark, tmp_path, monkeypatch, n):
    rows = [(k, None, k % 4, ["view", "error", "signup"][k % 3], None if k % 5 == 0 else k / 2, '{"k": %d}' % k) for k in range(n)]
    schema = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    written, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: (written.append(executed(self._df)), text(self, path))[1])
    path = upkeep.one_array_file(spark, str(tmp_path))
    assert len(written) == 1 and "Sort" not in written[0]
    (file,) = Path(path).glob("part-*")
    found = json.loads(file.read_text())
    lines = [json.loads(x) for x in upkeep.raw_indicators(spark, str(tmp_path)).toJSON().collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, [{}, *lines])) and len(found) == n + 1
