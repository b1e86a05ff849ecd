"""Writes, merges, landing and the file stream."""

import json

import pytest
from pyspark.sql import functions as F

from panelwright import session
from panelwright.operators import audit, landing, sinks
from panelwright.plans import queries
from panelwright.plans.given_tables import table
from panelwright.sources.files import read_json_lines, read_table
from panelwright.streaming import landing as stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, schema="k int, year int, v string"):
    return spark.createDataFrame(data, schema)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_path(spark, "x").startswith(f"{configured}/panelwright/x-")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")
    assert rows(session.stored(frame(spark, [(1, 2, "a")]), "t")) == [(1, 2, "a")]


def test_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(frame(spark, [(1, 2000, "a"), (2, 2001, "b")]), path, partition_cols=["year"])
    sinks.write_table(frame(spark, [(3, 2001, "c")]), path, mode=sinks.APPEND, partition_cols=["year"])
    assert rows(read_table(spark, path).select("k")) == [(1,), (2,), (3,)]
    sinks.write_table(frame(spark, [(9, 2001, "z")]), path, mode=sinks.OVERWRITE_PARTITIONS, partition_cols=["year"], rebalance=True)
    assert rows(read_table(spark, path).select("k")) == [(1,), (9,)]
    sinks.write_table(frame(spark, [(5, 2005, "e")]), path, partition_cols=["year"])
    assert rows(read_table(spark, path).select("k")) == [(5,)]
    for bad in (dict(mode=sinks.MERGE), dict(mode=sinks.OVERWRITE_PARTITIONS)):
        with pytest.raises(ValueError):
            sinks.write_table(frame(spark, []), path, **bad)


def test_keyed_merge_is_idempotent(spark):
    current = frame(spark, [(1, 2000, "a"), (2, 2000, "b")])
    batch = frame(spark, [(2, 2000, "B"), (3, 2000, "C")])
    once = sinks.keyed_merge(current, batch, ["k"])
    assert rows(once) == [(1, 2000, "a"), (2, 2000, "B"), (3, 2000, "C")]
    assert rows(sinks.keyed_merge(once, batch, ["k"])) == rows(once)


def test_latest_per_key(spark):
    df = frame(spark, [(1, 2000, "old"), (1, 2001, "new"), (2, 1999, None)])
    assert rows(sinks.latest_per_key(df, ["k"], "year")) == [(1, 2001, "new"), (2, 1999, None)]


def test_merge_partitions_touches_only_what_it_must(spark, tmp_path):
    path = tmp_path / "t"
    sinks.merge_partitions(spark, str(path), frame(spark, [(1, 2000, "a"), (2, 2000, "b"), (3, 2001, "c")]), ["k", "year"], ["year"])
    untouched = sorted(f.name for f in (path / "year=2001").iterdir())
    for _ in range(2):
        sinks.merge_partitions(spark, str(path), frame(spark, [(2, 2000, "B"), (4, 2002, "D")]), ["k", "year"], ["year"])
        got = read_table(spark, str(path)).select("k", "year", "v")
        assert rows(got) == [(1, 2000, "a"), (2, 2000, "B"), (3, 2001, "c"), (4, 2002, "D")]
    assert sorted(f.name for f in (path / "year=2001").iterdir()) == untouched
    with pytest.raises(ValueError, match="part of the merge key"):
        sinks.merge_partitions(spark, str(path), frame(spark, []), ["k"], ["year"])


def test_schema_evolution(spark, tmp_path):
    a, b = frame(spark, [(1, "x")], "k int, v string"), frame(spark, [(2, 5)], "k int, n int")
    assert rows(sinks.append_evolving(a, b)) == [(1, "x", None), (2, None, 5)]
    path = str(tmp_path / "t")
    sinks.write_table(a, path)
    sinks.write_table(b, path, mode=sinks.APPEND)
    assert set(read_table(spark, path, merge_schema=True).columns) == {"k", "v", "n"}


def test_persist_counts_rows_and_skips_empty_models(spark, tmp_path):
    path = str(tmp_path / "m")
    record = sinks.persist_model(frame(spark, [(1, 2000, "a"), (2, 2001, "b")]), "M", path, "r", partition_cols=["year"])
    assert (record["status"], record["record_count"], record["output_path"], record["model"]) == ("COMPLETED", 2, path, "M")
    skipped = sinks.persist_model(frame(spark, []), "E", str(tmp_path / "e"), "r")
    assert (skipped["status"], skipped["record_count"], skipped["output_path"]) == ("SKIPPED", 0, "N/A")
    assert not (tmp_path / "e").exists()


def test_landing_twice_changes_nothing(spark, tmp_path):
    path, ledger = str(tmp_path / "land"), str(tmp_path / "ledger")
    def batch(values, run):
        df = frame(spark, [(v,) for v in values], "v int")
        return landing.as_batch(df, F.lit("SRC"), F.lit("2025-09-20"), F.lit("d"), F.format_string("%08d", "v"), run)
    def landed():
        return read_json_lines(spark, path, batch([0], "r").schema)
    assert landing.read_ledger(spark, ledger).count() == 0
    landing.land(batch([1, 1, 2], "r1"), path, ledger)
    for run in ("r2", "r3"):
        fresh = landing.not_yet_landed(batch([2, 3, 3], run), landing.read_ledger(spark, ledger), landing.BATCH)
        landing.land(fresh, path, ledger)
        assert rows(landed().select("v", "run_id")) == [(1, "r1"), (1, "r1"), (2, "r1"), (3, "r2"), (3, "r2")]
    landing.land(batch([1, 1], "r9"), path, ledger)  # repeated after a crash: the folder is replaced
    assert landed().count() == 5
    assert rows(landing.read_ledger(spark, ledger).select("config_hash")) == [("00000001",), ("00000002",), ("00000003",)]
    assert (tmp_path / "land" / "source=src" / "ingest_date=2025-09-20").is_dir()


def events_file(folder, name, events):
    (folder / name).write_text("\n".join(json.dumps(dict(zip("kyv", e))) for e in events))


def test_stream_takes_new_files_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    def drain():
        stream.drain(stream.new_files(spark, str(source), "k INT, y INT, v STRING", files_per_batch=1), checkpoint, stream.append_sink(out))
        return rows(read_table(spark, out).select("k", "v"))
    events_file(source, "1.json", [(1, 0, "a"), (2, 0, "b")])
    events_file(source, "2.json", [(3, 0, "c")])
    assert drain() == drain() == [(1, "a"), (2, "b"), (3, "c")]
    events_file(source, "3.json", [(4, 0, "d")])
    assert drain() == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_replayed_append_batch_replaces_itself(spark, tmp_path):
    sink = stream.append_sink(str(tmp_path / "out"))
    for _ in range(2):
        sink(frame(spark, [(1, 2000, "a")]), 0)
        sink(frame(spark, [(2, 2000, "b")]), 1)
    assert rows(read_table(spark, str(tmp_path / "out")).select("k")) == [(1,), (2,)]


def test_upsert_sink_keeps_the_newest_row_of_each_batch(spark, tmp_path):
    path = str(tmp_path / "out")
    sink = stream.upsert_sink(path, ["k", "year"], "v", ["year"])
    sink(frame(spark, [(1, 2000, "a"), (1, 2000, "b"), (2, 2000, "c")]), 0)
    for _ in range(2):
        sink(frame(spark, [(1, 2000, "d"), (3, 2001, "e")]), 1)
    assert rows(read_table(spark, path).select("k", "year", "v")) == [(1, 2000, "d"), (2, 2000, "c"), (3, 2001, "e")]


def test_merge_keeps_rows_of_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.merge_partitions(spark, path, frame(spark, [(1, None, "a"), (2, 2000, "b")]), ["k", "year"], ["year"])
    sinks.merge_partitions(spark, path, frame(spark, [(3, None, "c"), (1, None, "A")]), ["k", "year"], ["year"])
    got = sorted(map(repr, map(tuple, read_table(spark, path).select("k", "year", "v").collect())))
    assert got == sorted(map(repr, [(1, None, "A"), (2, 2000, "b"), (3, None, "c")]))


@pytest.mark.parametrize("most", [500, 0])
def test_merge_reads_touched_combinations_only(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(sinks, "MOST_FOLDERS", most)
    path = tmp_path / "t"
    start = spark.createDataFrame([(k, k % 2, k % 3) for k in range(12)], "k int, a int, b int")
    sinks.merge_partitions(spark, str(path), start, ["k", "a", "b"], ["a", "b"])
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    batch = spark.createDataFrame([(100, 0, 0), (101, 1, 2)], "k int, a int, b int")
    sinks.merge_partitions(spark, str(path), batch, ["k", "a", "b"], ["a", "b"])
    kept = {f for f in path.rglob("*.parquet") if before.get(f) == f.stat().st_mtime_ns}
    assert {f.parent.relative_to(path).as_posix() for f in kept} == {"a=0/b=1", "a=0/b=2", "a=1/b=0", "a=1/b=1"}
    assert read_table(spark, str(path)).count() == 14


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_late_rows_do_not_replace_newer_ones(spark, tmp_path, files_per_batch):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for k, order in enumerate((9, 3, 5)):
        rows_of = [(1, "x", order), (2 + k, "x", order)]
        spark.createDataFrame(rows_of, "k int, p string, n int").coalesce(1).write.mode("append").parquet(folder)
    source = stream.new_files(spark, folder, "k int, p string, n int", "parquet", files_per_batch)
    stream.drain(source, str(tmp_path / "c"), stream.upsert_sink(path, ["k", "p"], "n", ["p"]))
    assert rows(read_table(spark, path).select("k", "p", "n")) == [(1, "x", 9), (2, "x", 9), (3, "x", 3), (4, "x", 5)]


def test_a_model_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for frame_ in batches:
            seen.add(len(frame_))
            yield frame_

    df = frame(spark, [(k, 2000, "a") for k in range(50)]).mapInPandas(count, "k int, year int, v string")
    record = sinks.persist_model(df, "M", str(tmp_path / "m"), "r")
    assert record["record_count"] == 50 and seen.value == 50


def test_files_per_folder_do_not_follow_the_tasks(spark, tmp_path):
    for tasks in (2, 16):
        df = spark.range(400).selectExpr("int(id) as k", "int(id % 3) as p").repartition(tasks)
        sinks.write_table(df, str(tmp_path / str(tasks)), partition_cols=["p"])
        assert len(list((tmp_path / str(tasks)).rglob("*.parquet"))) == 3


def test_events_of_the_upsert_land_through_many_tasks(spark, tmp_path, monkeypatch):
    events = table(spark, "/root/testdata/sf0.001", "events")
    nameless = events.limit(1).select(*[
        F.lit({"event_id": None, "event_type": "nameless"}[c]).cast(t).alias(c) if c in ("event_id", "event_type") else c
        for c, t in events.dtypes
    ])
    events.repartition(4).unionByName(nameless).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    monkeypatch.setattr(queries, "fresh_path", lambda _, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    found = queries.incremental_upsert(spark, str(tmp_path / "sf"))
    keys = events.select("event_type", "user_id").distinct().count()
    assert found.count() == keys + 1
    assert found.where("event_id IS NULL").count() == 1
    (landed,) = tmp_path.glob("events-*")
    assert len(list(landed.glob("part-*.parquet"))) > 3


def test_a_model_is_computed_and_written_once_with_its_audit(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long")
    df = spark.range(1000).select(
        count("id").alias("id"), F.when(F.col("id") % 4 != 0, F.col("id")).alias("a"), (F.col("id") % 10).alias("k"))
    metrics = audit.write_metrics(df.columns, ["k"])
    record = sinks.persist_model(df, "m", str(tmp_path / "m"), "run", metrics=metrics)
    assert seen.value == 1000 and record["record_count"] == 1000
    assert record["metrics"] == {"nulls_0": 0, "nulls_1": 250, "nulls_2": 0, "key_estimate": 10}
    rows = audit.audit_of_writes(spark, [record], {"m": df.columns}).collect()
    assert [(r["column_name"], r["null_count"], r["keys_repeat"]) for r in rows] == [("id", 0, True), ("a", 250, True), ("k", 0, True)]
    assert [p.name for p in tmp_path.iterdir()] == ["m"]
    empty = sinks.persist_model(df.where("id < 0"), "m", str(tmp_path / "m"), "run")
    assert empty["status"] == "SKIPPED" and spark.read.parquet(str(tmp_path / "m")).count() == 1000
    assert [p.name for p in tmp_path.iterdir()] == ["m"]


def test_a_model_that_fails_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.persist_model(spark.range(5), "m", path, "run")
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.persist_model(broken, "m", path, "run")
    assert spark.read.parquet(path).count() == 5


def test_partitions_are_exchanged_folder_by_folder(spark, tmp_path):
    path, new = str(tmp_path / "t"), str(tmp_path / "new")
    rows = [(1, 1, "old"), (1, 2, "old"), (2, 1, "old"), (None, 1, "old")]
    spark.createDataFrame(rows, "a INT, b INT, v STRING").write.partitionBy("a", "b").parquet(path)
    changed = [(1, 2, "new"), (3, 1, "new"), (None, 1, "new")]
    spark.createDataFrame(changed, "a INT, b INT, v STRING").write.partitionBy("a", "b").parquet(new)
    sinks.replace_partitions(spark, new, path, 2)
    assert sorted(map(repr, spark.read.parquet(path).select("a", "b", "v").collect())) == sorted(
        f"Row(a={a}, b={b}, v='{v}')" for a, b, v in [(1, 1, "old"), (1, 2, "new"), (2, 1, "old"), (3, 1, "new"), (None, 1, "new")])
    assert not (tmp_path / "new").exists()
