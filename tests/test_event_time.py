"""Late and repeated events: what is kept depends on neither batches nor replays."""

import datetime as dt
import json
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelwright.plans import upkeep
from panelwright.streaming import event_time
from panelwright.streaming import landing as stream

SCHEMA = "k STRING, at TIMESTAMP, came TIMESTAMP, v INT"
START = dt.datetime(2024, 1, 1)


def row(key, hour, lag, v=0):
    at = None if hour is None else START + dt.timedelta(hours=hour)
    return key, at, START + dt.timedelta(hours=(hour or 0) + lag), v


DELIVERIES = [
    row("a", 0, 0), row("b", 5, 1), row("a", 0, 2), row("c", 4, 3), row("d", 1, 6), row(None, 3, 0), row("e", None, 8),
    row("f", 20, 0), row("a", 0, 21), row("c", 4, 18), row("g", 19, 3), row("g", 19, 2), row("f", 20, 3), row("h", 30, 4),
]


def delivered(spark, folder, files):
    """The deliveries in files by the order of arrival."""
    rows = sorted(DELIVERIES, key=lambda r: r[2])
    size = -(-len(rows) // files)
    for k in range(files):
        part = rows[k * size: (k + 1) * size]
        if part:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def drained(spark, folder, out, per_batch, checkpoint=None):
    source = stream.new_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, "parquet", per_batch)
    once = event_time.once_in_time(source, ["k"], "at", "came", "3 hours")
    stream.drain(once, checkpoint or f"{out}/checkpoint", event_time.split_sink(f"{out}/once", f"{out}/aside"))
    return tuple(
        sorted(tuple(r) for r in spark.read.parquet(f"{out}/{t}").select(F.coalesce("k", F.lit("")), "status").collect())
        for t in ("once", "aside")
    )


@pytest.mark.parametrize("files, per_batch", [(1, 1), (5, 1), (5, 2), (14, 1), (14, 100)])
def test_batches_change_nothing(spark, tmp_path, files, per_batch):
    folder = str(tmp_path / "in")
    delivered(spark, folder, files)
    once, aside = drained(spark, folder, str(tmp_path / "out"), per_batch)
    assert once == tuple((k, "on time") for k in "abcfg") or list(once) == [(k, "on time") for k in "abcfg"]
    assert Counter(s for _, s in aside) == {"late": 4, "no key": 1, "no time": 1}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    delivered(spark, folder, 5)
    first = drained(spark, folder, out, 1)
    # As after a failure between the sink and the commit of the last batch.
    commits = sorted((tmp_path / "out" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    shutil.copytree(tmp_path / "out" / "checkpoint", tmp_path / "again", ignore=lambda d, names: {
        n for n in names if d.endswith("commits") and n.lstrip(".").split(".")[0] == commits[-1].name})
    assert drained(spark, folder, out, 1, str(tmp_path / "again")) == first


def test_old_keys_leave_the_state(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    delivered(spark, folder, 14)
    source = stream.new_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, "parquet", 1)
    query = (
        event_time.once_in_time(source, ["k"], "at", "came", "3 hours").writeStream
        .foreachBatch(event_time.split_sink(f"{out}/once", f"{out}/aside"))
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    progress = [json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else p for p in query.recentProgress]
    states = [s for p in progress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    assert states[-1]["numRowsTotal"] < 5


def test_sizes_of_batches_in_the_query(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    tables = [upkeep._late_events(spark, sf, n) for n in (1, 1000)]
    for one, other in zip(*tables):
        columns = ["event_id", "event_type", "value", "status"]
        assert one.select(*columns).exceptAll(other.select(*columns)).isEmpty() and one.count() == other.count()
