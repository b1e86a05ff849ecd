"""Table writes: modes, partitioning, keyed merge, and persistence with a result record."""

import json
import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.session import stored

APPEND, OVERWRITE, MERGE, OVERWRITE_PARTITIONS = "append", "overwrite", "merge", "overwrite_partitions"


MOST_FOLDERS = 500  # that a merge names in its filter


def table_path(base: str, layer: str, model: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{model}"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = OVERWRITE,
    partition_cols: list[str] | None = None,
    options: dict | None = None,
    rebalance: bool = True,
) -> None:
    """Write by location. ``overwrite_partitions`` replaces only the partitions in ``df``.

    A MERGE is a plan, not a file mode: see ``keyed_merge`` and ``merge_partitions``.
    With partition columns ``rebalance`` exchanges rows by partition first, so that not
    every task writes a small file into every folder; Spark splits a folder that is too
    big for one task.
    """
    if mode not in (APPEND, OVERWRITE, OVERWRITE_PARTITIONS):
        raise ValueError(f"not a write mode of files: {mode}")
    if rebalance and partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.format(fmt).options(**(options or {}))
    if mode == OVERWRITE_PARTITIONS:
        if not partition_cols:
            raise ValueError("overwrite_partitions needs partition columns")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        mode = OVERWRITE
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.mode(mode).save(path)


def append_evolving(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; a column that one side lacks is NULL there."""
    return current.unionByName(batch, allowMissingColumns=True)


def latest_per_key(batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the one with the highest ``order``.

    An aggregation with partial combine, not a window: a hot key leaves each task
    as one row.
    """
    quoted = [f"`{k}`" for k in keys]
    rest = [F.col(f"`{c}`") for c in batch.columns if c not in keys and c != order]
    picked = batch.groupBy(*quoted).agg(F.max(F.struct(F.col(f"`{order}`"), *rest)).alias("_row"))
    return picked.select(*quoted, "_row.*").select(*[f"`{c}`" for c in batch.columns])


def equal(left: DataFrame, right: DataFrame, columns: list[str]):
    """Rows that agree in the columns; NULL agrees with NULL."""
    return reduce(lambda x, y: x & y, [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in columns])


def keyed_merge(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows replace current rows of the same key; other current rows stay.

    Applying a batch twice changes nothing. A NULL in a key is a value like any other.
    Keys must be unique in the batch (``latest_per_key``). The result goes to a fresh path:
    a file table must not be overwritten while it is read.
    """
    present = batch.select(*[F.col(f"`{k}`").alias(k) for k in keys])
    kept = current.join(present, equal(current, present, keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def of_partitions(current: DataFrame, batch: DataFrame, partition_cols: list[str]) -> DataFrame:
    """The rows of the partitions that the batch has rows in; a scan skips the other folders.

    Up to ``MOST_FOLDERS`` of them are a literal filter, more are joined.
    """
    touched = batch.select(*[F.col(f"`{c}`").alias(c) for c in partition_cols]).distinct()
    folders = touched.limit(MOST_FOLDERS + 1).collect()
    if len(folders) > MOST_FOLDERS:
        return current.join(touched, equal(current, touched, partition_cols), "left_semi")
    same = [
        reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.lit(r[c])) for c in partition_cols]) for r in folders
    ]
    return current.filter(reduce(lambda x, y: x | y, same, F.lit(False)))


def merge_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition_cols: list[str],
    order: str | None = None,
) -> None:
    """Merge into a stored partitioned table, rewriting only the partitions the batch touches.

    The partition columns must be part of the key, so that no row changes partition; NULL
    is a partition of its own. The touched combinations (folders, which the driver lists in
    any case) become a literal filter, so that the scan skips all other folders; beyond
    ``MOST_FOLDERS`` of them they are joined. A table that is not there yet starts with the
    batch. Without ``order`` the batch wins over what is stored; with it the row with the
    highest ``order`` wins, whichever came first.

    The batch is evaluated once. The new content of the partitions is written once, beside the
    table, and each folder takes its place by renaming. A plain file table has no transactions,
    though: a reader meanwhile sees some folders new and others old, or for a moment missing,
    and after a driver was lost in it the merge is repeated. Table formats with row-level
    updates have ``merge_into``.
    """
    if not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    batch = stored(batch, "merge-batch")
    current = stored_table(spark, path)
    if current is None:
        merged = batch if order is None else latest_per_key(batch, keys, order)
    else:
        current = of_partitions(current, batch, partition_cols)
        if order is None:
            merged = keyed_merge(current, batch, keys)
        else:
            merged = latest_per_key(current.unionByName(batch, allowMissingColumns=True), keys, order)
    beside = _beside(path)
    write_table(merged, beside, partition_cols=partition_cols)
    replace_partitions(spark, beside, path, len(partition_cols))


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if it does not exist or has no files yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return None
        raise


def merge_into(batch: DataFrame, table: str, keys: list[str]) -> None:
    """Merge through a catalog table whose format supports row-level updates."""
    target = table.split(".")[-1]
    on = " AND ".join(f"{target}.`{k}` = batch.`{k}`" for k in keys)
    (
        batch.alias("batch").mergeInto(table, F.expr(on))
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )


def persist_model(
    df: DataFrame,
    name: str,
    path: str,
    run_id: str,
    fmt: str = "parquet",
    partition_cols: list[str] | None = None,
    options: dict | None = None,
    metrics: list[Column] | None = None,
) -> dict:
    """Write a model and return its result record; an empty model is skipped, not written.

    The row count is observed during the write, and so are further ``metrics`` (aggregates with
    names, see ``audit.write_metrics``), which the record has under ``metrics``: the model is
    computed once and written once, into a folder beside its place that takes that place when
    it is complete. What is stored stays if the model turns out to be empty.
    """
    started = time.monotonic()
    record = {
        "model": name, "status": contract.SKIPPED, "output_path": "N/A", "correlation_id": run_id,
        "operation_type": "N/A", "record_count": 0, "error_details": None, "duration_in_ms": 0,
    }
    rows = Observation(f"rows of {name}")
    beside = _beside(path)
    observed = df.observe(rows, F.count(F.lit(1)).alias("n"), *(metrics or []))
    write_table(observed, beside, fmt, OVERWRITE, partition_cols, options)
    found = dict(rows.get)
    if found.pop("n"):
        replace_folder(df.sparkSession, beside, path)
        record.update(
            status=contract.COMPLETED, output_path=path, operation_type="OVERWRITE", record_count=rows.get["n"],
        )
    else:
        files, place = _file_system(df.sparkSession, beside)
        files.delete(place, True)
    if metrics:
        record["metrics"] = found
    record["duration_in_ms"] = int((time.monotonic() - started) * 1000)
    return record


def _beside(path: str) -> str:
    """A fresh path next to another one, hidden from readers of their common folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, whatever store it is in, and the path as its object."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """The complete folder ``new`` takes the place of ``path``, by renaming within one store.

    The old folder is set aside first and deleted last: whatever moment a driver is lost in,
    one of both is there as a whole.
    """
    files, target = _file_system(spark, path)
    source, old = _file_system(spark, new)[1], _file_system(spark, _beside(path))[1]
    had = files.exists(target)
    if had and not files.rename(target, old):
        raise OSError(f"cannot set aside {path}")
    if not files.mkdirs(target.getParent()) or not files.rename(source, target):
        if had:
            files.rename(old, target)
        raise OSError(f"cannot rename {new} to {path}")
    if had:
        files.delete(old, True)


def replace_partitions(spark: SparkSession, new: str, path: str, levels: int) -> None:
    """Each partition folder of ``new``, so many levels deep, takes the place of that of ``path``."""
    files, root = _file_system(spark, new)

    def folders(place, depth: int) -> list[str]:
        if not depth:
            return [place.toString()]
        below = [s.getPath() for s in files.listStatus(place) if s.isDirectory() and "=" in s.getPath().getName()]
        return [f for folder in below for f in folders(folder, depth - 1)]

    base = files.makeQualified(root).toString()
    for folder in folders(files.makeQualified(root), levels):
        replace_folder(spark, folder, f"{path.rstrip('/')}{folder.removeprefix(base)}")
    files.delete(root, True)


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """Store a run summary (one small JSON object) next to the tables it describes."""
    spark.createDataFrame([(json.dumps(summary),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
