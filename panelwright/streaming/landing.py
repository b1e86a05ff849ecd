"""New files in a folder, processed once each, then stop.

The stream's checkpoint remembers which files were done, which replaces chaining
runs by events. A batch that is replayed after a failure gives the same table: the
append sink replaces the batch's own folder, the upsert sink keeps the newest row of each
key, so that neither the size nor the sequence of batches matters.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwright.operators.sinks import (
    OVERWRITE_PARTITIONS,
    latest_per_key,
    merge_partitions,
    write_table,
)


def new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    fmt: str = "json",
    files_per_batch: int = 1000,
    options: dict | None = None,
) -> DataFrame:
    """Stream of the folder's files; the batch size bounds what one batch holds."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(**(options or {}))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Run the stream over everything that is there, batch by batch, and stop."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_sink(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Each batch becomes the folder ``batch_id=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = prepare(batch).withColumn("batch_id", F.lit(batch_id))
        write_table(numbered, path, mode=OVERWRITE_PARTITIONS, partition_cols=["batch_id"])
    return write


def upsert_sink(
    path: str,
    keys: list[str],
    order: str,
    partition_cols: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
):
    """Each batch is merged into the partitions it touches; the newest row of a key stays.

    A row that comes late does not replace a newer one that is stored; of rows with the same
    ``order`` the one with the largest other values stays. ``order`` must be a column of the
    table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(prepare(batch), keys, order)
        merge_partitions(batch.sparkSession, path, newest, keys, partition_cols, order)
    return write
