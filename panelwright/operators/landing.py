"""Raw landing that can be repeated safely."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.sinks import APPEND, OVERWRITE_PARTITIONS, stored_table, write_table
from panelwright.session import stored

# Folders of the landing area, outermost first; a batch is one innermost folder.
BATCH = ["source", "ingest_date", "dataset", "config_hash"]


def as_batch(
    records: DataFrame, source: Column, day: Column, dataset: Column, config_hash: Column, run_id: str
) -> DataFrame:
    """Records with their landing coordinates and the run that brought them."""
    return records.select(
        "*",
        F.lower(source).alias("source"),
        day.alias("ingest_date"),
        dataset.alias("dataset"),
        config_hash.alias("config_hash"),
        F.lit(run_id).alias("run_id"),
    )


def batch_folder(path: str, source: str, day: str, dataset: str, config_hash: str) -> str:
    """The folder of one batch; its coordinates are plain words, dates and hex digits."""
    values = (source.lower(), day, dataset, config_hash)
    return "/".join([path, *[f"{name}={value}" for name, value in zip(BATCH, values)]])


def not_yet_landed(batch: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the ledger does not list.

    The ledger side is reduced to distinct keys first. If it is too big to
    broadcast, the join sorts both sides, and adaptive execution splits a batch
    partition that one hot key fills.
    """
    return batch.join(ledger.select(*keys).distinct(), keys, "left_anti")


def land(batch: DataFrame, path: str, ledger: str, fmt: str = "json") -> None:
    """Write each batch into its own folder as splittable lines, then note it in the ledger.

    Landing the same batch again replaces its folder, so a run that died between the
    two steps can simply be repeated. The ledger is a small table of its own, so
    that looking up what is there never scans the landed records. The batch is evaluated
    once, so the ledger lists exactly what was landed, even from a source that changes.
    """
    batch = stored(batch, "landing")
    write_table(batch, path, fmt, OVERWRITE_PARTITIONS, BATCH)
    write_table(batch.select(*BATCH).distinct(), ledger, mode=APPEND)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What has been landed, one row per batch; empty before the first landing."""
    known = stored_table(spark, ledger)
    if known is None:
        return spark.createDataFrame([], ", ".join(f"{c} STRING" for c in BATCH))
    return known.distinct()
