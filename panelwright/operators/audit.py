"""Run results as rows: counts per table, and the status of a whole run."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import contract


def table_audit(df: DataFrame, name: str, keys: list[str], run_id: str) -> DataFrame:
    """One row: row count, distinct keys, and NULL count per column.

    The counts are a global aggregate without a shuffle; only the key columns are
    read again and exchanged, each task sending its distinct keys.
    """
    quoted = [f"`{k}`" for k in keys]
    null_counts = F.create_map(*[
        part for c in df.columns for part in (F.lit(c), F.count_if(F.col(f"`{c}`").isNull()))
    ])
    key_count = df.select(*quoted).distinct().agg(F.count("*")).scalar()
    counts = df.agg(F.count("*").alias("row_count"), null_counts.alias("null_counts"))
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("model"),
        "row_count",
        key_count.alias("key_count"),
        "null_counts",
    )


SKETCH_BITS = 14  # of a key sketch: 2^14 registers, a standard error of 0.8 %


def write_metrics(columns: list[str], keys: list[str]) -> list[Column]:
    """Aggregates for ``sinks.persist_model``: NULLs per column, and a sketch's count of distinct keys.

    They are computed while the rows are written, so an audit reads no table again. A sketch
    says nearly how many keys there are; ``quality.duplicate_keys`` says exactly which repeat.
    """
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    sketch = F.hll_sketch_agg(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), SKETCH_BITS)
    return [*nulls, F.hll_sketch_estimate(sketch).alias("key_estimate")]


def audit_of_writes(spark: SparkSession, records: list[dict], columns: dict[str, list[str]]) -> DataFrame:
    """One row per written model and column out of the records of ``persist_model``.

    ``keys_repeat`` is True if the sketch says that there are clearly fewer keys than rows.
    """
    rows = []
    for record in records:
        found, n = record["metrics"], record["record_count"]
        repeat = found["key_estimate"] < 0.95 * n
        for i, column in enumerate(columns[record["model"]]):
            rows.append((record["correlation_id"], record["model"], n, repeat, column, found[f"nulls_{i}"]))
    schema = "run_id STRING, model STRING, row_count LONG, keys_repeat BOOLEAN, column_name STRING, null_count LONG"
    return spark.createDataFrame(rows, schema)


def audit_all(tables: dict[str, tuple[DataFrame, list[str]]], run_id: str) -> DataFrame:
    audits = [table_audit(df, name, keys, run_id) for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, audits)


def overall_status(results: Column, failed: Column, skipped: Column) -> Column:
    """Any failure fails the run, any skip makes it partial."""
    return (
        F.when(results == 0, contract.NO_RESULTS)
        .when(failed > 0, contract.FAILED)
        .when(skipped > 0, contract.PARTIAL_SUCCESS)
        .otherwise(contract.COMPLETED)
    )


def landing_summary_status(results: Column, completed: Column, skipped: Column) -> Column:
    """Rule of the landing layer's summary: skipped results are fine."""
    return F.when(completed + skipped == results, contract.COMPLETED).otherwise(contract.FAILED)


def model_summary_status(results: Column, completed: Column) -> Column:
    """Rule of the model layers' summaries: every result must have completed."""
    return F.when(completed == results, contract.COMPLETED).otherwise(contract.FAILED)


def is_success(status: Column) -> Column:
    return status.isin(contract.COMPLETED, contract.SKIPPED)


def status_rollup(
    results: DataFrame, run: str = "run_id", runs: DataFrame | None = None
) -> DataFrame:
    """One row per run with the summed task time and its status under each rule.

    ``duration_in_ms`` adds up task times, which may overlap. With ``runs`` given,
    a run without any result shows up as well.
    """
    def how_many(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    counted = results.groupBy(run).agg(
        F.count("*").alias("processed_items"),
        F.coalesce(F.sum("duration_in_ms"), F.lit(0)).cast("long").alias("duration_in_ms"),
        how_many(contract.COMPLETED).alias("_completed"),
        how_many(contract.SKIPPED).alias("_skipped"),
        how_many(contract.FAILED).alias("_failed"),
    )
    if runs is not None:
        counted = runs.select(run).distinct().join(counted, run, "left").fillna(0)
    n, done = F.col("processed_items"), F.col("_completed")
    return counted.select(
        run,
        n,
        "duration_in_ms",
        overall_status(n, F.col("_failed"), F.col("_skipped")).alias("status"),
        landing_summary_status(n, done, F.col("_skipped")).alias("landing_status"),
        model_summary_status(n, done).alias("model_status"),
    )
