"""Indicators side by side on the entity-by-year grid."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (frame with the key columns, its measure columns)
Inputs = list[tuple[DataFrame, list[str]]]


def panel_by_union(grid: DataFrame, inputs: Inputs, keys: list[str]) -> DataFrame:
    """Grid and inputs stacked, then one aggregation by key, without sorting any of them.

    Every row is exchanged once: an input that comes out of a ``groupBy`` on the keys
    is partitioned by them already, the grid is partitioned here, and the union of
    equally partitioned frames keeps the partitioning, so the aggregation needs no
    exchange of its own. Partition a raw input with ``repartition(*keys)`` to have
    the same; with one input that is partitioned otherwise, all are exchanged again.

    Each input must have one row per key. A second row fails the job with a clear
    error instead of multiplying rows; the check rides on the same aggregation.
    """
    quoted = [f"`{k}`" for k in keys]
    stacked = [grid.select(*quoted).repartition(*quoted).withColumn("_on_grid", F.lit(1))]
    for i, (frame, measures) in enumerate(inputs):
        stacked.append(frame.select(*quoted, *measures, F.lit(1).alias(f"_rows_{i}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)

    measures = [m for _, columns in inputs for m in columns]
    merged = (
        rows.groupBy(*quoted)
        .agg(
            F.max("_on_grid").alias("_on_grid"),
            *[F.max(m).alias(m) for m in measures],
            *[F.count(f"_rows_{i}").alias(f"_rows_{i}") for i in range(len(inputs))],
        )
        .filter(F.col("_on_grid") == 1)
    )
    checked = []
    for i, (frame, columns) in enumerate(inputs):
        for m in columns:
            complaint = F.raise_error(F.lit(f"more than one row per key for '{m}'"))
            value = F.when(F.col(f"_rows_{i}") <= 1, F.col(m))
            checked.append(value.otherwise(complaint.cast(frame.schema[m].dataType)).alias(m))
    return merged.select(*quoted, *checked)


def panel_by_joins(grid: DataFrame, inputs: Inputs, keys: list[str]) -> DataFrame:
    """The same panel as a chain of left joins; repeated keys in an input multiply rows."""
    quoted = [f"`{k}`" for k in keys]
    joined = grid
    for frame, measures in inputs:
        joined = joined.join(frame.select(*quoted, *measures), keys, "left")
    return joined
