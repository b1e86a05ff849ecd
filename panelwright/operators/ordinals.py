"""Positions in a total order, without a window over the whole."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.session import stored

_PART_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def positions(df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None) -> DataFrame:
    """The rows with the position (from 0) that each has in the order, as a stored table.

    Rows are exchanged by ranges of the order, sorted and counted inside their partition, and
    shifted by the rows of the partitions before. A value of the leading columns that
    very many rows share is spread over partitions as long as the later columns tell its rows
    apart. Rows that are equal in all columns of the order have arbitrary, distinct positions.

    The driver sees one count per partition. The ranges come from a sample that reads ``df`` a
    first time: pass a stored table. ``partitions`` defaults to the session's setting.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    table = stored(ranged.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", _PART_BITS).cast("int")
    sizes = dict(table.groupBy(part).count().collect())
    shifts, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        shifts.append(total - (k << _PART_BITS))
        total += sizes.get(k, 0)
    # One constant that is parsed once, however many partitions there are.
    shift = F.split(F.lit(",".join(map(str, shifts or [0]))), ",").cast("array<bigint>")[part]
    return table.withColumn(name, F.col("_at") + shift).drop("_at")
