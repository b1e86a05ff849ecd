"""Tables stored in buckets by their keys, so that later joins and aggregations find them in place.

A panel that is built again, or a table that is merged into again, exchanges its stored inputs
every time if they are plain files. Stored in buckets, rows of a key lie in one bucket, in order:
a plan on the keys reads them without exchange and without sort, and only what is new moves.

Buckets are metadata of a catalog table; its files stand at a path of their own, and a
session with another catalog declares the same table over them again (``declared``).
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def default_buckets(spark: SparkSession) -> int:
    """As many as an exchange has partitions; with fewer, Spark would rather exchange both sides."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, name: str | None = None) -> DataFrame:
    """Stores the frame at the path in buckets sorted by the keys, and reads it back as such.

    One exchange by the keys brings each bucket into one file, however many tasks made the rows.
    """
    spark = df.sparkSession
    n = buckets or default_buckets(spark)
    table = name or f"bucketed_{uuid.uuid4().hex}"
    quoted = [F.col(f"`{k}`") for k in keys]
    writer = df.repartition(n, *quoted).write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def declared(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int, name: str | None = None) -> DataFrame:
    """A table over files that ``write_bucketed`` left at the path, with the same keys and number of buckets."""
    table = name or f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY ({quoted}) SORTED BY ({quoted}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def bucketed_merge(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``sinks.keyed_merge`` for a bucketed table: only the batch is exchanged.

    Keys must not be NULL, neither in the batch, which stops the job, nor in the table, where such
    rows stay as they are; then plain equality finds the buckets. Keys must be unique in the batch.
    """
    checked = [
        F.coalesce(F.col(f"`{k}`"), F.raise_error(F.lit(f"NULL in merge key {k}")).cast(batch.schema[k].dataType)).alias(k)
        for k in keys
    ]
    kept = current.join(batch.select(*checked), keys, "left_anti").select(*[f"`{c}`" for c in current.columns])
    return kept.unionByName(batch, allowMissingColumns=True)
