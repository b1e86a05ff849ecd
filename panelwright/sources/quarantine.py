"""Records that cannot be read, set aside with their file and the reason; the others go on.

Spark's scans turn a broken record into NULLs, or stop at it. Here every line is judged on its
own while it is parsed: what is no JSON, no object, or has a value of another type than the
schema says is kept as text for whoever mends it, and never looks like data.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from panelwright.operators.sinks import OVERWRITE_PARTITIONS, stored_table, write_table
from panelwright.sources.files import Paths, Schema
from panelwright.sources.split_arrays import array_records

FILE, TEXT, REASON = "_file", "_text", "_reason"
NO_JSON, NO_OBJECT, WRONG_TYPE, WRONG_COLUMNS = "no JSON", "no object", "wrong type", "wrong columns"
_BROKEN = "_broken"


def _struct(schema: Schema) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _judged(texts: DataFrame, schema: Schema) -> DataFrame:
    """Columns of the schema with file, text and reason (NULL for a good record)."""
    whole = StructType([*_struct(schema).fields]).add(_BROKEN, StringType())
    record = F.from_json(TEXT, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    shape = F.schema_of_variant(F.try_parse_json(TEXT))
    # The shape is only looked at for records that did not parse.
    unfit = F.when(shape.isNull(), NO_JSON).when(~shape.startswith("OBJECT"), NO_OBJECT).otherwise(WRONG_TYPE)
    # Parsers stop behind the first object: what follows it shows in a list of one element.
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), TEXT, F.lit("]"))), "$", "array<variant>")
    more = ~F.rtrim(TEXT).endswith("}") | (F.col(TEXT).rlike(r"\}\s*,?\s*\{") & (F.coalesce(F.size(listed), F.lit(0)) != 1))
    reason = F.when(record.isNull() | record[_BROKEN].isNotNull(), unfit).when(more, NO_JSON)
    named = texts.select(FILE, TEXT, record.alias("_record"), reason.alias(REASON))
    return named.select(*[F.col("_record")[f.name].alias(f.name) for f in _struct(schema)], FILE, TEXT, REASON)


def checked_lines(spark: SparkSession, paths: Paths, schema: Schema) -> DataFrame:
    """JSON lines; blank lines are none."""
    texts = spark.read.text(paths).select(F.col("_metadata.file_path").alias(FILE), F.col("value").alias(TEXT))
    return _judged(texts.where(F.trim(TEXT) != ""), schema)


def checked_arrays(spark: SparkSession, paths: Paths, schema: Schema) -> DataFrame:
    """Files with one JSON array each, read by many tasks."""
    records = array_records(spark, paths).select(F.col("file").alias(FILE), F.col("text").alias(TEXT))
    return _judged(records, schema)


def checked_csv(spark: SparkSession, paths: Paths, schema: Schema) -> DataFrame:
    """CSV with a header row; a row is bad if it has too few or too many cells or a value of another type."""
    whole = StructType([*_struct(schema).fields]).add(_BROKEN, StringType())
    rows = (
        spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
        .option("columnPruning", False).schema(whole).csv(paths)
    )
    # Spark wants some other column next to the broken text; no value differs from itself.
    first = F.col(f"`{whole[0].name}`")
    reason = F.when(F.col(_BROKEN).isNotNull() | (first != first), WRONG_COLUMNS)
    return rows.select(
        *[f"`{f.name}`" for f in _struct(schema)], F.col("_metadata.file_path").alias(FILE), F.col(_BROKEN).alias(TEXT),
        reason.alias(REASON),
    )


def good(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(FILE, TEXT, REASON)


def bad(checked: DataFrame) -> DataFrame:
    """(file, reason, text) of what is set aside."""
    return checked.where(F.col(REASON).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(TEXT).alias("text")
    )


def set_aside(checked: DataFrame, path: str, run_id: str, dataset: str) -> DataFrame:
    """Writes the bad records to the quarantine table and returns the good ones.

    The table has a folder per dataset and run; a run that is repeated replaces its own.
    """
    rows = bad(checked).withColumns({"dataset": F.lit(dataset), "run": F.lit(run_id)})
    write_table(rows, path, mode=OVERWRITE_PARTITIONS, partition_cols=["dataset", "run"])
    return good(checked)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was set aside; no rows if nothing ever was."""
    found = stored_table(spark, path)
    if found is None:
        return spark.createDataFrame([], "file STRING, reason STRING, text STRING, dataset STRING, run STRING")
    return found
