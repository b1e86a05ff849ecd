"""File and table scans. A list of paths is always one scan, never a loop of unions."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Formats that can be read by name; the first two also by file extension.
EXTENSION_FORMAT = {".json": "json", ".csv": "csv"}
FORMATS = ("json", "csv", "binaryFile", "parquet", "delta")

Paths = str | list[str]
Schema = StructType | str  # a DDL string will do


def read_csv(spark: SparkSession, paths: Paths, schema: Schema | None = None) -> DataFrame:
    """CSV with a header row; all strings unless a schema is given (no inference pass)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def read_json_array(spark: SparkSession, paths: Paths, schema: Schema) -> DataFrame:
    """Files that each hold one JSON array; one row per element.

    Such a file cannot be split: one task parses it. Keep files at page size, or
    land them once as JSON lines (``operators.landing``) and read those.
    """
    return spark.read.option("multiline", True).schema(schema).json(paths)


def read_json_lines(spark: SparkSession, paths: Paths, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line; splittable. Without a schema Spark scans the files to infer it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def read_landed(spark: SparkSession, paths: Paths, schema: Schema) -> DataFrame:
    """JSON records in files or folders of either layout, whatever they are called.

    A path whose text begins with ``[`` holds one array per file, any other one an object per
    line. The first line that is not blank decides (one short look per path, and a folder has
    one layout); names and suffixes do not.
    """
    arrays, lines = by_layout(spark, paths)
    scans = []
    if arrays:
        scans.append(read_json_array(spark, arrays, schema))
    if lines:
        scans.append(read_json_lines(spark, lines, schema))
    return scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])


def by_layout(spark: SparkSession, paths: Paths) -> tuple[list[str], list[str]]:
    """The paths whose text begins with ``[``, and the others."""
    paths = [paths] if isinstance(paths, str) else paths
    arrays = [p for p in paths if _first_line(spark, p).startswith("[")]
    return arrays, [p for p in paths if p not in arrays]


def _first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).select(F.ltrim("value").alias("line")).where("line <> ''").first()
    return "" if row is None else row["line"].lstrip("\ufeff")


def read_table(
    spark: SparkSession, paths: Paths, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """A stored table by location. ``merge_schema`` reads all footers, so ask for it only when needed."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown table format: {fmt}")
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(paths)


def format_of(path: str) -> str:
    """Format name for a file path; anything but .json and .csv is rejected."""
    extension = os.path.splitext(path)[1].lower()
    if extension not in EXTENSION_FORMAT:
        raise ValueError(f"unsupported file extension '{extension}' of '{path}'")
    return EXTENSION_FORMAT[extension]


def read_by_extension(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    if format_of(path) == "csv":
        return read_csv(spark, path, schema)
    if schema is not None:
        return read_landed(spark, path, schema)
    return read_json_lines(spark, path)


def read_named(
    spark: SparkSession, locations: dict[str, str], name: str, schema: Schema | None = None
) -> DataFrame | None:
    """Look a dataset up by name and read it by extension; None when it is not listed."""
    path = locations.get(name)
    return None if path is None else read_by_extension(spark, path, schema)


def with_lineage(df: DataFrame, run_id: str, source_file: bool = False) -> DataFrame:
    """Stamp every row with the run and, on a file scan, with the file it came from."""
    stamped = df.withColumn("run_id", F.lit(run_id))
    if source_file:
        stamped = stamped.withColumn("source_file", F.col("_metadata.file_path"))
    return stamped
