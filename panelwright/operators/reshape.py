"""Wide to long, nested to flat, and the entity-by-year grid."""

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def year_columns(df: DataFrame) -> list[str]:
    """Columns whose name is four digits."""
    return [name for name in df.columns if re.fullmatch(r"[0-9]{4}", name)]


def unpivot_years(df: DataFrame, ids: list[str], value: str, year: str = "year") -> DataFrame:
    """One row per id and year column. A narrow step: rows multiply in place, nothing shuffles."""
    quoted = [F.col(f"`{name}`") for name in ids]
    values = [F.col(f"`{name}`") for name in year_columns(df)]
    return df.unpivot(quoted, values, year, value).withColumn(year, F.col(year).cast("int"))


def explode_rows(df: DataFrame, array: str, alias: str) -> DataFrame:
    """One row per array element; an empty or NULL array drops its row."""
    return df.withColumn(alias, F.explode(array))


def year_range(spark: SparkSession, first: int, last: int | None = None) -> DataFrame:
    """Consecutive years up to ``last`` (default: the current year) with ``year_id`` from 0."""
    last = datetime.date.today().year if last is None else last
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return _numbered(years, F.lit(first))


def year_range_of(df: DataFrame, year: str) -> DataFrame:
    """Consecutive years from the first to the last one in the data."""
    span = df.agg(F.min(year).alias("first"), F.max(year).alias("last"))
    years = span.select("first", F.explode(F.sequence("first", "last")).alias("year"))
    return _numbered(years, F.col("first"))


def _numbered(years: DataFrame, first) -> DataFrame:
    return years.select("year", (F.col("year") - first).cast("long").alias("year_id"))


def scaffold(entities: DataFrame, entity: str, years: DataFrame, year: str = "year") -> DataFrame:
    """Every entity with every year, so that a missing observation is a row of NULLs.

    The years form one array (a scalar subquery; calendar years, so its size is
    bounded) that each entity row explodes: no cross join, no shuffle of entities.
    """
    all_years = years.agg(F.array_sort(F.collect_set(year))).scalar()
    return entities.select(f"`{entity}`", F.explode(all_years).alias(year))
