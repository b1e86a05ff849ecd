"""Checks on inputs and models."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_rows(df: DataFrame | None, name: str) -> DataFrame:
    """The frame itself, or an error when it is absent or empty (one short job)."""
    if df is None or df.isEmpty():
        raise ValueError(f"missing or empty input: {name}")
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    quoted = [f"`{k}`" for k in keys]
    return df.groupBy(*quoted).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def require_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The frame itself, or an error when a key repeats (one aggregation job)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"repeated key {keys} in {name}")
    return df


def missing_inputs(required: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Required names that no completed result provides.

    Both sides are reduced to distinct names, whose exchange the join then shares;
    a name with very many results arrives as one row per task.
    """
    return required.select(key).distinct().join(completed.select(key).distinct(), key, "left_anti")


def require_inputs(required: DataFrame, completed: DataFrame, key: str, consumer: str) -> None:
    """Error that lists what is missing; the required names are one model's declared inputs."""
    absent = sorted(r[0] for r in missing_inputs(required, completed, key).collect())
    if absent:
        raise ValueError(f"[{consumer}] missing results of the previous layer: {absent}")
