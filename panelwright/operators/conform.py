"""Matching observations to an entity dimension.

No join carries a broadcast hint: Spark broadcasts a dimension when its measured
size allows and otherwise sort-merges, where adaptive execution splits the
partitions of a hot key on the observation side.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_presence(
    entities: DataFrame, entity_key: str, sources: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Add one 0/1 column per source: does the entity's key occur there?

    ``sources`` maps flag name to (frame, key column). All sources share one
    aggregation: every row becomes (key, its flag), partial aggregation reduces
    each task's rows to its distinct keys, so a hot key costs one row per task.
    """
    tagged = [
        frame.select(F.col(f"`{key}`").alias("_key"), F.lit(1).alias(flag))
        for flag, (frame, key) in sources.items()
    ]
    seen = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(*[F.max(flag).alias(flag) for flag in sources])
    )
    others = [F.col(f"`{c}`") for c in entities.columns if c not in sources]
    flags = [F.coalesce(seen[flag], F.lit(0)).alias(flag) for flag in sources]
    matched = entities.join(seen, entities[f"`{entity_key}`"] == seen["_key"], "left")
    return matched.select(*others, *flags)


def conform(
    observations: DataFrame,
    dimension: DataFrame,
    observation_key: str,
    dimension_key: str,
    keep: list[Column],
) -> DataFrame:
    """Inner join on a code or a name key; rows unknown to the dimension go."""
    same = observations[f"`{observation_key}`"] == dimension[f"`{dimension_key}`"]
    return observations.join(dimension, same, "inner").select(*keep)


def aggregate_then_conform(
    observations: DataFrame,
    group: list[str],
    measures: list[Column],
    dimension: DataFrame,
    group_key: str,
    dimension_key: str,
    keep: list[Column],
) -> DataFrame:
    """Aggregate first, so that the join sees one row per group instead of every observation."""
    grouped = observations.groupBy(*group).agg(*measures)
    return conform(grouped, dimension, group_key, dimension_key, keep)
