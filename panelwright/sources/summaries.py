"""Run summaries as data: which inputs a finished run left behind, and where."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.sources.schemas import RUN_SUMMARY


def read_summaries(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Each summary file is one JSON object of bounded size."""
    return spark.read.option("multiline", True).schema(RUN_SUMMARY).json(paths)


def result_rows(summaries: DataFrame) -> DataFrame:
    """One row per result, with the run's own status next to it."""
    return summaries.select(
        F.col("status").alias("run_status"),
        F.col("correlation_id").alias("run_id"),
        "etl_layer",
        F.explode("results").alias("result"),
    ).select("run_status", "run_id", "etl_layer", "result.*")


def is_completed(status: Column) -> Column:
    return F.upper(status) == contract.COMPLETED


def is_landed(status: Column) -> Column:
    """The wider rule of landing results (case-sensitive)."""
    # The two accepted words.
    return status.isin("COMPLETED", "SUCCESS")


def summary_is_valid(summary_status: Column, results: Column) -> Column:
    """The run and every one of its results completed; no results counts as valid."""
    all_done = F.forall(F.coalesce(results, F.array()), lambda r: is_completed(r["status"]))
    return is_completed(summary_status) & all_done


def valid_output_paths(
    results: DataFrame, datasets: list[str] | None = None, include_skipped: bool = False
) -> DataFrame:
    """(domain_source, dataset_name, path) of every completed result.

    ``include_skipped`` adds what a skipped landing points to: records that an
    earlier run of the same day and configuration has landed already.
    """
    usable = is_completed(F.col("status"))
    if include_skipped:
        usable = usable | (F.upper("status") == contract.SKIPPED)
    chosen = results.filter(usable)
    if datasets is not None:
        chosen = chosen.filter(F.col("dataset_name").isin(datasets))
    return chosen.select(
        "domain_source", "dataset_name", F.explode("output_paths").alias("path")
    )


def route_sources(
    required: DataFrame, manual: DataFrame, landed: DataFrame, keys: list[str]
) -> DataFrame:
    """Where each required dataset is read from: manual path if listed, else landed paths.

    ``path`` and ``origin`` are NULL for a dataset that neither side has; a dataset
    with several landed paths keeps them all.
    """
    by_hand = required.join(manual.select(*keys, F.col("path").alias("_manual")), keys, "left")
    offers = landed.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("path").alias("_landed")
    )
    same_dataset = [F.col(k) == F.col(f"_{k}") for k in keys]
    return by_hand.join(offers, [*same_dataset, F.col("_manual").isNull()], "left").select(
        *keys,
        F.coalesce("_manual", "_landed").alias("path"),
        F.when(F.col("_manual").isNotNull(), "manual")
        .when(F.col("_landed").isNotNull(), "landed")
        .alias("origin"),
    )
