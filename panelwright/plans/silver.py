"""The nine conformed models, from flattened raw frames."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.functions.names import strict_name
from panelwright.operators.conform import aggregate_then_conform, conform, flag_presence
from panelwright.operators.reshape import year_range

ISO, YEAR = contract.ISO, contract.YEAR
_ISO = f"`{ISO}`"


def country_model(
    reference: DataFrame,
    population: DataFrame | None = None,
    patents: DataFrame | None = None,
    laureates: DataFrame | None = None,
) -> DataFrame:
    """Countries with a flag per source; an absent source leaves its flag at 0.

    ``country_code`` is the name key by which the patents source knows the country
    (NULL if it does not); laureates and patents are matched on it later.
    """
    named = reference.select(
        F.col(_ISO), F.col("official_name_en").alias("country_name")
    ).withColumn("_name_key", strict_name(F.col("country_name")))

    by_name = {}
    if laureates is not None and "country_normalized" in laureates.columns:
        by_name["ref_nobelprize"] = (laureates, "country_normalized")
    if patents is not None and "country_code" in patents.columns:
        by_name["ref_patents"] = (patents, "country_code")
    flagged = flag_presence(named, "_name_key", by_name) if by_name else named
    if population is not None and ISO in population.columns:
        flagged = flag_presence(flagged, ISO, {"ref_worldbank": (population, ISO)})
    for flag in ("ref_worldbank", "ref_nobelprize", "ref_patents"):
        if flag not in flagged.columns:
            flagged = flagged.withColumn(flag, F.lit(0))

    country = [_ISO, "country_name", "ref_worldbank", "ref_nobelprize", "ref_patents"]
    if "ref_patents" in by_name:
        code = F.when(F.col("ref_patents") == 1, F.col("_name_key"))
        return flagged.select(*country, code.alias("country_code"))
    return flagged.select(*country)


def year_model(spark: SparkSession, first: int = contract.FIRST_YEAR, last: int | None = None) -> DataFrame:
    return year_range(spark, first, last)


def indicator_model(indicator: DataFrame, country: DataFrame) -> DataFrame:
    """Population, GDP, R&D, researchers, unemployment: one definition, the value name differs."""
    value = next(v for v in ("value", "unemployment_rate") if v in indicator.columns)
    keep = [
        indicator[_ISO], indicator[YEAR], indicator[value],
        country["country_name"], country["ref_worldbank"],
    ]
    return conform(indicator, country, ISO, ISO, keep)


def laureates_model(laureates: DataFrame, country: DataFrame) -> DataFrame:
    keep = [
        laureates["laureate_id"], laureates[YEAR],
        laureates["country"].alias("laureate_country_name"),
        country[_ISO], country["country_name"].alias("country_name_ref"),
    ]
    return conform(laureates, country, "country_normalized", "country_code", keep)


def patents_model(patents: DataFrame, country: DataFrame) -> DataFrame:
    parts = ["patents_total", "resident_patents", "abroad_patents"]
    measures = [
        F.sum("patents_count").alias("patents_total"),
        F.sum("resident_patents").alias("resident_patents"),
        F.sum("abroad_patents").alias("abroad_patents"),
    ]
    dimension = country.select(F.col("country_name"), F.col(_ISO), F.col("country_code").alias("_code"))
    keep = [F.col("country_name"), F.col(_ISO), F.col(YEAR), *[F.col(p) for p in parts]]
    return aggregate_then_conform(
        patents, ["country_code", YEAR], measures, dimension, "country_code", "_code", keep
    )
