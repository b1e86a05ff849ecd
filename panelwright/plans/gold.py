"""The two dimensions and the fact with the composite index."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.functions.numbers import per_million, percent_of, ratio
from panelwright.operators.index import inverted, log1p_minmax, reweighted_score, weighted_sum
from panelwright.operators.panel import Inputs, panel_by_union
from panelwright.operators.reshape import scaffold, year_range
from panelwright.session import stored

ISO, YEAR = contract.ISO, contract.YEAR


def dim_country(country: DataFrame) -> DataFrame:
    return country


def dim_year(spark: SparkSession, first: int = contract.FIRST_YEAR, last: int | None = None) -> DataFrame:
    """Built afresh, so that it always reaches the current year."""
    return year_range(spark, first, last)


def with_ratios(panel: DataFrame) -> DataFrame:
    """The six derived measures; the seventh scaled column is taken as it is."""
    c, population = F.col, F.col("population")
    return panel.select(
        "*",
        per_million(c("patents_total"), population).alias("patents_per_million"),
        per_million(c("resident_patents"), population).alias("resident_patents_per_million"),
        per_million(c("nobel_laureates_count"), population).alias("nobelists_per_million"),
        ratio(c("abroad_patents"), c("resident_patents")).alias("patent_expansion_ratio"),
        per_million(c("researchers_count"), population).alias("researchers_per_million"),
        percent_of(c("rd_expenditure"), c("gdp")).alias("rd_gdp_pct"),
    )


def with_sub_indices(scaled: DataFrame) -> DataFrame:
    return scaled.select(
        "*",
        weighted_sum(contract.PATENTS_WEIGHTS).alias("patents_index"),
        weighted_sum(contract.RESEARCH_WEIGHTS).alias("research_index"),
        F.col("rd_gdp_pct_norm").alias("rd_index"),
        inverted("graduate_unemployment_rate_norm").alias("unemployment_index"),
    )


def with_score(indexed: DataFrame) -> DataFrame:
    return indexed.withColumn(contract.SCORE, reweighted_score(contract.SCORE_WEIGHTS))


def composite_index(panel: DataFrame) -> DataFrame:
    """Panel of measures to ratios, scaled columns, sub-indices and the final score.

    Scaling reads the panel twice, so the panel should be a stored table.
    """
    scaled = log1p_minmax(with_ratios(panel), list(contract.SCALED))
    return with_score(with_sub_indices(scaled))


def fact_inputs(models: dict[str, DataFrame]) -> Inputs:
    """Conformed models as panel inputs, one row per country and year each."""
    key = [F.col(f"`{ISO}`"), F.col(YEAR)]

    def indicator(model: str, value: str, measure: str) -> tuple[DataFrame, list[str]]:
        return models[model].select(*key, F.col(value).alias(measure)).repartition(*key), [measure]

    patents = ["patents_total", "resident_patents", "abroad_patents"]
    laureates = models["NOBEL_LAUREATES"].groupBy(*key).agg(
        F.count_distinct("laureate_id").alias("nobel_laureates_count")
    )
    return [
        indicator("POPULATION", "value", "population"),
        indicator("PKB", "value", "gdp"),
        indicator("RD_EXPENDITURE", "value", "rd_expenditure"),
        indicator("RESEARCHERS", "value", "researchers_count"),
        indicator("GRADUATE_UNEMPLOYMENT", "unemployment_rate", "graduate_unemployment_rate"),
        (models["PATENTS"].groupBy(*key).agg(*[F.sum(p).alias(p) for p in patents]), patents),
        (laureates, ["nobel_laureates_count"]),
    ]


def fact_innovation(models: dict[str, DataFrame]) -> DataFrame:
    """The panel is stored once; the index is a lazy plan over it."""
    grid = scaffold(models["COUNTRY"], ISO, models["YEAR"], YEAR)
    panel = panel_by_union(grid, fact_inputs(models), [ISO, YEAR])
    return composite_index(stored(panel, "panel"))
