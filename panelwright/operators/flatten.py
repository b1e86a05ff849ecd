"""From the three raw shapes to tidy rows. Unknown dataset names pass through unchanged."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.functions.names import light_name, strict_name
from panelwright.functions.numbers import positive_long, to_year
from panelwright.operators.reshape import explode_rows, unpivot_years


def add_key_if_present(df: DataFrame, name: str, key: str, rule) -> DataFrame:
    """Add the name key only when the frame has the name."""
    return df.withColumn(key, rule(F.col(f"`{name}`"))) if name in df.columns else df


def flatten_indicator(df: DataFrame, dataset: str) -> DataFrame:
    """Nested indicator records to (country_name, iso, year, value).

    NULL codes go; empty codes (aggregates such as a continent) stay until the
    conform join removes them.
    """
    if dataset not in contract.INDICATOR_VALUE_COLUMN:
        return df
    flat = df.select(
        F.col("country.value").alias("country_name"),
        F.col("countryiso3code").alias(contract.ISO),
        to_year(F.col("date")).alias(contract.YEAR),
        F.col("value").alias(contract.INDICATOR_VALUE_COLUMN[dataset]),
    ).filter(F.col(f"`{contract.ISO}`").isNotNull())
    return add_key_if_present(flat, "country_name", "country_name_normalized", strict_name)


def flatten_laureates(df: DataFrame, dataset: str = "laureates") -> DataFrame:
    """One row per laureate and prize, with the country of birth (then or now)."""
    if dataset != "laureates":
        return df
    flat = (
        explode_rows(df, "nobelPrizes", "prize")
        .select(
            F.col("id").alias("laureate_id"),
            F.coalesce("birth.place.country.en", "birth.place.countryNow.en").alias("country"),
            to_year(F.col("prize.awardYear")).alias(contract.YEAR),
        )
        .filter(F.col("country").isNotNull())
    )
    return add_key_if_present(flat, "country", "country_normalized", light_name)


def split_by_residence(df: DataFrame, count: str, origin: str, office: str) -> DataFrame:
    """Count as resident where origin equals office, as abroad where it differs.

    An unknown side is neither, so the two parts need not add up to the count.
    """
    n, origin_col, office_col = F.col(count), F.col(f"`{origin}`"), F.col(f"`{office}`")
    zero = F.lit(0).cast("long")
    return df.withColumn(
        "resident_patents", F.when(origin_col == office_col, n).otherwise(zero)
    ).withColumn("abroad_patents", F.when(origin_col != office_col, n).otherwise(zero))


def flatten_patents(df: DataFrame, dataset: str = "patents") -> DataFrame:
    """Wide year columns to one row per office, origin and year with a positive count."""
    if dataset != "patents":
        return df
    ids = ["Office", "Office (Code)", "Origin"]
    counted = (
        unpivot_years(df, ids, "patents_count")
        .withColumn("patents_count", positive_long(F.col("patents_count")))
        .filter(F.col("patents_count").isNotNull())
    )
    split = split_by_residence(counted, "patents_count", "Origin", "Office")
    return add_key_if_present(split, "Origin", "country_code", light_name)
