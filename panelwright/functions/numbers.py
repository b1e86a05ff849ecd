"""Safe casts and guarded arithmetic; all give NULL where a value is undefined."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_year(year: Column) -> Column:
    """Year as int; NULL for text such as ``2000Q1``. Cast once, before any join."""
    return year.try_cast("int")


def positive_long(text: Column) -> Column:
    """Whole number above zero, else NULL."""
    number = text.try_cast("long")
    return F.when(number > 0, number)


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL unless the denominator is above zero."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def per_million(count: Column, population: Column) -> Column:
    return ratio(count, population / F.lit(1_000_000.0))


def percent_of(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)
