"""Join keys from names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the strict key keeps is ASCII letters and white space.
NOT_LETTERS = r"[^a-zA-Z\s]+"


def strict_name(name: Column) -> Column:
    """Letters and white space only, then trimmed and upper-cased."""
    return F.upper(F.trim(F.regexp_replace(name, NOT_LETTERS, "")))


def light_name(name: Column) -> Column:
    """Trimmed and upper-cased; accents and punctuation stay."""
    return F.upper(F.trim(name))
