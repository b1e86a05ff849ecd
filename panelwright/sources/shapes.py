"""Pages and records whose shape is not known beforehand, as VARIANT values.

A declared schema drops what it does not name and gives NULL where a type differs. A VARIANT
keeps the value as it came; fields are then asked for by path and type, with as many
alternatives as the sources have spellings, and the shapes that did occur can be looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = ("$[1]", "$.data", "$.records", "$.results", "$.items", "$")  # where a page may hold its records


def parsed(page: str) -> Column:
    """The text as a VARIANT; NULL if it is no JSON."""
    return F.try_parse_json(F.col(f"`{page}`"))


def field(value: str, paths: list[str], kind: str) -> Column:
    """The first of the paths that holds a value of the kind; a text with such a value counts as well."""
    return F.coalesce(*[F.try_variant_get(F.col(f"`{value}`"), path, kind) for path in paths])


def records_of_any_page(
    pages: DataFrame, page: str, lists: tuple[str, ...] = LISTS, keep: tuple = (), name: str = "record"
) -> DataFrame:
    """One row per record of each page, as a VARIANT.

    Records are the elements of the first list that one of the paths leads to: ``[meta, [...]]``,
    ``{"data": [...]}`` or a plain list. A page that is an object and holds no such list is one
    record itself. Text that is no JSON, and plain values, give no rows (see ``unreadable_pages``).
    """
    value = pages.select(*keep, parsed(page).alias("_value"))
    listed = F.coalesce(*[F.try_variant_get("_value", path, "array<variant>") for path in lists])
    single = F.when(F.schema_of_variant("_value").startswith("OBJECT"), F.array("_value"))
    return (
        value.select(*keep, F.explode(F.coalesce(listed, single)).alias(name))
        .where(F.schema_of_variant(name).startswith("OBJECT"))
    )


def unreadable_pages(pages: DataFrame, page: str) -> DataFrame:
    """The pages that are no JSON, or hold neither a list nor an object."""
    shape = F.schema_of_variant(parsed(page))
    return pages.where(~F.coalesce(shape.startswith("OBJECT") | shape.startswith("ARRAY"), F.lit(False)))


def observed_shape(records: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group one shape that all its records fit: (…, shape), a merge that keeps every field seen."""
    return records.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.schema_of_variant_agg(value).alias("shape"))
