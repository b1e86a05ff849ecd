"""Records inside landed API pages, one page of JSON text per row; record schemas are DDL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _records_at(pages: DataFrame, page: str, json_path: str, schema: str, keep: tuple) -> DataFrame:
    found = F.get_json_object(page, json_path)
    listed = F.when(found.startswith("["), found)  # an object in place of the list gives no rows
    records = F.from_json(listed, f"ARRAY<STRUCT<{schema}>>")
    return pages.select(*keep, F.explode(records).alias("record")).select(*keep, "record.*")


def records_of_meta_pages(
    pages: DataFrame, page: str, schema: str, keep: tuple = ()
) -> DataFrame:
    """``[meta, [record, ...]]`` to records; any other shape gives no rows."""
    return _records_at(pages, page, "$[1]", schema, keep)


def records_of_keyed_pages(
    pages: DataFrame, page: str, dataset: str, schema: str, keep: tuple = ()
) -> DataFrame:
    """``{dataset: [record, ...]}`` to records; a page without the key gives no rows."""
    return _records_at(pages, page, f"$.{dataset}", schema, keep)


def raw_records(pages: DataFrame, page: str, dataset: str | None = None) -> DataFrame:
    """Records of pages as their JSON text, all fields kept, for landing.

    With ``dataset`` the pages are ``{dataset: [...]}``, without it ``[meta, [...]]``.
    """
    json_path = "$[1]" if dataset is None else f"$.{dataset}"
    texts = F.from_json(F.get_json_object(page, json_path), "ARRAY<STRING>")
    return pages.select(F.explode(texts).alias("record")).filter(F.col("record").isNotNull())
