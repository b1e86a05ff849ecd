"""Lake locations as column expressions over path columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two host suffixes of the storage service.
BLOB_HOST = "blob.core.windows.net"
LAKE_HOST = "dfs.core.windows.net"

# Scheme, account (first host label), container (first folder), path. Query string
# and fragment are not part of a location.
HTTPS_LOCATION = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#.]*)[^/?#]*/*([^/?#]*)/?([^?#]*)"


def _strip_slashes(path: Column) -> Column:
    return F.regexp_replace(path, "^/+|/+$", "")


def lake_uri(https_url: Column) -> Column:
    """``https://acct.host/Box/a/b`` to ``abfss://box@acct.<lake host>/a/b``.

    Text without a scheme is not a location and gives NULL.
    """
    part = [F.regexp_extract(https_url, HTTPS_LOCATION, i) for i in (1, 2, 3)]
    uri = F.concat(
        F.lit("abfss://"), F.lower(part[1]), F.lit("@"), part[0], F.lit(f".{LAKE_HOST}/"), part[2]
    )
    return F.when(https_url.rlike(HTTPS_LOCATION), uri)


def absolute_url(relative: Column, account: Column) -> Column:
    """Manifest entry to https location; a missing leading slash is added."""
    rooted = F.when(relative.startswith("/"), relative).otherwise(F.concat(F.lit("/"), relative))
    return F.concat(F.lit("https://"), account, F.lit(f".{BLOB_HOST}"), rooted)


def blob_url(container: Column, path: Column, account: Column) -> Column:
    return F.concat(
        F.lit("https://"), account, F.lit(f".{BLOB_HOST}/"), F.lower(container), F.lit("/"),
        F.regexp_replace(path, "^/+", ""),
    )


def account_uri(relative: Column, account: Column) -> Column:
    """Location in the container that carries the account's own name."""
    return F.concat(F.lit("abfss://"), account, F.lit("@"), account, F.lit(f".{LAKE_HOST}/"), relative)


def table_uri(container: Column, table: Column, account: Column) -> Column:
    """Where a layer keeps a table: the layer is the container, the table the folder."""
    return F.concat(
        F.lit("abfss://"), container, F.lit("@"), F.lower(account), F.lit(f".{LAKE_HOST}/"), table
    )


def prefixed(paths: Column, base: Column) -> Column:
    """Put ``base/`` before every path of an array."""
    return F.transform(paths, lambda p: F.concat(base, F.lit("/"), _strip_slashes(p)))


def landing_path(source: Column, day: Column, dataset: Column, run_id: Column, config: Column) -> Column:
    """Relative location of one landed batch: source, day folders, then the batch name."""
    return F.concat(
        F.lower(source), F.lit("/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/"),
        F.concat_ws("_", dataset, run_id, config), F.lit(".json"),
    )
