"""Side-by-side run of a query on Spark and its SQL on DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs in columns, types, row count or values; empty when all is equal."""
    found = []
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    names = sorted(described)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    types = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    found += [f"type of {n}: {types[n]} != {described[n]}" for n in names if types[n] != described[n]]
    order = [list(described).index(n) for n in names]
    # As text, so that 0.0 and -0.0 differ and NaN equals itself.
    expected = Counter(repr(tuple(row[i] for i in order)) for row in expected_rows)
    actual = Counter(repr(tuple(row)) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if sum(actual.values()) != sum(expected.values()):
        found.append(f"rows {sum(actual.values())} != {sum(expected.values())}")
    only_spark, only_sql = actual - expected, expected - actual
    if only_spark or only_sql:
        found.append(f"{names}: only Spark {list(only_spark)[:2]}, only SQL {list(only_sql)[:2]}, "
                     f"{sum(only_spark.values())} and {sum(only_sql.values())} rows")
    return found
