"""Shared by the operators: Arrow batches of whole texts, and words as UTF-8 bytes.

Texts are handled as UTF-8 bytes inside tasks: ``bytes.split()`` splits at
``\\x20\\x09-\\x0D`` and ``bytes.translate`` maps ASCII only, which is what the
operators' word definitions ask for.
"""

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 8 << 20  # of text that a task works on at once; a longer text is a slice of its own
SPACES = b" \t\n\x0b\x0c\r"

# ASCII letters and digits and all bytes of other characters belong to words; capitals become small.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; the path is then
    one more that does not exist.
    """
    root = str(Path(__file__).resolve().parents[2])
    workers = spark.sparkContext.environment
    paths = workers.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between white space; none of a null text."""
    return text.split() if text else []


def folded_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and non-ASCII characters; none of a null text."""
    return text.translate(_FOLDED).split() if text else []


def typed(df: DataFrame, id_col: str, fields: str) -> StructType:
    """The id column as it is in the frame, then the fields given as DDL."""
    kept = [StructField(id_col, df.schema[id_col].dataType)] if id_col else []
    return StructType(kept + StructType.fromDDL(fields).fields)


def slices(batch: pa.RecordBatch, at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many bytes of the text column, a row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    first, size = 0, 0
    for row, length in enumerate(lengths):
        if size and size + length > most:
            yield batch.slice(first, row - first)
            first, size = row, 0
        size += length
    if first < len(lengths):
        yield batch.slice(first)


def map_texts(
    df: DataFrame, columns: list[Column | str], start: Callable[[], Callable], schema: StructType, text_at: int = 1
) -> DataFrame:
    """``start()(*columns)`` for Arrow batches of the columns, without an exchange.

    ``start`` runs once per task and returns the function of a batch's columns as
    Python lists (the text column as bytes), which returns the lists (or Arrow
    arrays) of the result's columns.
    """
    reachable(df.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches):
        step = start()
        for batch in batches:
            for part in slices(batch, text_at):
                lists = [
                    (c.cast(pa.binary()) if i == text_at else c).to_pylist() for i, c in enumerate(part.columns)
                ]
                made = step(*lists)
                yield pa.RecordBatch.from_arrays(
                    [m if isinstance(m, pa.Array) else pa.array(m, f.type) for m, f in zip(made, arrow)], schema=arrow
                )

    return df.select(*columns).mapInArrow(run, schema)


def add_columns(
    df: DataFrame, text_col: str, start: Callable[[], Callable], fields: str, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """All columns of the frame and those that ``start()(texts)`` makes, without an exchange.

    The frame's own columns pass through as Arrow arrays. ``fields`` is the DDL of the
    new columns, which replace columns of the same names; the text column stays.
    """
    reachable(df.sparkSession)
    made = StructType.fromDDL(fields).fields
    df = df.drop(*[f.name for f in made if f.name in df.columns and f.name != text_col])
    names = df.columns
    at = names.index(text_col)
    schema = StructType(df.schema.fields + made)
    arrow = to_arrow_schema(schema)
    new = list(arrow)[len(names):]

    def run(batches):
        step = start()
        for batch in batches:
            for part in slices(batch, at, slice_bytes):
                values = step(part.column(at).cast(pa.binary()).to_pylist())
                columns = [*part.columns, *(pa.array(v, f.type) for v, f in zip(values, new))]
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return df.mapInArrow(run, schema)
