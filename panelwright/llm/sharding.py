"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts are neighbours and a text that
is a third of all rows can still be cut, between ids. Rounds of one aggregation each count the
exact bytes and rows below candidate boundaries; between the two candidates that
enclose a wanted boundary the next round probes anew, until each boundary is within the
tolerance or cannot be refined. Then one exchange of the rows gives each its place.

Each shard is a number of ranges, so that no task sorts a whole shard; they are cut by
bytes and by rows, as many tiny texts are few bytes. The counts below the boundaries are
exact, which makes the slots gapless without another pass.

Defined results: a null text has the size 1 and the checksum of an empty text; null ids
come first. Rows that agree in text and id cannot be told apart and stay in one range. An
empty table has no shards. Other columns are kept; names that begin with ``__`` are reserved.
"""

from bisect import bisect_left
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import stored

TOLERANCE = 0.001  # of a shard's bytes, at the shards' boundaries
LOOSE = 0.2  # of a range's bytes, at the others
PROBES = 8  # per boundary and round
RANGE_ROWS = 200_000  # a range has at most, unless rows share text and id or MOST_RANGES are not enough
MOST_RANGES = 4096
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
Key = tuple[int, int]


def _cell(keys: list[Key], first: Column, second: Column) -> Column:
    """How many of the sorted keys are at or below the row's (first, second): a binary search."""
    firsts = F.array(*[F.lit(k).cast("long") for k, _ in keys])
    seconds = F.array(*[F.lit(d).cast("long") for _, d in keys])
    if not keys:
        return F.lit(0)
    whole = F.struct(F.lit(0).alias("low"), F.lit(len(keys)).alias("high"))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (firsts[middle] < first) | ((firsts[middle] == first) & (seconds[middle] <= second))
        return (
            F.when(s["low"] >= s["high"], s)
            .when(below, F.struct((middle + 1).alias("low"), s["high"].alias("high")))
            .otherwise(F.struct(s["low"].alias("low"), middle.alias("high")))
        )

    steps = F.array(*[F.lit(i) for i in range(len(keys).bit_length())])
    return F.aggregate(steps, whole, halve)["low"]


def _spread(low: int, high: int, n: int) -> list[int]:
    """At most n whole numbers in (low, high], evenly spread."""
    return sorted({low + (high - low) * i // n for i in range(1, n + 1)} - {low})


class _Histogram:
    """Exact rows and bytes below the keys that were probed."""

    def __init__(self, keyed: DataFrame):
        self.keyed = keyed

    def count(self, keys: list[Key]):
        """(rows, bytes, least and largest of both key parts) of the cells between sorted keys."""
        found = self.keyed.groupBy(_cell(keys, F.col("__k"), F.col("__d")).alias("cell")).agg(
            F.count("*").alias("rows"), F.sum("__size").alias("bytes"), F.min("__k").alias("k0"),
            F.max("__k").alias("k1"), F.min("__d").alias("d0"), F.max("__d").alias("d1"),
        ).collect()  # a row per cell: at most the probes of a round and one
        cells = {r["cell"]: r for r in found}
        return [cells.get(i) for i in range(len(keys) + 1)]


def boundaries(
    keyed: DataFrame, shards: int, ranges: int, row_parts: int = 1
) -> tuple[list[Key], list[int], int, list[bool]]:
    """Keys that cut the rows into parts, the rows below each, all rows, and which keys end a shard.

    The parts come from cuts into shards * ranges parts of equal bytes and into row_parts
    parts of equal rows. ``keyed`` has ``__k``, ``__d`` and ``__size``.
    """
    histogram, parts = _Histogram(keyed), shards * ranges
    known: dict[Key, tuple[int, int]] = {}
    keys = [(k, LOWEST) for k in _spread(LOWEST, HIGHEST, 4 * parts)]
    total_rows = total = 0
    while keys:
        cells = histogram.count(keys)
        rows = size = 0
        for key, cell in zip(keys, cells):
            rows, size = rows + (cell["rows"] if cell else 0), size + (cell["bytes"] if cell else 0)
            known[key] = rows, size
        last = cells[len(keys)]
        total_rows, total = rows + (last["rows"] if last else 0), size + (last["bytes"] if last else 0)
        probed, asked = keys, set()
        order, wants = sorted(known), []
        for part in range(1, parts):
            tolerance = total / shards * TOLERANCE if part % ranges == 0 else total / parts * LOOSE
            wants.append((1, total * part / parts, tolerance))
        for part in range(1, row_parts):
            wants.append((0, total_rows * part / row_parts, total_rows / row_parts * LOOSE))
        sizes = [[known[k][by] for k in order] for by in (0, 1)]
        for by, wanted, tolerance in wants:
            at = bisect_left(sizes[by], wanted)
            below = sizes[by][at - 1] if at else 0
            above = sizes[by][at] if at < len(order) else (total_rows, total)[by]
            if min(wanted - below, above - wanted) <= tolerance:
                continue
            low = order[at - 1] if at else (LOWEST, LOWEST)
            high = order[at] if at < len(order) else None
            inside = [
                c for k, c in zip([*probed, None], cells)
                if c and (high is None or k is not None and k <= high) and (c["k1"], c["d1"]) >= low
                and (high is None or (c["k0"], c["d0"] if c["k0"] == c["k1"] else LOWEST) < high)
            ]
            if not inside:
                continue
            k0, k1 = min(c["k0"] for c in inside), max(c["k1"] for c in inside)
            k0 = max(k0, low[0])
            k1 = min(k1, high[0]) if high else k1
            if k0 < k1:
                new = [(k, LOWEST) for k in _spread(k0, k1, PROBES)] + [(k0, LOWEST)]
            else:
                d0, d1 = min(c["d0"] for c in inside), max(c["d1"] for c in inside)
                d0 = max(d0, low[1]) if low[0] == k0 else d0
                d1 = min(d1, high[1]) if high and high[0] == k0 else d1
                new = [(k0, d) for d in _spread(d0, d1, PROBES)]
            new = [k for k in new if k not in known and low < k and (high is None or k < high)]
            if new:
                asked.update(new)
                asked.update(k for k in (low, high) if k is not None and k in known)
        fresh = [k for k in asked if k not in known]
        keys = sorted(asked) if fresh else []
    order = sorted(known)
    sizes = [[known[k][by] for k in order] for by in (0, 1)]

    def nearest(by: int, wanted: float) -> Key:
        at = bisect_left(sizes[by], wanted)
        near = [i for i in (at - 1, at) if 0 <= i < len(order)]
        return order[min(near, key=lambda i: (abs(sizes[by][i] - wanted), i))]

    chosen = [(nearest(1, total * part / parts), part % ranges == 0) for part in range(1, parts)]
    chosen += [(nearest(0, total_rows * part / row_parts), False) for part in range(1, row_parts)]
    chosen.sort()
    return [k for k, _ in chosen], [known[k][0] for k, _ in chosen], total_rows, [ends for _, ends in chosen]


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns, and the sort key and size of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumns({
        "__k": F.xxhash64(text), "__d": F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST).cast("long")),
        "__size": (F.octet_length(text) + 1).cast("long"),
    })


def sharded(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns, and ``__size``, ``__crc``, ``__shard`` and ``__slot``."""
    rows = keyed(df, id_col, text_col)
    narrow = stored(rows.select("__k", "__d", "__size"), "shard-keys")
    rows_in_all = narrow.count()
    ranges = max(16, min(MOST_RANGES // shards, rows_in_all // (shards * RANGE_ROWS) + 1))
    row_parts = min(MOST_RANGES, ceil(rows_in_all * (1 + 2 * LOOSE) / RANGE_ROWS)) if rows_in_all > RANGE_ROWS else 1
    cuts, below, _, ends = boundaries(narrow, shards, ranges, row_parts)
    at_shards, offsets = [0], [0]
    for rows_below, ends_shard in zip(below, ends):
        at_shards.append(rows_below if ends_shard else at_shards[-1])
        offsets.append(rows_below - at_shards[-1])
    offset = F.array(*[F.lit(o).cast("long") for o in offsets])
    shard = F.array(*[F.lit(n) for n in accumulate(ends, initial=0)])
    placed = rows.withColumns({
        "__crc": F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")),
        "__part": _cell(cuts, F.col("__k"), F.col("__d")),
    })
    inside = F.row_number().over(Window.partitionBy("__part").orderBy("__k", "__d", "__size", "__crc"))
    return placed.withColumn("__row", inside).select(
        *df.columns, "__size", "__crc", shard[F.col("__part")].cast("int").alias("__shard"),
        (offset[F.col("__part")] + F.col("__row") - 1).cast("long").alias("__slot"),
    )


def write_shards(df: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The rows as Parquet files, a folder per shard, each in order of its slots."""
    placed = sharded(df, shards, id_col, text_col)
    placed.select(*df.columns, F.col("__shard").alias("shard"), F.col("__slot").alias("slot")).sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(path)
