"""Exact distinct counts that can be merged: one bitmap per group, period and bucket of ids.

A distinct count cannot be added up over days, a set of ids can. Ids are dealt into buckets of
32 768 neighbours; the ids of a group and period in one bucket are a bitmap of 4 KB. Bitmaps
of any periods are united by OR and counted by their set bits, so the counts of a week or
of all time come from the days' bitmaps, and only new days are read again. All of it is
built-in aggregation with partial combine.

Memory: a task holds 4 KB for each (group, bucket) it has met, whatever the number of rows;
a group with ids up to n has at most n / 32 768 + 1 buckets per period. That is compact if ids
are dense. Ids that are not, or no numbers, are numbered first (``numbered``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.ordinals import positions
from panelwright.session import stored

BUCKET, BITS, ROWS = "bucket", "bits", "n_rows"
BITMAP_BYTES = 4096


def id_bitmaps(df: DataFrame, by: list[str], member: Column) -> DataFrame:
    """One row per group and bucket: the ids that occur, and how many rows they have.

    ``by`` are groups and period. Rows without an id make a group with no bits: it is counted as 0.
    """
    member = member.cast("long")
    bucket = F.when(member.isNotNull(), F.bitmap_bucket_number(member))
    return (
        df.groupBy(*[F.col(f"`{c}`") for c in by], bucket.alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(BITS), F.count("*").alias(ROWS))
    )


def united(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of fewer groups or longer periods; ``united`` of ``united`` is ``united``."""
    return bitmaps.groupBy(*[F.col(f"`{c}`") for c in by], BUCKET).agg(
        F.bitmap_or_agg(BITS).alias(BITS), F.sum(ROWS).alias(ROWS)
    )


def distinct_counts(bitmaps: DataFrame, by: list[str], name: str = "n_distinct") -> DataFrame:
    """The number of distinct ids per group, over all its buckets and whatever periods are not in ``by``."""
    per_bucket = united(bitmaps, by)
    return per_bucket.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.coalesce(F.sum(F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(BITS))), F.lit(0)).alias(name)
    )


def trailing_counts(bitmaps: DataFrame, by: list[str], period: str, length: int, name: str = "n_distinct") -> DataFrame:
    """Distinct ids per group in the ``length`` periods that end with each period that occurs.

    ``period`` is a whole number, such as a day or a year. Every bitmap is sent to the windows
    it belongs to, at most ``length`` of them, where partial aggregation unites it.
    """
    held = united(bitmaps, [*by, period])
    ends = held.select(*[F.col(f"`{c}`") for c in by], period).distinct()
    sent = held.withColumn(period, F.explode(F.sequence(F.col(period), F.col(period) + (length - 1))))
    counts = distinct_counts(sent, [*by, period], name)
    same = [counts[f"`{c}`"].eqNullSafe(ends[f"`{c}`"]) for c in (*by, period)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return counts.join(ends, condition, "left_semi")


def memory_bound(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """How many bitmaps a group has, and the bytes they take."""
    return bitmaps.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(BUCKET).alias("bitmaps"), (F.count(BUCKET) * BITMAP_BYTES).alias("bytes")
    )


def numbered(df: DataFrame, member: str, name: str = "number") -> DataFrame:
    """(member, number): the distinct members numbered from 0 without gaps, in their order.

    For ids that are texts or far apart. The numbers come from positions in a range exchange, so
    no task sees all members; join them to the rows by the member.
    """
    distinct = stored(df.select(member).where(F.col(member).isNotNull()).distinct(), "members")
    return positions(distinct, [F.col(member)], name)


def with_numbers(df: DataFrame, numbers: DataFrame, member: str, name: str = "number") -> DataFrame:
    """The rows with the number of their member, NULL for a NULL member."""
    renamed = numbers.select(F.col(member).alias("_member"), name)
    return df.join(renamed, df[member] == renamed["_member"], "left").drop("_member")
