"""Out-of-order events: each once, in bounded state, and those that come too late set aside.

An event is late if it arrives more than ``delay`` after its own time. That is a property of
the row, not of the batch it happens to be in, so neither the size of batches nor a
replay decides what is late. Rows on time pass a watermark and ``dropDuplicatesWithinWatermark``:
the state store keeps a key until the watermark is ``delay`` past its event, so its size
follows the events of that span and not the history.

``disorder`` bounds how far deliveries are taken out of their order of arrival, such as the
span that one file covers. As long as it does, and no event is ahead of its arrival, the
watermark (the latest event less both spans) is never past a row that is on time, so Spark
drops nothing that is not set aside here by name. Deliveries of one event must agree in
their key and time; a delivery after ``delay`` is late, whether or not the event was seen before.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.sinks import OVERWRITE_PARTITIONS, write_table
from panelwright.session import stored

ON_TIME, LATE, NO_TIME, NO_KEY = "on time", "late", "no time", "no key"


def timeliness(keys: list[str], event_time: str, arrival: str, delay: str) -> Column:
    """Why a delivery is set aside, or ``on time``; ``delay`` is an interval such as '3 hours'."""
    time, came = F.col(f"`{event_time}`"), F.col(f"`{arrival}`")
    no_key = F.greatest(*[F.col(f"`{k}`").isNull() for k in keys], F.lit(False))
    return (
        F.when(no_key, NO_KEY)
        .when(time.isNull() | came.isNull(), NO_TIME)
        .when(time < came - F.expr(f"INTERVAL {delay}"), LATE)
        .otherwise(ON_TIME)
    )


def once_in_time(
    stream: DataFrame, keys: list[str], event_time: str, arrival: str, delay: str, disorder: str = "0 seconds",
    status: str = "status",
) -> DataFrame:
    """The stream with each event once and, marked by ``status``, every delivery that is set aside.

    Of several deliveries on time one stays, so the columns of an event should be the same in
    all of them; ``arrival`` is left out for that reason. One source, one query: what is set
    aside goes past the state store.
    """
    marked = stream.withColumn(status, timeliness(keys, event_time, arrival, delay))
    columns = [c for c in stream.columns if c != arrival]
    once = (
        marked.where(F.col(status) == ON_TIME)
        .withWatermark(event_time, f"{delay} {disorder}")
        .dropDuplicatesWithinWatermark(keys)
        .select(*[f"`{c}`" for c in columns], status)
    )
    aside = marked.where(F.col(status) != ON_TIME).select(*[f"`{c}`" for c in columns], status)
    return once.unionByName(aside)


def split_sink(path: str, aside_path: str, status: str = "status"):
    """A ``foreachBatch`` function: events to the one table, what is set aside to the other.

    Both are replaced batch by batch, so a batch that is replayed leaves them as they were.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # State is read and written while the batch is computed: compute it once.
        rows = stored(batch.withColumn("batch_id", F.lit(batch_id)), "event-batch")
        for target, mine in ((path, F.col(status) == ON_TIME), (aside_path, F.col(status) != ON_TIME)):
            write_table(rows.where(mine), target, mode=OVERWRITE_PARTITIONS, partition_cols=["batch_id"])

    return write


def set_aside_counts(aside: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """How many deliveries were set aside, by reason and the given columns."""
    return aside.groupBy(*by, status).agg(F.count("*").alias("n"))
