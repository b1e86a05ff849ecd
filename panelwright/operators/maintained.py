"""A scaled index kept up to date over batches of changed rows.

Scaling depends on the least and the largest value of each column over the whole panel. Kept
as values with the number of rows that have them, these extremes can be maintained: a batch
takes away what its keys had before and adds what they have now. As long as no extreme
moves, all other scores stay as they are and only changed rows are scored. The panel is read
as a whole only if the last row with an extreme value is gone, and rescored if one moved.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.index import log1p_scaled
from panelwright.operators.sinks import (
    OVERWRITE_PARTITIONS,
    equal,
    keyed_merge,
    of_partitions,
    stored_table,
    write_table,
)
from panelwright.session import stored

LOW, HIGH = "low", "high"


@dataclass
class Extremes:
    """Per column the least and the largest value and how many rows have them; NULL counts as 0.

    A mergeable summary: ``merged`` of two disjoint sets of rows is that of their union.
    """

    rows: int = 0
    ends: dict[tuple[str, str], tuple[float, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame, columns: list[str]) -> Extremes:
        """Of all rows, in two partial aggregations; ``df`` is read twice, so pass a stored table."""
        value = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
        sides = [(c, s) for c in columns for s in (LOW, HIGH)]
        found = df.agg(F.count("*"), *[(F.min if s == LOW else F.max)(value[c]) for c, s in sides]).first()
        if not found[0]:
            return cls()
        ends = dict(zip(sides, found[1:]))
        return cls(found[0], counted(df, ends))

    def merged(self, other: Extremes) -> Extremes:
        ends = dict(self.ends)
        for (column, side), (value, n) in other.ends.items():
            mine = ends.get((column, side))
            if mine is None or (value < mine[0] if side == LOW else value > mine[0]):
                ends[column, side] = value, n
            elif value == mine[0]:
                ends[column, side] = value, n + mine[1]
        return Extremes(self.rows + other.rows, ends)

    def without(self, removed: DataFrame, rows: int) -> Extremes:
        """After rows are gone; an extreme whose count is 0 then is only a bound."""
        gone = counted(removed, {k: v for k, (v, _) in self.ends.items()})
        return Extremes(self.rows - rows, {k: (v, n - gone[k][1]) for k, (v, n) in self.ends.items()})

    @property
    def known(self) -> bool:
        return all(n > 0 for _, n in self.ends.values())

    def bounds(self) -> dict[str, tuple[float, float]]:
        return {c: (self.ends[c, LOW][0], self.ends[c, HIGH][0]) for c, _ in self.ends}


def counted(df: DataFrame, ends: dict[tuple[str, str], float]) -> dict[tuple[str, str], tuple[float, int]]:
    """How many rows have each of the values."""
    if not ends:
        return {}
    hits = [F.count_if(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) == v) for (c, _), v in ends.items()]
    return {k: (v, n) for (k, v), n in zip(ends.items(), df.agg(*hits).first())}


@dataclass
class MaintainedIndex:
    """Panel and scores under ``base``, both in folders by ``partition_cols``, which are part of the key.

    ``derive`` makes the scaled columns out of a row of the panel, ``finish`` the scores out of
    scaled columns; both look at one row at a time. Applying a batch again changes nothing.
    The extremes are marked open while a batch is under way: after a failure in the middle
    the next batch takes them from the whole panel and rescores it. As with every file table,
    one writer at a time.
    """

    spark: SparkSession
    base: str
    keys: list[str]
    partition_cols: list[str]
    columns: list[str]
    derive: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]

    def panel(self) -> DataFrame | None:
        return stored_table(self.spark, f"{self.base}/panel")

    def scores(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/scores")

    def extremes(self) -> Extremes | None:
        """What is kept, or None if there is nothing or a batch was cut off."""
        kept = stored_table(self.spark, f"{self.base}/extremes")
        rows = [] if kept is None else kept.collect()  # two per column
        if not rows or not rows[0]["settled"]:
            return None
        return Extremes(rows[0]["rows"], {(r["name"], r["side"]): (r["value"], r["n"]) for r in rows})

    def _keep(self, extremes: Extremes, settled: bool) -> None:
        ends = extremes.ends or {("", LOW): (0.0, 0)}
        rows = [(c, s, v, n, extremes.rows, settled) for (c, s), (v, n) in ends.items()]
        made = self.spark.createDataFrame(
            rows, "name STRING, side STRING, value DOUBLE, n LONG, rows LONG, settled BOOLEAN"
        )
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/extremes")

    def apply(self, batch: DataFrame) -> dict:
        """Rows of the batch replace those of their keys; returns what was read and scored."""
        batch = stored(batch, "index-batch")
        panel, before = self.panel(), self.extremes()
        report = {"panel_rows_read": 0, "rescanned": False, "rescored": False, "rows_scored": 0}
        changed = Extremes.of(self.derive(batch), self.columns)
        if not changed.rows:
            return report
        if panel is None:
            self._keep(changed, False)
            write_table(batch, f"{self.base}/panel", mode=OVERWRITE_PARTITIONS, partition_cols=self.partition_cols)
            after, moved = changed, True
        else:
            read = Observation("panel rows read")
            current = of_partitions(panel, batch, self.partition_cols).observe(read, F.count(F.lit(1)).alias("n"))
            keys = batch.select(*[F.col(f"`{k}`").alias(k) for k in self.keys]).withColumn("_changed", F.lit(True))
            flagged = current.join(keys, equal(current, keys, self.keys), "left").select(
                *[current[f"`{c}`"] for c in current.columns], F.col("_changed").isNotNull().alias("_changed")
            )
            flagged = stored(flagged, "index-partitions")
            report["panel_rows_read"] = read.get["n"]
            old, kept = (flagged.where(F.col("_changed") == x).drop("_changed") for x in (True, False))
            self._keep(before or Extremes(), False)
            write_table(
                kept.unionByName(batch), f"{self.base}/panel", mode=OVERWRITE_PARTITIONS,
                partition_cols=self.partition_cols,
            )
            after = before and before.without(self.derive(old), old.count()).merged(changed)
            if after is None or not after.known:
                whole = self.derive(self.panel())
                after = Extremes.of(whole, self.columns)
                report["panel_rows_read"] += 2 * after.rows
                report["rescanned"] = True
            moved = before is None or after.bounds() != before.bounds()
        if moved:
            scored = self._scored(self.panel(), after)
            write_table(scored, f"{self.base}/scores", partition_cols=self.partition_cols)
            report.update(rescored=True, rows_scored=after.rows)
            report["panel_rows_read"] += after.rows
        else:
            self._merge_scores(self._scored(batch, after), batch)
            report["rows_scored"] = changed.rows
        self._keep(after, True)
        return report

    def _scored(self, panel: DataFrame, extremes: Extremes) -> DataFrame:
        return self.finish(log1p_scaled(self.derive(panel), extremes.bounds()))

    def _merge_scores(self, scored: DataFrame, batch: DataFrame) -> None:
        current = of_partitions(self.scores(), batch, self.partition_cols)
        merged = stored(keyed_merge(current, scored, self.keys), "index-scores")
        write_table(merged, f"{self.base}/scores", mode=OVERWRITE_PARTITIONS, partition_cols=self.partition_cols)
