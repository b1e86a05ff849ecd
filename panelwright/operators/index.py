"""Scaling, weighted sub-indices, the re-weighted score, and ranking."""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwright.operators.ordinals import positions
from panelwright.session import stored


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def log1p_minmax(
    df: DataFrame, columns: list[str], suffix: str = "_norm", on_domain_error: str = "error"
) -> DataFrame:
    """Add ``<column><suffix>``: log1p scaled to [0, 1] over all rows of ``df``.

    A NULL takes part in the fit as 0 and stays NULL in the result. A column with
    one value only scales to 0.5. Values at or below -1 have no log1p: they fail
    the job, or with ``on_domain_error="null"`` give NULL and leave the fit.

    The fit is one row of bounds (log1p is monotone, so minima and maxima need no
    logarithm per row), read as a scalar subquery. It reads ``df`` a second time:
    pass a stored table (``session.stored``), not a costly plan. Spark may reuse an
    exchange between the two reads, but adaptive planning does not promise it.
    """
    if on_domain_error not in ("error", "null"):
        raise ValueError("on_domain_error must be 'error' or 'null'")

    bounds, terms = [], []
    for i, c in enumerate(columns):
        value = f"coalesce(cast(`{c}` as double), 0D)"
        low, width = f"log1p(min_{i})", f"log1p(max_{i}) - log1p(min_{i})"
        if on_domain_error == "null":
            value = f"if({value} > -1, {value}, null)"
        else:
            name = c.replace("'", "\\'")
            complaint = f"raise_error('log1p is undefined for a value of {name}')"
            low = f"if(min_{i} <= -1, cast({complaint} as double), {low})"
        bounds += [F.expr(f"min({value}) as min_{i}"), F.expr(f"max({value}) as max_{i}")]
        terms += [
            f"'low_{i}', {low}",
            f"'width_{i}', if({width} = 0, 1D, {width})",
            f"'shift_{i}', if({width} = 0, 0.5D, 0D)",
        ]
    fit = df.agg(*bounds).selectExpr(f"named_struct({', '.join(terms)})").scalar()

    # Exploding the one-row fit makes it a column that later filters and projections
    # refer to; as an expression, the optimizer would copy the subquery into each.
    fitted = df.select("*", F.explode(F.array(fit)).alias("_fit"))
    scaled = [
        f"(log1p(cast(`{c}` as double)) - _fit.low_{i}) / _fit.width_{i} + _fit.shift_{i} as `{c}{suffix}`"
        for i, c in enumerate(columns)
    ]
    return fitted.selectExpr("*", *scaled).drop("_fit")


def log1p_scaled(df: DataFrame, bounds: dict[str, tuple[float, float]], suffix: str = "_norm") -> DataFrame:
    """``log1p_minmax`` with bounds that are known already, from least to largest value of each column."""
    scaled = []
    for c, (low, high) in bounds.items():
        if low <= -1:
            raise ValueError(f"log1p is undefined for a value of {c}")
        least = f"log1p(double('{low!r}'))"
        width = f"(log1p(double('{high!r}')) - {least})"
        scaled.append(
            f"(log1p(cast(`{c}` as double)) - {least}) / if({width} = 0, 1D, {width}) + if({width} = 0, 0.5D, 0D)"
            f" as `{c}{suffix}`"
        )
    return df.selectExpr("*", *scaled)


def weighted_sum(weights: dict[str, float]) -> Column:
    """Sum of value times weight. A missing component counts as 0; all missing gives NULL."""
    any_present = reduce(or_, [_col(c).isNotNull() for c in weights])
    total = reduce(add, [F.coalesce(_col(c), F.lit(0.0)) * w for c, w in weights.items()])
    return F.when(any_present, total)


def inverted(column: str) -> Column:
    return F.lit(1.0) - _col(column)


def reweighted_score(weights: dict[str, float]) -> Column:
    """Weighted mean over the components that are present; NULL when none is."""
    total = reduce(add, [F.coalesce(_col(c), F.lit(0.0)) * w for c, w in weights.items()])
    weight = reduce(
        add, [F.when(_col(c).isNotNull(), w).otherwise(F.lit(0.0)) for c, w in weights.items()]
    )
    return F.try_divide(total, weight)  # NULL when no weight is present


def top_k_within(df: DataFrame, group: str, score: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows with one of the k best distinct scores of their group, ties included.

    Only distinct scores are ranked, and the rank filter becomes a per-task group
    limit before their exchange, so at most k rows per group and task move. The
    winners, at most k per group, then pick their rows; a score that very many rows
    share is never gathered in one task. ``df`` is read twice: pass a stored table.
    Rows without a score are left out.
    """
    best_first = Window.partitionBy("_group").orderBy(F.col("_score").desc())
    winners = (
        df.filter(F.col(score).isNotNull())
        .select(F.col(group).alias("_group"), F.col(score).alias("_score"))
        .distinct()
        .withColumn("_rank", F.row_number().over(best_first))
        .filter(F.col("_rank") <= k)
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col(score) == F.col("_score"))
    return df.join(winners, same).select(*[_col(c) for c in df.columns], F.col("_rank").alias(rank))


def rank_within(
    df: DataFrame, group: str, score: str, rank: str = "rank", slices: int | None = None
) -> DataFrame:
    """Dense rank of every row inside its group, best score first, missing scores last.

    The distinct (group, score) pairs are exchanged by ranges of (group, score), so that a
    group with most of the rows is spread over tasks and no window sees it. A pair's rank is
    its position in that order less the position at which its group begins. A score shared
    by many rows is ranked once; the join back to the rows splits it if it is hot. ``df`` is
    read twice: pass a stored table. ``slices`` is the number of ranges (default: the session's
    shuffle partitions).
    """
    pairs = stored(df.select(_col(group).alias("_group"), _col(score).alias("_score")).distinct(), "scores")
    order = [F.col("_group").asc_nulls_first(), F.col("_score").desc_nulls_last()]
    placed = positions(pairs, order, "_position", slices)
    starts = placed.groupBy(F.col("_group").alias("_of")).agg(F.min("_position").alias("_start"))
    ranks = placed.join(starts, F.col("_group").eqNullSafe(F.col("_of"))).select(
        "_group", "_score", (F.col("_position") - F.col("_start") + 1).cast("int").alias("_rank")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(score).eqNullSafe(F.col("_score"))
    return df.join(ranks, same).select(*[_col(c) for c in df.columns], F.col("_rank").alias(rank))
