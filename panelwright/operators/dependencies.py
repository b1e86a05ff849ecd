"""What a model that failed, or a circle of models, keeps from being built.

The dependency table has a row (model, needs) for each input of a model. Two waves go over it as
joins of a frontier with the table, each row of which is used once per wave it is part of:

* from models that failed, and from inputs that are no models at all, to everything that
  needs them, directly or not; each model learns its smallest cause;
* over what is left, from models without inputs to models all of whose inputs are built.
  What this wave never reaches stands in a circle of dependencies or behind one.

Neither collects the graph or lists pairs of models; the number of rounds is the length of the
longest chain. Nothing is run here: a run decides with the result what to attempt.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import stored

FAILED, BLOCKED, CIRCULAR, BUILT = "failed", "blocked", "circular", "buildable"


def blocked_by(dependencies: DataFrame, causes: DataFrame) -> DataFrame:
    """(model, cause): every model that needs a cause, directly or not, with its smallest one.

    ``causes`` has one column ``model``; they are not part of the result unless they need
    another cause or themselves.
    """
    edges = stored(dependencies.select("model", "needs").where("needs IS NOT NULL").distinct(), "dependencies")
    found = None
    frontier = causes.select(F.col("model").alias("node"), F.col("model").alias("cause")).where("node IS NOT NULL").distinct()
    while True:
        reached = (
            edges.join(frontier, F.col("needs") == F.col("node")).groupBy("model").agg(F.min("cause").alias("cause"))
        )
        if found is not None:
            known = found.select(F.col("model").alias("known"), F.col("cause").alias("before"))
            reached = (
                reached.join(known, F.col("model") == F.col("known"), "left")
                .where("before IS NULL OR cause < before").select("model", "cause")
            )
        reached = stored(reached, "reached")
        if reached.isEmpty():
            break
        both = reached if found is None else found.unionByName(reached)
        found = stored(both.groupBy("model").agg(F.min("cause").alias("cause")), "blocked")
        frontier = reached.select(F.col("model").alias("node"), "cause")
    return reached if found is None else found


def build_levels(models: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(model, level): 0 without inputs, else one more than the highest of its inputs.

    Models in a circle or behind one, and models whose inputs are not all in ``models``, are not in
    the result.
    """
    edges = stored(dependencies.select("model", "needs").where("needs IS NOT NULL").distinct(), "dependencies")
    waiting = edges.groupBy("model").agg(F.count("*").alias("open"))
    names = models.select("model").where("model IS NOT NULL").distinct()
    built = stored(names.join(waiting, "model", "left_anti").withColumn("level", F.lit(0)), "level-0")
    waiting = stored(waiting.join(names, "model", "left_semi"), "waiting")
    levels, frontier, level = built, built, 0
    while not frontier.isEmpty():
        level += 1
        ready = edges.join(frontier.select(F.col("model").alias("node")), F.col("needs") == F.col("node"))
        now = ready.groupBy("model").agg(F.count("*").alias("more"))
        waiting = stored(
            waiting.join(now, "model", "left").select("model", (F.col("open") - F.coalesce("more", F.lit(0))).alias("open")),
            "waiting",
        )
        frontier = waiting.where("open = 0").select("model", F.lit(level).alias("level"))
        waiting = waiting.where("open > 0")
        levels = levels.unionByName(frontier)
    return levels


def build_status(models: DataFrame, dependencies: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per model: (model, status, cause, level).

    ``failed``: it failed itself. ``blocked``: it needs a failed model, or an input that is no model,
    and ``cause`` is the smallest of these. ``circular``: it stands in a circle or behind one. Else
    ``buildable`` in round ``level``.
    """
    names = stored(models.select("model").where("model IS NOT NULL").distinct(), "models")
    missing = dependencies.select(F.col("needs").alias("model")).where("model IS NOT NULL").distinct().join(
        names, "model", "left_anti"
    )
    own = names.join(failed.select("model").distinct(), "model", "left_semi")
    blocked = blocked_by(dependencies, own.unionByName(missing))
    free = names.join(own, "model", "left_anti").join(blocked.select("model"), "model", "left_anti")
    free = stored(free, "free-models")
    inner = dependencies.join(free, "model", "left_semi")
    levels = build_levels(free, inner)
    marked = own.withColumn("own", F.lit(True))
    status = (
        F.when(F.col("own"), FAILED).when(F.col("cause").isNotNull(), BLOCKED)
        .when(F.col("level").isNull(), CIRCULAR).otherwise(BUILT)
    )
    return (
        names.join(marked, "model", "left").join(blocked, "model", "left").join(levels, "model", "left")
        .select("model", status.alias("status"), F.when(F.col("own").isNull(), F.col("cause")).alias("cause"), "level")
    )
