"""What failed models and circles keep from being built."""

import random

import pytest

from panelwright.operators import dependencies as deps


def plain(models, edges, failed):
    needs = {m: {n for k, n in edges if k == m and n is not None} for m in models}
    roots = {m for m in models if m in failed} | {n for m in models for n in needs[m] if n not in needs}
    causes = {m: set() for m in models}
    changed = True
    while changed:
        changed = False
        for m in models:
            more = {n for n in needs[m] if n in roots}.union(*[causes[n] for n in needs[m] if n in causes])
            if not more <= causes[m]:
                causes[m] |= more
                changed = True
    free = [m for m in models if m not in failed and not causes[m]]
    level, changed = {}, True
    while changed:
        changed = False
        for m in free:
            if m not in level and all(n in level for n in needs[m]):
                level[m] = max((level[n] + 1 for n in needs[m]), default=0)
                changed = True
    return {
        (m, "failed", None, None) if m in failed else (m, "blocked", min(causes[m]), None) if causes[m]
        else (m, "buildable", None, level[m]) if m in level else (m, "circular", None, None)
        for m in models
    }


def status(spark, models, edges, failed):
    frames = (
        spark.createDataFrame([(m,) for m in models], "model STRING"),
        spark.createDataFrame(edges, "model STRING, needs STRING"),
        spark.createDataFrame([(m,) for m in failed], "model STRING"),
    )
    rows = [tuple(r) for r in deps.build_status(*frames).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


GRAPHS = {
    "empty": ([], [], []),
    "no edges": (["a", "b"], [], ["b"]),
    "diamond": (list("abcde"), [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("d", "b"), ("e", None)], []),
    "failed inside": (list("abcd"), [("b", "a"), ("c", "b"), ("d", "a")], ["b", "not there"]),
    "circle": (list("abcdef"), [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "f")], []),
    "circle through a failed one": (list("abcd"), [("a", "b"), ("b", "a"), ("c", "a"), ("d", "d")], ["a"]),
    "missing input": (list("abc"), [("a", "zz"), ("b", "a"), ("c", "yy"), ("b", "c"), ("nobody", "xx")], []),
    "needs itself": (["a", "b"], [("a", "a"), ("b", "a")], []),
    "chain": ([f"{k:02}" for k in range(12)], [(f"{k + 1:02}", f"{k:02}") for k in range(11)], []),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_golden_graphs(spark, name):
    assert status(spark, *GRAPHS[name]) == plain(*GRAPHS[name])


def test_random_graph(spark):
    rng = random.Random(4)
    models = [f"m{k}" for k in range(60)]
    edges = [(rng.choice(models), rng.choice([*models, "gone"])) for _ in range(70)]
    assert status(spark, models, edges, models[:2]) == plain(models, edges, models[:2])
