"""Ranked search, source divergence and vector graphs against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_rows import PASSAGE, PROSE, same
from panelwright.llm import ranked_search, source_divergence, vector_graph
from panelwright.llm.queries import LLM_QUERIES
from panelwright.plans.given_tables import table

SF = "/root/testdata/sf0.001"

# ---- ranked search

ITEMS = [
    (1, PASSAGE), (2, "the quiet hills"), (3, None), (4, ""), (5, PASSAGE), (5, "common1 common2 number"), (6, "be be be"),
    (7, "?!"), (None, "Copy of a TEXT w3x3"), (8, "nowhere-to-be-found"),
]


@pytest.mark.parametrize("k, pass_bytes, seeds", [(50, 1 << 20, 20_000), (3, 60, 20_000), (2, 1 << 20, 8)])
def test_ranked_search(spark, docs, rows, none, monkeypatch, k, pass_bytes, seeds):
    monkeypatch.setattr(ranked_search, "SEED_ROWS", seeds)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id LONG, text STRING, rank INT")
    found = ranked_search.ranked_search(docs, items, k, pass_bytes=pass_bytes)
    same(found.collect(), brute.ranked_search(rows, ITEMS, k))
    assert ranked_search.ranked_search(none, items, k).count() == 0
    assert ranked_search.ranked_search(docs, items.where("false"), k).count() == 0


def test_small_blocks_and_batches_change_nothing(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 6)
    monkeypatch.setattr(ranked_search, "CELLS", 100)
    items = spark.createDataFrame(ITEMS, "item_id LONG, text STRING")
    same(ranked_search.ranked_search(docs, items, 4).collect(), brute.ranked_search(rows, ITEMS, 4))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    weights = rng.integers(1, 5000, 60)
    items = [(n, np.unique(rng.integers(0, 60, 6))) for n in range(40)]
    impacts = np.where(rng.random((3000, 60)) < 0.1, rng.integers(1, 10**6, (3000, 60)), 0).astype(float)
    block = ranked_search.Block(items, weights, {}, 5)
    scored = []
    score = block._score

    def counting(nodes, rows, ids, part):
        scored.append(len(nodes) * len(rows))
        score(nodes, rows, ids, part)

    block._score = counting
    block.search(list(range(3000)), impacts[:, block.terms])
    dense = np.zeros((40, 60))
    for n, terms in items:
        dense[n, terms] = weights[terms]
    exact = impacts @ dense.T
    for node, best in block.best.items():
        n = block.item[node]
        order = np.lexsort((np.arange(3000), -exact[:, n]))[:5]
        assert sorted((-e[0], e[3]) for e in best) == [(-exact[d, n], d) for d in order]
    assert sum(scored) < 0.5 * 40 * 3000


def test_long_items_use_whole_numbers():
    terms = np.arange(3)
    block = ranked_search.Block([(0, terms)], np.array([1 << 40] * 3), {}, 2)
    assert block.kind == np.int64
    block.search([7, 8], np.array([[1, 0, 0], [10**6, 10**6, 1]], dtype=np.int64))
    assert sorted(e[0] for e in next(iter(block.best.values()))) == [1 << 40, (2 * 10**6 + 1) << 40]


# ---- source divergence

@pytest.fixture(scope="module")
def sources(rows):
    langs = ["en", "de", None, ""]
    data = [(t, langs[k % 4], f"s{k % 3}" if k % 7 else None) for k, (_, t) in enumerate(rows)]
    return data + [("zz", "xx", "only"), (None, "xx", "empty"), ("yy", "yy", "alone"), ("Ä" * 40_000, "en", "s1")] + [
        (f"{PROSE} über ß{k % 3} Ü", "en", f"s{k % 5}") for k in range(60)
    ]


@pytest.mark.parametrize("least, block", [(10, 1 << 16), (2, 5), (10**6, 4)])
def test_source_divergence(spark, sources, least, block):
    df = spark.createDataFrame([(*s, "x", 1, 2) for s in sources], "text STRING, lang STRING, source STRING, term STRING, n INT, rank INT")
    found = source_divergence.source_divergence(df.repartition(3), least_docs=least, block_terms=block)
    same(found.collect(), brute.source_divergence(sources, least, 10))
    assert source_divergence.source_divergence(df.where("false")).count() == 0


def test_a_full_table_of_counts_is_given_on(spark, sources, monkeypatch):
    monkeypatch.setattr(source_divergence, "TABLE_TERMS", 3)
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", 3)
    df = spark.createDataFrame(sources, "text STRING, lang STRING, source STRING")
    same(source_divergence.source_divergence(df, least_docs=2).collect(), brute.source_divergence(sources, 2, 10))


def test_shares_are_exact_for_large_counts():
    for count, total in ((0, 7), (5 * 10**12, 8 * 10**15), (8 * 10**15, 8 * 10**15 + 2), (123456789012345, 987654321098765)):
        expected = 1 + (10**9 * (count + 2)) // total
        assert source_divergence.shares(np.array([count]), np.array([total]))[0] == expected


def test_merged_value_equals_the_dense_sum():
    rng = np.random.default_rng(2)
    for terms in (0, 1, 50):
        a, b = (np.where(rng.random(terms) < 0.4, rng.integers(1, 90, terms), 0) for _ in "ab")
        x, y = (int(c.sum()) + 2 * terms + 5 for c in (a, b))
        sparse = [(np.flatnonzero(c) + 1, c[c > 0]) for c in (a, b)]
        expected = source_divergence.divergence(source_divergence.shares(a, x), source_divergence.shares(b, y)).sum() if terms else 0
        for first, second in (((*sparse[0], x), (*sparse[1], y)), ((*sparse[1], y), (*sparse[0], x))):
            assert source_divergence.merged_value(*first, *second, terms) == expected


# ---- vector graphs

@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(11)
    clusters = rng.normal(size=(6, 8))
    data = [(k, (clusters[k % 6] + 0.3 * rng.normal(size=8)).round(3).tolist()) for k in range(600)]
    data += [(1000 + k, data[3][1]) for k in range(300)]  # a third of all rows are one vector
    data += [(2000 + k, [1.0, 2.0, 3.0]) for k in range(3)] + [(2010, [3.0, 1.0, 0.0])]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 8, [None] + [1.0] * 7, [nan] + [1.0] * 7, [inf] + [1.0] * 7]
    data += [(3000 + 50 * k, v) for k, v in enumerate(odd)] + [(None, [1.0] * 8), (4000, [5.0])]
    return data + [(4050, [1e200] * 4), (4051, [1e-200, 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("shard_rows, query_rows", [(16_384, 16_384), (100, 7)])
def test_nearest(spark, vectors, shard_rows, query_rows):
    df = spark.createDataFrame([(*v, 1, "x") for v in vectors], "vec_id LONG, embedding ARRAY<DOUBLE>, rank INT, score STRING").repartition(4)
    found = vector_graph.nearest(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=query_rows).collect()
    expected = brute.nearest(vectors, {i for i, _ in vectors if i is not None and i % 50 == 0}, 5)
    got = {}
    for query, rank, vec, score in sorted(tuple(r) for r in found):
        got.setdefault(query, []).append((vec, score))
        assert rank == len(got[query])
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in expected.items() if x}
    assert all(abs(s - t) < 1e-12 for q in got for (_, s), (_, t) in zip(got[q], expected[q]))
    assert vector_graph.nearest(df.where("false"), F.lit(True)).count() == 0


def test_repeated_rows_are_no_candidates_of_each_other(spark):
    rows = [(0, [1.0, 0.0])] * 9 + [(1, [1.0, 0.1]), (2, [0.0, 1.0])]
    found = vector_graph.nearest(spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>"), F.col("vec_id") == 0)
    assert [(r["rank"], r["vec_id"]) for r in found.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_graph_reaches_every_node_and_its_recall_is_high():
    rng = np.random.default_rng(1)
    clusters = rng.normal(size=(40, 32)) * 4
    for points in (rng.normal(size=(3000, 32)), clusters[np.arange(3000) % 40] + 0.05 * rng.normal(size=(3000, 32))):
        order, sizes = vector_graph.level_sizes(rng.integers(-(1 << 62), 1 << 62, 3000))
        unit = vector_graph.units(points[order])
        graph = vector_graph.Graph.built(unit, sizes)
        assert len(sizes) > 1 and all(len(x) == n for x, n in zip(graph.links, sizes))
        exact = np.argsort(-(unit[:200] @ unit.T), axis=1, kind="stable")[:, :10]
        found = graph.search(unit[:200], 10)
        assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact.tolist(), found.tolist())]) > 0.97
        assert (graph.search(unit, 1)[:, 0] == np.arange(3000)).mean() > 0.995


def test_recall_on_the_given_vectors(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    expected = brute.nearest(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    found = {}
    for r in LLM_QUERIES["op13_vector_graph"](spark, SF).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(found) == set(expected)
    assert np.mean([len(found[q] & {i for i, _ in x}) / 5 for q, x in expected.items()]) >= 0.9
