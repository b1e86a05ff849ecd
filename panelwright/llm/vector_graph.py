"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

1. Equal vectors are one class, which remembers its smallest ids; copies cost nothing more
   and cannot fill a graph's links. Classes are dealt into shards of about ``SHARD_ROWS``.
2. Each shard becomes one graph. Nodes are ordered by their level, so that a level's
   nodes are a prefix and its links one flat array of neighbour numbers. Nodes are
   inserted in batches that at most double the graph: a beam search over what is there and
   the batch itself give candidates, of which those nearer to the node than to a chosen
   neighbour are linked, both ways.
3. Every query searches every shard: down the levels with a narrow beam, then over all nodes
   with a wide one. Queries come in blocks, and a task holds one graph and one block. What
   a shard finds is scored again in double precision on the original vectors; the shards'
   results are merged per query.

Nodes that no path reaches are kept as further entries, so every row can be found. All
random choices come from hashes of ids and vectors: equal tables give equal graphs.

Defined results: vectors that are null, empty or zero or hold a null or non-finite component
take no part, neither as queries nor as candidates; nor do rows with a null id. Vectors are
compared with those of the same length only. A query gets all candidates if there are no
more than k. Rows that share an id are not candidates of one another. Empty tables give no
rows. Other columns do not matter, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from panelwright.llm.texts import reachable
from panelwright.session import stored

SHARD_ROWS = 16_384  # classes in a shard, on average
QUERY_ROWS = 16_384  # query vectors in a block, on average
LINKS = 16  # per node on upper levels, twice as many on the lowest
BUILD_BEAM, SEARCH_BEAM = 64, 96
WIDTH = 4  # nodes that a beam opens at once
FIRST, BATCH = 64, 512
CANDIDATES = 48  # that compete for links
SLACK = 8  # classes scored in double precision beyond those asked for


def units(vectors: np.ndarray) -> np.ndarray:
    """Single-precision vectors of length 1, for the search."""
    scaled = _scaled(vectors)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """In double precision, times a power of two that keeps squares in range."""
    vectors = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of rows of the one with rows of the other, in double precision."""
    left, right = _scaled(left), _scaled(right)
    norms = np.sqrt((left * left).sum(axis=1)) * np.sqrt((right * right).sum(axis=1))
    return (left * right).sum(axis=1) / norms


class Graph:
    """Levels of flat neighbour arrays over vectors that are ordered by level, the highest first."""

    def __init__(self, unit: np.ndarray, sizes: list[int], links: list[np.ndarray], entries: np.ndarray):
        self.unit, self.sizes, self.links, self.entries = unit, sizes, links, entries

    @classmethod
    def built(cls, unit: np.ndarray, sizes: list[int]) -> "Graph":
        """``sizes`` are the numbers of nodes per level, from the lowest level up."""
        links = [np.full((n, LINKS * (1 if level else 2)), -1, dtype=np.int32) for level, n in enumerate(sizes)]
        graph = cls(unit, sizes, links, np.zeros(1, dtype=np.int32))
        low, n = 0, len(unit)
        while low < n:
            high = min(n, max(FIRST, low + min(low, BATCH)))
            graph._insert(low, high)
            low = high
        graph.entries = graph._unreached()
        return graph

    def _insert(self, low: int, high: int) -> None:
        for level in range(len(self.sizes)):
            end = min(high, self.sizes[level])
            if end <= low:
                break
            new = np.arange(low, end)
            among = self.unit[new] @ self.unit[new].T
            np.fill_diagonal(among, -np.inf)
            near = np.argsort(-among, axis=1, kind="stable")[:, :LINKS]
            ids, sims = low + near, np.take_along_axis(among, near, axis=1)
            if low:
                found, found_sims = self._descended(self.unit[new], low, level, BUILD_BEAM)
                ids, sims = np.hstack([found, ids]), np.hstack([found_sims, sims])
            chosen = self._chosen(ids, sims, self.links[level].shape[1])
            self.links[level][new] = chosen
            self._link_back(level, new, chosen)

    def _link_back(self, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
        """Adds the new nodes to the links of their neighbours, which keep their best ones."""
        links = self.links[level]
        row, _ = np.nonzero(chosen >= 0)
        source, target = new[row], chosen[chosen >= 0]
        sims = (self.unit[source] * self.unit[target]).sum(axis=1)
        order = np.lexsort((-sims, target))
        source, target, sims = source[order], target[order], sims[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, counts)
        kept = place < links.shape[1]  # the nearest ones of those that came at once
        extra = np.full((len(nodes), links.shape[1]), -1, dtype=np.int64)
        extra_sims = np.full(extra.shape, -np.inf, dtype=np.float32)
        at = np.repeat(np.arange(len(nodes)), counts)
        extra[at[kept], place[kept]], extra_sims[at[kept], place[kept]] = source[kept], sims[kept]
        old = links[nodes].astype(np.int64)
        extra[(extra[:, :, None] == old[:, None, :]).any(axis=2)] = -1  # linked already
        extra_sims[extra < 0] = -np.inf
        old_sims = np.einsum("nd,nmd->nm", self.unit[nodes], self.unit[old])
        old_sims[old < 0] = -np.inf
        links[nodes] = self._chosen(np.hstack([old, extra]), np.hstack([old_sims, extra_sims]), links.shape[1])

    def _chosen(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to so many neighbours per row: first those nearer to it than to one chosen before, then the nearest."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, :max(CANDIDATES, most)]
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        there = sims > -np.inf
        vectors = self.unit[np.where(there, ids, 0)]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, dtype=bool)
        for j in range(ids.shape[1]):
            nearer = (between[:, j, :j] > sims[:, j, None]) & chosen[:, :j]
            chosen[:, j] = there[:, j] & ~nearer.any(axis=1) & (chosen[:, :j].sum(axis=1) < most)
        rank = np.where(chosen, 0, np.where(there, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        picked = np.where(np.take_along_axis(there, order, axis=1), np.take_along_axis(ids, order, axis=1), -1)
        if picked.shape[1] < most:
            picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
        return picked.astype(np.int32)

    def _descended(self, queries: np.ndarray, n: int, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes of a level among the first n nodes, found from the top level down."""
        starts = np.zeros((len(queries), 1), dtype=np.int64)
        for upper in reversed(range(level + 1, len(self.sizes))):
            starts, _ = self._beam(queries, starts, min(n, self.sizes[upper]), upper, WIDTH)
        return self._beam(queries, starts, min(n, self.sizes[level]), level, beam)

    def _beam(self, queries, starts, n, level, beam) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries at once; (ids, similarities) with -1 where fewer were found."""
        rows = np.arange(len(queries))
        links = self.links[level]
        seen = np.zeros((len(queries), n + 1), dtype=bool)  # the last column is for missing links
        seen[:, n] = True
        ids = np.full((len(queries), max(beam, starts.shape[1])), n, dtype=np.int64)
        sims = np.full(ids.shape, -np.inf, dtype=np.float32)
        starts = np.where((starts < 0) | (starts >= n), n, starts)
        ids[:, : starts.shape[1]] = starts
        sims[:, : starts.shape[1]] = np.einsum("qd,qsd->qs", queries, self.unit[np.where(starts == n, 0, starts)])
        sims[ids == n] = -np.inf
        seen[rows[:, None], ids] = True
        ids, sims = _top(ids, sims, beam)
        done = ids == n
        while True:
            active = np.flatnonzero(~done.all(axis=1))
            if not len(active):
                break
            waiting = ~done[active]
            pick = np.argsort(~waiting, axis=1, kind="stable")[:, :WIDTH]
            opened = np.take_along_axis(ids[active], pick, axis=1)
            opened[~np.take_along_axis(waiting, pick, axis=1)] = -1
            done[active[:, None], pick] = True
            found = []
            for w in range(opened.shape[1]):
                near = np.where(opened[:, w, None] >= 0, links[opened[:, w]], -1).astype(np.int64)
                near[(near < 0) | (near >= n)] = n
                near[seen[active[:, None], near]] = n
                seen[active[:, None], near] = True
                found.append(near)
            near = np.hstack(found)
            near_sims = np.full(near.shape, -np.inf, dtype=np.float32)
            row, place = np.nonzero(near < n)
            near_sims[row, place] = (queries[active[row]] * self.unit[near[row, place]]).sum(axis=1)
            both = np.hstack([ids[active], near]), np.hstack([sims[active], near_sims])
            opened_before = np.hstack([done[active], near == n])
            order = np.argsort(-both[1], axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(both[0], order, axis=1)
            sims[active] = np.take_along_axis(both[1], order, axis=1)
            done[active] = np.take_along_axis(opened_before, order, axis=1) | (ids[active] == n)
        return np.where(ids == n, -1, ids), sims

    def _unreached(self) -> np.ndarray:
        """The first node and one node of each part of the lowest level that no path from there reaches."""
        n, links = len(self.unit), self.links[0]
        reached, entries, front = np.zeros(n, dtype=bool), [0], np.zeros(1, dtype=np.int64)
        reached[0] = True
        while True:
            while len(front):
                near = np.unique(links[front])
                front = near[near >= 0]
                front = front[~reached[front]]
                reached[front] = True
            missing = int(np.argmin(reached))
            if reached[missing]:
                return np.array(entries, dtype=np.int32)
            entries.append(missing)
            reached[missing] = True
            front = np.array([missing])

    def search(self, queries: np.ndarray, most: int) -> np.ndarray:
        """Numbers of the nearest nodes of each unit vector, -1 where there are no more."""
        found = []
        beam = max(SEARCH_BEAM, most)
        for at in range(0, len(queries), BATCH):
            part = queries[at: at + BATCH]
            starts = np.zeros((len(part), 1), dtype=np.int64)
            for upper in reversed(range(1, len(self.sizes))):
                starts, _ = self._beam(part, starts, self.sizes[upper], upper, WIDTH)
            if len(self.entries) > 1:
                # The best of the further entries join the beam.
                sims = part @ self.unit[self.entries].T
                best = self.entries[np.argsort(-sims, axis=1, kind="stable")[:, :beam]].astype(np.int64)
                best[(best[:, :, None] == starts[:, None, :]).any(axis=2)] = -1
                starts = np.hstack([starts, best])
            ids, _ = self._beam(part, starts, len(self.unit), 0, beam)
            found.append(ids[:, :most])
        return np.vstack(found) if found else np.empty((0, most), dtype=np.int64)


def _top(ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def level_sizes(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """An order of the nodes by level, the highest first, and the nodes per level; levels come from hashes."""
    uniform = ((hashes.astype(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    levels = np.floor(-np.log(uniform) / np.log(LINKS)).astype(int)
    order = np.lexsort((hashes, -levels))
    return order, [int((levels >= level).sum()) for level in range(levels.max() + 1)]


_GRAPH = "vectors binary, ids array<array<bigint>>, sizes array<int>, links array<binary>, entries array<int>"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(len(column), -1)


def _built(shards: DataFrame, tasks: int) -> DataFrame:
    """One row per shard: its vectors, the ids of each class, its levels and flat neighbour arrays."""
    fields = f"dim int, shard int, {_GRAPH}"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def build(table: pa.Table) -> pa.Table:
        order, sizes = level_sizes(table.column("hash").to_numpy())
        vectors = _matrix(table.column("vector"))[order]
        graph = Graph.built(units(vectors), sizes)
        ids = table.column("ids").combine_chunks().take(pa.array(order)).to_pylist()
        row = {
            "dim": vectors.shape[1], "shard": table.column("shard")[0].as_py(), "vectors": vectors.tobytes(), "ids": ids,
            "sizes": sizes, "links": [x.tobytes() for x in graph.links], "entries": graph.entries.tolist(),
        }
        return pa.Table.from_pylist([row], schema=schema)

    # A given number of partitions: graphs take long to build, however few bytes they are made of.
    return shards.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(build, fields)


def _searched(graphs: DataFrame, queries: DataFrame, most: int, element: str, tasks: int) -> DataFrame:
    """(query class, id, score): the best ids of each shard for each query vector."""
    fields = "key struct<id:bigint,hash:bigint>, id long, score double"
    schema = to_arrow_schema(StructType.fromDDL(fields))
    kind = np.float32 if element == "float" else np.float64

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        row = left.to_pylist()[0]
        vectors = np.frombuffer(row["vectors"], dtype=kind).reshape(-1, row["dim"])
        sizes = row["sizes"]
        links = [np.frombuffer(x, dtype=np.int32).reshape(n, -1) for x, n in zip(row["links"], sizes)]
        graph = Graph(units(vectors), sizes, links, np.array(row["entries"], dtype=np.int32))
        given = _matrix(right.column("vector"))
        found = graph.search(units(given), most + SLACK)
        query, place = np.nonzero(found >= 0)
        node = found[query, place]
        scores = cosines(given[query], vectors[node])
        keys = right.column("key").combine_chunks()
        counts = np.array([len(x) for x in row["ids"]])[node]
        ids = np.fromiter((i for x in node for i in row["ids"][x]), np.int64, int(counts.sum()))
        query, scores = np.repeat(query, counts), np.repeat(scores, counts)
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        first = np.searchsorted(query, np.arange(len(given)))
        kept = np.arange(len(query)) - first[query] < most
        return pa.Table.from_arrays(
            [keys.take(pa.array(query[kept])), pa.array(ids[kept]), pa.array(scores[kept])], schema=schema
        )

    keys = ("dim", "shard", "block")
    left, right = (side.repartition(tasks, *keys).groupBy(*keys) for side in (graphs, queries))
    return left.cogroup(right).applyInArrow(search, fields)


def nearest(
    df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that ``queries`` selects."""
    reachable(df.sparkSession)
    element = df.schema[vector_col].dataType.elementType.simpleString()
    element = element if element == "float" else "double"
    valid = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("vector"),
                  queries.alias("asked"))
        .where(F.col("id").isNotNull() & valid)
    )
    # k + 1 ids of a class are enough: a query drops its own at most.
    by_id = Window.partitionBy("vector").orderBy("id")
    classes = stored(
        rows.select("id", "vector").withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
        .select("vector", "ids", F.xxhash64("vector").alias("hash"), F.size("vector").alias("dim")), "vector-classes",
    )
    sizes = classes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    shards = sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]
    shard = F.pmod(F.xxhash64("hash", F.col("ids")[0]), F.col("shards")).cast("int").alias("shard")
    graphs = stored(
        _built(classes.join(sizes, "dim").select("dim", shard, "vector", "ids", "hash"), shards), "shard-graphs"
    )

    asked = rows.where("asked").withColumn("hash", F.xxhash64("vector"))
    wanted = stored(
        asked.groupBy("hash", "vector").agg(F.min("id").alias("id"))
        .select(F.struct("id", "hash").alias("key"), "vector", F.size("vector").alias("dim")), "query-vectors",
    )
    blocks = max(1, -(-wanted.count() // query_rows))
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    sent = wanted.join(sizes, "dim").select(
        "dim", every, F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"), "key", "vector"
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = _searched(held, sent, k + 1, element, shards * blocks)
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), "id")
    entries = (
        found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("entries"))
    )
    named = wanted.select("key", F.col("vector").alias("same")).join(entries, "key")
    mine = asked.join(named, (F.col("hash") == F.col("key.hash")) & (F.col("vector") == F.col("same")))
    others = F.slice(F.filter("entries", lambda e: e["id"] != F.col("query_id")), 1, k)
    return (
        mine.select(F.col("id").alias("query_id"), "entries").distinct()
        .select("query_id", F.posexplode(others).alias("at", "entry"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("entry.id").alias("vec_id"), "entry.score")
    )
