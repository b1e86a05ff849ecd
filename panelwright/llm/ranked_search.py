"""Ranked lexical search with two trees, one over items and one over documents.

An item is a set of weighted terms, a document a sparse vector of impacts (what one
occurrence count in a text of this length is worth). The score of a pair is the sum of
weight times impact over the item's terms, in whole numbers.

1. Documents become vectors over the terms that items have, in one pass without an
   exchange; document counts per term and the lengths of all texts give the weights.
2. A task takes its documents in batches and builds a tree over each batch; a node holds
   the largest impact of each term below it. The items have a tree of their own, whose
   nodes hold the largest weight of each term. The product of two nodes bounds every pair
   below them. Both trees are descended together, and a pair of nodes goes when its bound
   is below the weakest k-th best score of the node's items: a whole batch at once. A
   bound equal to that score stays, so ties are exact.
3. Each task returns at most k documents per item; these are cut to k in two steps, so
   that one item's rows never meet in one task before they are few.

The k-th best scores that tasks start from come from a search of about ``SEED_ROWS`` of the
documents. They are lower bounds of the final ones whatever rows these are, so they
decide only how much is pruned, never a result. Items are read in passes of ``PASS_BYTES`` of
text, the bound of what is broadcast; documents are read once per pass.

Defined results: a null or empty text has no terms, is not counted and never found; an item
without terms has no rows. Repeated document rows are documents of their own, repeated
items are ranked each for itself. A null document id comes after others of the same score.
Very long texts are counted whole; a task holds one such text at a time. Empty tables give
no rows. Other columns do not matter, whatever their names.
"""

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructType
from pyspark.sql.window import Window

from panelwright.llm.texts import folded_words, map_texts, reachable
from panelwright.session import stored

PASS_BYTES = 4 << 20  # of item text that one pass broadcasts
BLOCK_TERMS, BLOCK_ITEMS = 4096, 512  # of the items that share a tree; a longer item has a block of its own
CELLS = 1 << 22  # of a batch's matrix of documents and terms
LEAF = 8  # documents
SEED_ROWS = 20_000
SALTS = 64
EXACT = 1 << 53  # below it whole numbers in doubles are exact
IMPACT = 10**6  # the largest impact there is


class Tree:
    """A binary tree over the rows of a matrix, whose nodes hold the maximum of every column.

    A node is cut by the column that is present in about half of its rows; if no column
    tells them apart, at the median of their sums.
    """

    def __init__(self, rows: np.ndarray, leaf: int):
        present, sums = rows > 0, rows.sum(axis=1)
        self.members: list[np.ndarray] = [np.arange(len(rows))]
        self.left, self.right, self.parent = [], [], [-1]
        node = 0
        while node < len(self.members):
            own = self.members[node]
            if len(own) > leaf:
                for side in _halves(own, present, sums):
                    self.members.append(side)
                    self.parent.append(node)
                self.left.append(len(self.members) - 2)
                self.right.append(len(self.members) - 1)
            else:
                self.left.append(-1)
                self.right.append(-1)
            node += 1
        self.maxima = np.empty((node, rows.shape[1]), dtype=rows.dtype)
        for node in reversed(range(node)):
            if self.left[node] < 0:
                rows[self.members[node]].max(axis=0, out=self.maxima[node])
            else:
                np.maximum(self.maxima[self.left[node]], self.maxima[self.right[node]], out=self.maxima[node])


def _halves(own: np.ndarray, present: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.count_nonzero(present[own], axis=0)
    best = int(np.abs(2 * counts - len(own)).argmin())
    if 8 * min(counts[best], len(own) - counts[best]) >= len(own):
        has = present[own, best]
        return own[has], own[~has]
    by_sum = own[np.argsort(sums[own], kind="stable")]
    return by_sum[: len(own) // 2], by_sum[len(own) // 2:]


class Block:
    """Items that are searched together: their tree, its nodes' maxima as sparse rows, their best documents."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weights: np.ndarray, floors: dict[int, int], k: int):
        self.terms = np.unique(np.concatenate([terms for _, terms in items]))
        total = max(int(weights[terms].sum()) for _, terms in items) * IMPACT
        self.kind = np.float64 if total < EXACT else np.int64
        dense = np.zeros((len(items), len(self.terms)), dtype=self.kind)
        for row, (_, terms) in enumerate(items):
            columns = np.searchsorted(self.terms, terms)
            dense[row, columns] = weights[self.terms[columns]]
        tree = Tree(dense, 1)
        self.left, self.right, self.parent = np.array(tree.left), np.array(tree.right), tree.parent
        node, self.columns = np.nonzero(tree.maxima)
        self.weights = tree.maxima[node, self.columns]
        self.sizes = np.bincount(node, minlength=len(tree.maxima))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.item = [items[m[0]][0] if a < 0 else None for m, a in zip(tree.members, tree.left)]
        self.best: dict[int, list] = {n: [] for n, i in enumerate(self.item) if i is not None}
        self.k = k
        # What a score must reach: at least 1, as scores of 0 do not count.
        self.lowest = np.ones(len(self.item), dtype=self.kind)
        for n in reversed(range(len(self.item))):
            if self.item[n] is not None:
                self.lowest[n] = max(1, floors.get(self.item[n], 1))
            else:
                self.lowest[n] = min(self.lowest[self.left[n]], self.lowest[self.right[n]])

    def _entries(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the nodes' sparse rows, and where each begins among them."""
        sizes = self.sizes[nodes]
        begins = np.cumsum(sizes) - sizes
        return np.repeat(self.starts[nodes] - begins, sizes) + np.arange(int(sizes.sum())), begins

    def open(self, nodes: np.ndarray, maxima: np.ndarray) -> np.ndarray:
        """The item nodes that may hold a pair with a document below the node of these maxima."""
        nodes = nodes[self.sizes[nodes] > 0]
        if not len(nodes):
            return nodes
        at, begins = self._entries(nodes)
        bounds = np.add.reduceat(self.weights[at] * maxima[self.columns[at]], begins)
        return nodes[bounds >= self.lowest[nodes]]

    def below(self, nodes: np.ndarray, maxima: np.ndarray) -> np.ndarray:
        """The nodes one level further down, as far as their bounds allow; items stay."""
        inner = nodes[self.left[nodes] >= 0]
        if not len(inner):
            return nodes
        children = self.open(np.concatenate([self.left[inner], self.right[inner]]), maxima)
        return np.concatenate([nodes[self.left[nodes] < 0], children])

    def search(self, ids: list, impacts: np.ndarray) -> None:
        """Descends both trees; ``impacts`` has a row per document and a column per term."""
        tree = Tree(impacts, LEAF)
        stack = [(0, np.zeros(1, dtype=np.int64))]
        while stack:
            node, active = stack.pop()
            maxima = tree.maxima[node]
            active = self.below(self.open(active, maxima), maxima)
            if tree.left[node] < 0:
                while len(active) and (self.left[active] >= 0).any():
                    active = self.below(active, maxima)
                if len(active):
                    self._score(active, tree.members[node], ids, impacts)
            elif len(active):
                stack += [(tree.left[node], active), (tree.right[node], active)]

    def _score(self, nodes: np.ndarray, rows: np.ndarray, ids: list, impacts: np.ndarray) -> None:
        at, begins = self._entries(nodes)
        products = impacts[rows][:, self.columns[at]] * self.weights[at]
        scores = np.add.reduceat(products, begins, axis=1)
        for row, position in zip(*np.nonzero(scores >= self.lowest[nodes])):
            self._offer(int(nodes[position]), int(scores[row, position]), ids[rows[row]])

    def _offer(self, node: int, score: int, doc) -> None:
        best, entry = self.best[node], (score, doc is not None, -(doc or 0), doc)
        if len(best) < self.k:
            heapq.heappush(best, entry)
            if len(best) < self.k:
                return
        elif entry > best[0]:
            heapq.heapreplace(best, entry)
        if best[0][0] > self.lowest[node]:
            self.lowest[node] = best[0][0]
            node = self.parent[node]
            while node >= 0:
                weakest = min(self.lowest[self.left[node]], self.lowest[self.right[node]])
                if weakest == self.lowest[node]:
                    break
                self.lowest[node] = weakest
                node = self.parent[node]


def _passes(items: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> Iterator[list[tuple]]:
    """(id, terms) of items that have terms, in passes; the driver holds one pass."""
    held, size = [], 0
    for item, text in items.select(item_col, F.col(text_col).cast("binary")).toLocalIterator():
        terms = set(folded_words(bytes(text))) if text else ()
        if not terms:
            continue
        if held and size + len(text) > pass_bytes:
            yield held
            held, size = [], 0
        held.append((item, terms))
        size += len(text)
    if held:
        yield held


def _vectors(df: DataFrame, id_col: str, text_col: str, number) -> DataFrame:
    """Id, number of terms, and the numbers and occurrences of the terms that items have."""

    def start():
        known = number.value

        def step(ids, texts):
            sizes, terms, counts = [], [], []
            for text in texts:
                words = folded_words(text)
                found = Counter(map(known.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found))
                counts.append(list(found.values()))
            return [ids, sizes, terms, counts]

        return step

    schema = StructType.fromDDL("id long, n long, terms array<int>, counts array<int>")
    return map_texts(df, [F.col(id_col).cast("long").alias("id"), text_col], start, schema)


def _document_counts(vectors: DataFrame) -> np.ndarray:
    """How many documents hold each term, as far as the largest number of a found term."""
    schema = to_arrow_schema(StructType.fromDDL("term int, docs long"))

    def run(batches):
        totals = np.zeros(0, dtype=np.int64)
        for batch in batches:
            found = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(totals))
            found[: len(totals)] += totals
            totals = found
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(totals[held])], schema=schema)

    rows = (
        vectors.select("terms").mapInArrow(run, "term int, docs long")
        .groupBy("term").agg(F.sum("docs").alias("docs")).collect()  # as many as the pass has terms
    )
    counts = np.zeros(max((r["term"] for r in rows), default=-1) + 1, dtype=np.int64)
    for term, docs in rows:
        counts[term] = docs
    return counts


def _blocks(items: list[tuple[int, np.ndarray]], docs: np.ndarray) -> list[list[tuple[int, np.ndarray]]]:
    """Items in blocks; those that share common terms stand together."""
    rank = np.empty(len(docs), dtype=np.int64)
    rank[np.argsort(-docs, kind="stable")] = np.arange(len(docs))
    ordered = sorted(items, key=lambda item: (np.sort(rank[item[1]]).tolist(), item[0]))
    blocks, held, terms = [], [], set()
    for item in ordered:
        union = terms.union(item[1].tolist())
        if held and (len(union) > BLOCK_TERMS or len(held) == BLOCK_ITEMS):
            blocks.append(held)
            held, union = [], set(item[1].tolist())
        held.append(item)
        terms = union
    return [*blocks, held]


def _found(vectors: DataFrame, sent, documents: int, length: int, floors: dict[int, int], k: int) -> DataFrame:
    """(number of the item, document, score): at most k per item and task, all that can be among the k best."""
    schema = to_arrow_schema(StructType.fromDDL("item int, id long, score long"))

    def run(batches):
        parts, weights = sent.value
        blocks = [Block(items, weights, floors, k) for items in parts]
        place = np.full(len(weights), -1, dtype=np.int64)
        for batch in batches:
            for block in blocks:
                step = max(LEAF, CELLS // len(block.terms))
                for at in range(0, batch.num_rows, step):
                    _batch(block, batch.slice(at, step), place, documents, length)
        rows = [(block.item[n], e[3], e[0]) for block in blocks for n, best in block.best.items() for e in best]
        for at in range(0, len(rows), 50_000):
            columns = zip(*rows[at: at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return vectors.mapInArrow(run, "item int, id long, score long")


def _batch(block: Block, batch: pa.RecordBatch, place: np.ndarray, documents: int, length: int) -> None:
    """Impacts of the batch's documents that have a term of the block, then the search."""
    ids, n, terms, counts = batch.columns
    rows = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
    terms, counts = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
    place[block.terms] = np.arange(len(block.terms))
    columns = place[terms]
    place[block.terms] = -1
    held = columns >= 0
    rows, columns, counts = rows[held], columns[held], counts[held]
    used, rows = np.unique(rows, return_inverse=True)
    if len(used):
        m = 50 + (50 * n.to_numpy()[used] * documents) // length
        impacts = np.zeros((len(used), len(block.terms)), dtype=block.kind)
        impacts[rows, columns] = (10**9 * counts) // (1000 * counts + 20 * m[rows])
        block.search(ids.take(pa.array(used)).to_pylist(), impacts)


def _best(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def _best_of_all(found: DataFrame, k: int) -> DataFrame:
    """The k best per item; each item's rows are cut to k in ``SALTS`` tasks first."""
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS)))
    return _best(_best(salted, k, ["item", "salt"]).drop("rank", "salt"), k, ["item"])


def ranked_search(
    df: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """The k best documents of every item with a score above 0: item, rank, document, score."""
    spark = df.sparkSession
    reachable(spark)
    item_type = items.schema[item_col].dataType
    results = []
    for held in _passes(items, item_col, item_text_col, pass_bytes):
        number: dict[bytes, int] = {}
        for _, terms in held:
            for term in terms:
                number.setdefault(term, len(number))
        numbered = [(i, np.array(sorted(number[t] for t in terms))) for i, (_, terms) in enumerate(held)]
        sent = spark.sparkContext.broadcast(number)
        vectors = stored(_vectors(df, id_col, text_col, sent), "term-vectors")
        sent.destroy()
        documents, length, rows = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.count("*")).first()
        if not length:
            continue
        docs = np.zeros(len(number), dtype=np.int64)
        counted = _document_counts(vectors)
        docs[: len(counted)] = counted
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in docs])
        sent = spark.sparkContext.broadcast((_blocks(numbered, docs), weights))
        floors = {}
        if rows > 4 * SEED_ROWS:
            seeds = _found(vectors.sample(SEED_ROWS / rows, 7), sent, documents, length, {}, k)
            floors = dict(_best_of_all(seeds, k).where(F.col("rank") == k).select("item", "score").collect())
        found = stored(_found(vectors, sent, documents, length, floors, k), "ranked-candidates")
        sent.destroy()
        # As many rows as the pass has items; joined, not broadcast by a hint.
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(held)],
                                      StructType.fromDDL("item int").add("name", item_type))
        results.append(_best_of_all(found, k).join(names, "item").select(
            F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score"
        ))
    if not results:
        schema = StructType().add(item_col, item_type).add("rank", IntegerType()).add(id_col, LongType()).add("score", LongType())
        return spark.createDataFrame([], schema)
    whole = results[0]
    for part in results[1:]:
        whole = whole.unionByName(part)
    return whole
