"""How far the sources of a language differ in their use of words, pair by pair and term by term.

A group is a source within a language. Its share of a term is smoothed and kept as a whole
number of billionths; two groups differ at a term by the square of the difference of
their shares over the sum. Pairs of groups are priced over every kept term of the
language, those included that one or neither of them uses.

1. Tasks count terms per group before anything is exchanged; counts and document counts
   are then summed per (language, source, term) and per (language, term).
2. Kept terms are dealt into blocks by hash and numbered inside their block. A group's
   counts in a block are two sorted arrays, of term ids and of counts, of at most some
   ``BLOCK_TERMS`` entries however large the vocabulary is.
3. For each unordered pair of groups and block one merge of the two sparse arrays gives the
   pair's value: the smaller array looks its ids up in the larger one by galloping
   (bisection that starts from the last place), which prices the overlap, then terms that
   only one side has; terms that neither has all cost the same and are priced by their
   number. The value holds both ways.

All arithmetic is in whole numbers: shares by long division in three steps of a thousand, so
that nothing overflows below 9e15 occurrences.

Defined results: null text, language and source count as empty strings. A group without a
term has rows all the same; in a language without kept terms every pair costs 0. Rows that
are repeated count again. Very long texts are counted whole; a task holds one slice of texts
and a bounded table of counts. Empty tables give no rows. Other columns do not matter,
whatever their names.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from panelwright.llm.texts import reachable, slices
from panelwright.session import stored

LEAST_DOCS = 10
TOP = 10
BLOCK_TERMS = 1 << 16  # kept terms in a block, on average
TABLE_TERMS = 300_000  # entries of a task's table of counts before it is given on
BATCH_TERMS = 1 << 20  # array entries that a task merges at once

# ASCII letters and all bytes of other characters belong to terms; capitals become small.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_COUNTED = "lang string, source string, term string, n long, docs long"


def _terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _counted(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, occurrences, documents) of each task, and a row without a term per group."""
    reachable(df.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(_COUNTED))

    def given(table) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in table.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at: at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part)), pa.array([source] * len(part)),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n[t] for t in part]), pa.array([docs[t] for t in part]),
                ], schema=schema)
            yield pa.RecordBatch.from_pylist([{"lang": lang, "source": source, "n": 0, "docs": 0}], schema=schema)

    def run(batches):
        table = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for part in slices(batch, 0):
                texts = part.column(0).cast(pa.binary()).to_pylist()
                groups = defaultdict(list)
                for text, lang, source in zip(texts, part.column(1).to_pylist(), part.column(2).to_pylist()):
                    groups[lang, source].append(_terms(text) if text else [])
                for group, lists in groups.items():
                    n, docs = table[group]
                    n.update(chain.from_iterable(lists))
                    docs.update(chain.from_iterable(map(set, lists)))
                if sum(len(n) for n, _ in table.values()) > TABLE_TERMS:
                    yield from given(table)
                    table.clear()
        yield from given(table)

    columns = [F.col(text_col), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col)]]
    return df.select(*[c.alias(n) for c, n in zip(columns, ("text", "lang", "source"))]).mapInArrow(run, _COUNTED)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + the whole billionths of (count + 2) / total, exactly, for totals below 9e15."""
    rest, share = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest = rest % total
    return share + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def merged_value(
    ids: np.ndarray, counts: np.ndarray, total: int, other_ids: np.ndarray, other_counts: np.ndarray,
    other_total: int, terms: int,
) -> int:
    """The value of a pair over a block of so many terms, from two sorted sparse arrays."""
    if not terms:
        return 0
    if len(ids) > len(other_ids):
        ids, counts, total, other_ids, other_counts, other_total = (
            other_ids, other_counts, other_total, ids, counts, total
        )
    # Sorted keys: each look-up starts where the last one ended.
    places = np.searchsorted(other_ids, ids)
    held = places < len(other_ids)
    held[held] = other_ids[places[held]] == ids[held]
    shared = places[held]
    alone = np.ones(len(other_ids), dtype=bool)
    alone[shared] = False
    none, other_none = (shares(np.zeros(1, np.int64), t)[0] for t in (total, other_total))
    overlap = divergence(shares(counts[held], total), shares(other_counts[shared], other_total)).sum()
    left = divergence(shares(counts[~held], total), other_none).sum()
    right = divergence(none, shares(other_counts[alone], other_total)).sum()
    absent = terms - len(ids) - len(other_ids) + len(shared)
    return int(overlap) + int(left) + int(right) + absent * int(divergence(none, other_none))


def _pair_values(pairs: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each pair and block."""
    fields = "lang string, a string, b string, value long"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches):
        for batch in batches:
            lang, a, b, terms, totals, others, *arrays = batch.columns
            parts = []
            for array in arrays:
                offsets, flat = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
                parts.append([flat[x:y].astype(np.int64) for x, y in zip(offsets, offsets[1:])])
            values = [
                merged_value(i, c, t, j, d, u, n)
                for i, c, t, j, d, u, n in zip(
                    parts[0], parts[1], totals.to_pylist(), parts[2], parts[3], others.to_pylist(), terms.to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays([lang, a, b, pa.array(values, pa.int64())], schema=schema)

    return pairs.mapInArrow(run, fields)


def _share(count: Column, total: Column) -> Column:
    """``shares`` as an expression; integral division of decimals is exact."""
    billion = F.lit(10**9).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.call_function("div", billion, total.cast("decimal(20,0)")) + 1


def _groups(group_terms: DataFrame, counts: DataFrame, numbered: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total): what shares are parts of; also of groups without terms."""
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = numbered.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    every = group_terms.where(F.col("term").isNull()).select("lang", "source")
    return every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", (F.coalesce("total", F.lit(0)) + 2 * F.col("terms")).alias("total"),
        (F.col("lang_total") + 2 * F.col("terms")).alias("lang_total"),
    )


def _pairs(groups: DataFrame, counts: DataFrame, numbered: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two groups of a language, both ways."""
    blocks = numbered.groupBy("lang", "block").agg(F.count("*").alias("terms"))
    arrays = counts.groupBy("lang", "source", "block").agg(
        F.array_sort(F.collect_list(F.struct("id", "n"))).alias("entries")  # at most one per term of the block
    ).select("lang", "source", "block", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))
    grid = (
        groups.join(blocks, "lang", "left").join(arrays, ["lang", "source", "block"], "left")
        .select(
            "lang", F.coalesce("block", F.lit(0)).alias("block"), F.coalesce("terms", F.lit(0)).alias("terms"), "source",
            F.coalesce("total", F.lit(1)).alias("total"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"),
            F.coalesce("counts", F.array().cast("array<bigint>")).alias("counts"),
        )
    )
    grid = stored(grid, "group-arrays")
    other = grid.select(
        "lang", "block", F.col("source").alias("b"), F.col("total").alias("b_total"), F.col("ids").alias("b_ids"),
        F.col("counts").alias("b_counts"),
    )
    pairs = grid.withColumnRenamed("source", "a").join(other, ["lang", "block"]).where("a < b").select(
        "lang", "a", "b", "terms", "total", "b_total", "ids", "counts", "b_ids", "b_counts"
    )
    values = stored(_pair_values(pairs).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pair-values")
    return values.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        values.select("lang", "b", "a", "value")
    )


def source_divergence(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` has the value of each other source of the language; part ``term`` the terms
    that the group uses more than its language as a whole, the ``top`` most telling ones.
    Terms are kept that stand in at least ``least_docs`` documents of the language.
    """
    group_terms = stored(
        _counted(df, text_col, lang_col, source_col).groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "group-terms",
    )
    kept = stored(
        group_terms.where(F.col("term").isNotNull()).groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs), "kept-terms",
    )
    blocks = max(1, -(-kept.count() // block_terms))
    inside = Window.partitionBy("lang", "block").orderBy("term")
    numbered = stored(
        kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
        .select("lang", "term", "n", "block", F.row_number().over(inside).alias("id")), "numbered-terms",
    )
    counts = stored(
        group_terms.select("lang", "source", "term", "n")
        .join(numbered.withColumnRenamed("n", "lang_n"), ["lang", "term"]), "group-counts",
    )
    groups = stored(_groups(group_terms, counts, numbered), "groups")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value").withColumn(
            "rank", F.row_number().over(order)
        )

    p, q = F.col("p"), F.col("q")
    telling = (
        counts.where(F.col("n") > 0).join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), _share(F.col("n"), F.col("total")).alias("p"),
                _share(F.col("lang_n"), F.col("lang_total")).alias("q"))
        .where(p > q)
        .withColumn("value", F.call_function("div", (p - q) * (p - q), p + q))
    )
    return ranked(_pairs(groups, counts, numbered), "pair").union(
        ranked(telling, "term").where(F.col("rank") <= top)
    )
