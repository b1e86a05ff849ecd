"""Benchmark decontamination by Wu-Manber search over words.

A window is 13 consecutive words of a benchmark item; an item with fewer words is
one window. All windows of one length form a pattern set: a shift table over blocks
of two words skips positions where no window can end, buckets by the last block
select the windows to test, and a direct comparison confirms each occurrence.

The benchmark is a stated query set. It is broadcast in blocks of a checked number of
words; a task builds the tables of the blocks of a pass once, at most ``PASS_BLOCKS`` of
them, and keeps them for all its documents. A larger benchmark is searched in several
passes, each over all documents, with the hits so far carried along. Its items are read
as passes need them: the driver holds the blocks of one pass, not all items.

Defined results: null and empty texts have no words, no hits and no items. Items
without words have no window. Equal items all count. Repeated document rows are judged
row by row; other columns of the input are not read.
"""

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.texts import folded_words, map_texts, typed
from panelwright.session import stored

WINDOW = 13
BLOCK_WORDS = 200_000  # of items that share tables, about 100 MB
PASS_BLOCKS = 4  # whose tables a task holds at once
PASS_BYTES = 128 << 20  # of benchmark text that is broadcast for one pass over the documents


class WuManber:
    """Occurrences of windows of one length in sequences of word numbers."""

    def __init__(self, length: int, block: int = 2):
        self.length, self.block = length, min(block, length)
        self.farthest = length - self.block + 1
        self.shifts: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple[list[int], int, int]]] = defaultdict(list)

    def add(self, words: list[int], at: int, owner: int) -> None:
        """The window of ``words`` that starts at ``at``."""
        size = self.block
        for end in range(size, self.length + 1):
            key = tuple(words[at + end - size: at + end])
            shift = self.length - end
            if shift < self.shifts.get(key, self.farthest):
                self.shifts[key] = shift
        self.buckets[key].append((words, at, owner))

    def search(self, text: list[int]) -> Iterator[tuple[int, int]]:
        """(start, owner) of every occurrence."""
        size, length, farthest = self.block, self.length, self.farthest
        shifts, buckets = self.shifts, self.buckets
        end, stop = length, len(text)
        while end <= stop:
            key = tuple(text[end - size: end])
            shift = shifts.get(key, farthest)
            if shift:
                end += shift
                continue
            start = end - length
            found = text[start:end]
            for words, at, owner in buckets[key]:
                if words[at: at + length] == found:
                    yield start, owner
            end += 1


class Search:
    """The windows of a block of items, in one pattern set per length."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.numbers: dict[bytes, int] = {}
        self.sets: dict[int, WuManber] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in folded_words(text)]
            length = min(WINDOW, len(words))
            if length:
                patterns = self.sets.setdefault(length, WuManber(length))
                for at in range(len(words) - length + 1):
                    patterns.add(words, at, item)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words that windows cover, and the items they come from."""
        number = self.numbers.get
        text = [number(w, 0) for w in words]
        spans, owners = [], set()
        for length, patterns in self.sets.items():
            for start, owner in patterns.search(text):
                spans.append((start, start + length))
                owners.add(owner)
        return spans, owners


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps, covering the same words."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _passes(
    benchmark: DataFrame, item_col: str, text_col: str, pass_bytes: int
) -> Iterator[tuple[list[Broadcast], bool]]:
    """The items in passes of broadcast blocks, read partition by partition, and whether a pass is the last.

    Each item is one row of (id, UTF-8 text). No more is read than one item beyond a pass.
    """
    broadcast = benchmark.sparkSession.sparkContext.broadcast
    blocks: list[Broadcast] = []
    block: list[tuple] = []
    words = size = 0
    rows = benchmark.select(item_col, F.col(text_col).cast("binary")).where(F.length(text_col) > 0).distinct()
    for item, text in rows.toLocalIterator():
        text = bytes(text)
        n = len(folded_words(text))
        if block and words + n > BLOCK_WORDS:
            blocks.append(broadcast(block))
            block, words = [], 0
            if len(blocks) == PASS_BLOCKS:
                yield blocks, False
                blocks, size = [], 0
        if (blocks or block) and size + len(text) > pass_bytes:
            yield [*blocks, broadcast(block)] if block else blocks, False
            blocks, block, words, size = [], [], 0, 0
        block.append((item, text))
        words += n
        size += len(text)
    yield [*blocks, broadcast(block)] if block else blocks, True


def benchmark_hits(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """One row per document: id, n_words, covered spans of words, items with an occurring window."""
    item_type = benchmark.schema[item_col].dataType.simpleString()
    fields = f"n_words long, spans array<struct<first:int,end:int>>, items array<{item_type}>"
    frame = df.select(id_col, text_col)
    for sent, last in _passes(benchmark, item_col, item_text_col, pass_bytes):

        def start(sent=sent, last=last):
            searches = [Search(block.value) for block in sent]

            def step(ids, texts, *before):
                words = [folded_words(t) for t in texts]
                spans = [[(s["first"], s["end"]) for s in x] for x in before[1]] if before else [[] for _ in ids]
                items = [set(x) for x in before[2]] if before else [set() for _ in ids]
                for search in searches:
                    for i, w in enumerate(words):
                        more, owners = search.hits(w)
                        spans[i] += more
                        items[i] |= owners
                spans = [[{"first": a, "end": b} for a, b in merged(s)] for s in spans]
                head = [ids] if last else [ids, pa.array(texts, pa.binary()).cast(pa.string(), safe=False)]
                return [*head, [len(w) for w in words], spans, [list(i) for i in items]]

            return step

        kept = "" if last else f"`{text_col}` string, "
        frame = map_texts(frame, list(frame.columns), start, typed(df, id_col, kept + fields))
        if not last:
            frame = stored(frame, "benchmark-hits")
            for block in sent:
                block.destroy()
    return frame


def contamination(df: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """One row per document with the contamination verdict.

    Contaminated are documents with at least one hit and hits on at least a twentieth
    of their words.
    """
    id_col = names.get("id_col", "doc_id")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return (
        benchmark_hits(df, benchmark, **names)
        .select(id_col, "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                F.sha2(named, 256).alias("items_sha256"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows that are not contaminated, with all their columns.

    Rows that share an id go together; rows with a null id are judged by their text alone.
    """
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    keyed = df.withColumn("__key", F.xxhash64(text_col))
    judged = contamination(
        df.select(F.struct(id_col, F.xxhash64(text_col).alias("hash")).alias("__id"), F.col(text_col).alias("__text")),
        benchmark, **{**names, "id_col": "__id", "text_col": "__text"},
    )
    gone = judged.where("contaminated").select(
        F.col(f"__id.`{id_col}`").alias("__gone"), F.col("__id.hash").alias("__hash")
    ).distinct()
    same = keyed[id_col].eqNullSafe(gone["__gone"]) & (keyed["__key"] == gone["__hash"])
    return keyed.join(gone, same, "left_anti").drop("__key")
