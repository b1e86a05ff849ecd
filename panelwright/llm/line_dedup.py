"""Removal of repeated runs of lines, found by winnowing over line hashes.

A run is a sequence of whole lines of one document with at least ``min_words`` words.
A line goes if it lies in a run that also stands earlier, in the order of (id, line);
the first occurrence always stays.

How it is found, without comparing pairs of documents:

1. Every line has a digest. From each line the shortest window with ``min_words``
   words is taken in both directions, and the smallest digest in a window is its
   fingerprint. Equal windows choose equal fingerprints, so a repeated run cannot lack
   a repeated one.
2. Fingerprints are counted over all documents (pre-aggregated, so a line that stands
   in a third of the documents is one row per task); positions of repeated ones are
   joined back.
3. Around such positions the match is extended both ways: the windows that start
   and those that end at the neighbouring lines are named by a digest of their
   lines. Any line of a repeated run lies in a window inside that run, so the windows
   that stand earlier cover exactly the repeated runs, whichever copies share them.
4. The lines of later windows are deleted.

Defined results: a null text has no lines and stays null. Rows that agree in id and
text are one document and get the same result. Null ids come first. Other columns are
kept as they are; names beginning with ``__`` are reserved.
"""

from collections import deque

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.texts import map_texts, typed
from panelwright.session import stored

MIN_WORDS = 50


def windows(words: list[int], digests: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """(first, last, line of the fingerprint) of the shortest windows from and to each line."""
    forward, backward = [], []
    total, last, n = 0, -1, len(words)
    for first in range(n):
        while total < least and last + 1 < n:
            last += 1
            total += words[last]
        if total < least:
            break
        forward.append((first, last))
        total -= words[first]
    total = first = 0
    for last in range(n):
        total += words[last]
        while total - words[first] >= least and first < last:
            total -= words[first]
            first += 1
        if total >= least:
            backward.append((first, last))
    known = set(forward)
    return _minima(forward, digests) + _minima([w for w in backward if w not in known], digests)


def _minima(spans: list[tuple[int, int]], digests: list[bytes]) -> list[tuple[int, int, int]]:
    """The spans, whose ends never step back, with the line of the smallest digest (the last of equal ones)."""
    found, lines, reached = [], deque(), -1
    for first, last in spans:
        for line in range(max(reached + 1, first), last + 1):
            while lines and digests[lines[-1]] >= digests[line]:
                lines.pop()
            lines.append(line)
        reached = max(reached, last)
        while lines[0] < first:
            lines.popleft()
        found.append((first, last, lines[0]))
    return found


def _number(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def line_sketches(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Per document that has a window: id, hash of the text, digests and words of its lines, fingerprints."""

    def start():
        def step(ids, texts, hashes):
            kept = [], [], [], [], []
            for i, text, own in zip(ids, texts, hashes):
                lines = (text or b"").split(b"\n")
                words = [len(line.split()) for line in lines]
                if sum(words) < min_words:
                    continue
                digests = [xxhash.xxh3_128_digest(line) for line in lines]
                prints = [_number(digests[at]) for at in {at for *_, at in windows(words, digests, min_words)}]
                for column, value in zip(kept, (i, own, b"".join(digests), words, prints)):
                    column.append(value)
            return kept

        return step

    schema = typed(df, id_col, "__hash long, __digests binary, __words array<int>, __prints array<long>")
    return map_texts(df, [id_col, text_col, F.xxhash64(text_col).alias("__hash")], start, schema)


def _extended(candidates: DataFrame, id_col: str, min_words: int) -> DataFrame:
    """Windows around the repeated fingerprints: id, text hash, window digest, first and last line."""

    def start():
        def step(ids, digests, hashes, words, prints):
            kept = [], [], [], [], []
            for i, joined, own, counts, repeated in zip(ids, digests, hashes, words, prints):
                lines = [joined[at: at + 16] for at in range(0, len(joined), 16)]
                repeated = set(repeated)
                for first, last, at in windows(counts, lines, min_words):
                    if _number(lines[at]) in repeated:
                        name = xxhash.xxh3_128_digest(joined[16 * first: 16 * last + 16])
                        for column, value in zip(kept, (i, own, name, first, last)):
                            column.append(value)
            return kept

        return step

    schema = typed(candidates, id_col, "__hash long, __window binary, __first int, __last int")
    return map_texts(candidates, [id_col, "__digests", "__hash", "__words", "__repeated"], start, schema)


def _flags(runs: DataFrame, id_col: str) -> DataFrame:
    """One boolean per line up to the last deleted one."""

    def start():
        def step(ids, _, hashes, found):
            flags = []
            for spans in found:
                out = np.zeros(max(s["__last"] for s in spans) + 1, dtype=bool)
                for s in spans:
                    out[s["__first"]: s["__last"] + 1] = True
                flags.append(out.tolist())
            return [ids, hashes, flags]

        return step

    columns = [id_col, F.lit(None).cast("binary").alias("__none"), "__hash", "__runs"]
    return map_texts(runs, columns, start, typed(runs, id_col, "__hash long, __flags array<boolean>"))


def _renamed(df: DataFrame, id_col: str) -> DataFrame:
    return df.withColumnsRenamed({id_col: "__own_id", "__hash": "__own_hash"})


def _same(id_col: str):
    """The same document: equal id, null included, and equal text."""
    return F.col(id_col).eqNullSafe(F.col("__own_id")) & (F.col("__hash") == F.col("__own_hash"))


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to delete: id, ``__hash`` of the text, ``__flags`` per line."""
    sketches = stored(line_sketches(df, id_col, text_col, min_words), "line-sketches")
    prints = sketches.select(id_col, "__hash", F.explode("__prints").alias("__print"))
    repeated = prints.groupBy("__print").agg(F.count("*").alias("__n")).where("__n > 1").select("__print")
    again = (
        prints.join(repeated, "__print", "left_semi")
        .groupBy(id_col, "__hash").agg(F.collect_set("__print").alias("__repeated"))
    )
    candidates = sketches.join(_renamed(again, id_col), _same(id_col)).select(
        id_col, "__hash", "__digests", "__words", "__repeated"
    )
    found = stored(_extended(candidates, id_col, min_words), "line-windows")
    place = F.struct(id_col, "__hash", "__first")
    earliest = (
        found.groupBy("__window").agg(F.min(place).alias("__least"), F.max(place).alias("__most"))
        .where("__least <> __most").select("__window", "__least")
    )
    runs = (
        found.join(earliest, "__window").where(place > F.col("__least"))
        .groupBy(id_col, "__hash").agg(F.collect_set(F.struct("__first", "__last")).alias("__runs"))
    )
    return _flags(runs, id_col)


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents with later repeated runs deleted; adds ``__n_lines`` and ``__n_removed``."""
    gone = repeated_lines(df, id_col, text_col, min_words)
    lines = F.split(text_col, "\n", -1)
    flags = F.col("__flags")
    kept = F.filter(lines, lambda line, i: ~F.coalesce(F.get(flags, i), F.lit(False)))
    removed = F.size(F.filter(flags, lambda f: f))
    hashed = df.withColumn("__hash", F.xxhash64(text_col))
    return hashed.join(_renamed(gone, id_col), _same(id_col), "left").select(
        *[
            F.when(flags.isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col
            else f"`{c}`"
            for c in df.columns
        ],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("__n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("__n_removed"),
    )
