"""Large files that hold one JSON array each, read by as many tasks as they have splits.

Spark's own reader gives such a file to one task, since a split cannot tell whether it begins
inside a string or how deep it is nested. Both follow from what stands before, and they
compose: a piece of text maps the state in which it begins to the state in which it ends.

1. The text reader cuts the files at every ``}`` (a record ends with one), each task its own
   splits. A piece is summarised for both possible beginnings, outside and inside a string:
   how many quotes it has and how the nesting changes.
2. Summaries are added up per block, some thousand pieces of a split, and the blocks of a
   file in their order give the state in which each block begins. These sums are one row per
   block.
3. With it each piece knows how deep it ends. Where a ``}`` leads back to the level of the
   array, a record is complete; pieces of a record are put together again, those of a
   record that lies over the border of blocks in a second step.

Only built-in functions; no task needs to see more than a block, a record, or one row per
block of a file: splits are as large as the reader makes them, blocks are dealt evenly over
the tasks. A record must fit in memory. The records of an array are objects; other elements
between them are ignored. A file that holds a single object is one record. A record that is
cut off at the end of its file is left out. Compressed files cannot be split and are
read by one task each, with the same result.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window, WindowSpec

from panelwright.session import stored

_BLOCK = ["file", "split", "block"]

#: Pieces in a block, at most; windows buffer as many rows as objects by default.
BLOCK_PIECES = 4096
#: What the blocks of a task take when they are put in order: text, and what each piece has beside it.
TASK_BYTES, PIECE_BYTES = 64 << 20, 256


def _in_order() -> WindowSpec:
    """The pieces of a block."""
    return Window.partitionBy(*_BLOCK).orderBy("at")


def _blocks_of_file() -> WindowSpec:
    return Window.partitionBy("file").orderBy("split", "block")


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _first_character(text: str) -> Column:
    return F.regexp_extract(text, r"^\s*(\S)", 1)


def _nesting(parts: Column, inside: int) -> Column:
    """How the parts outside strings change the depth, if the text begins outside (0) or inside (1) a string."""
    outside = F.filter(parts, lambda part, i: i % 2 == inside)
    return F.aggregate(
        outside, F.lit(0), lambda n, part: n + _occurrences(part, "{[") - _occurrences(part, "]")
    )


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text up to each ``}``, in the order of its split, with its summary for both beginnings."""
    read = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    parts = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"', -1)
    return read.withColumn("parts", parts).select(
        "*", (F.col("at") - F.col("at") % BLOCK_PIECES).alias("block"),
        F.octet_length("text").alias("bytes"), (F.size("parts") - 1).alias("quotes"),
        _nesting(F.col("parts"), 0).alias("deeper_0"), _nesting(F.col("parts"), 1).alias("deeper_1"),
    ).drop("parts")


def _tasks(pieces: DataFrame) -> int:
    """How many tasks put the blocks in order: as the size asks for, between the cores and the shuffle setting.

    A number of its own, since sizes of shuffles mislead here: pieces are packed to a small part of
    what they take in memory, so many would be put into one task.
    """
    spark = pieces.sparkSession
    cores, most = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = pieces.agg(F.sum(F.col("bytes") + PIECE_BYTES)).first()[0] or 0
    return max(cores, min(most, size // TASK_BYTES + 1))


def _stepped(pieces: DataFrame) -> DataFrame:
    """The change of depth of each piece, its ``}`` included, for both beginnings of its block."""
    before = F.coalesce(F.sum("quotes").over(_before(_in_order())), F.lit(0))
    stepped = pieces.withColumn("quotes_before", before)
    for start in (0, 1):
        begins, ends = (F.col("quotes_before") + start) % 2, (F.col("quotes_before") + F.col("quotes") + start) % 2
        change = F.when(begins == 0, F.col("deeper_0")).otherwise(F.col("deeper_1")) - F.when(ends == 0, 1).otherwise(0)
        stepped = stepped.withColumn(f"step_{start}", change)
    return stepped


def _blocks(stepped: DataFrame) -> DataFrame:
    """One row per block: the state in which it begins."""
    sums = stepped.groupBy(*_BLOCK).agg(
        F.sum("quotes").alias("quotes"), F.sum("step_0").alias("step_0"), F.sum("step_1").alias("step_1"),
        F.sum(F.col("bytes") + 1).alias("bytes"), F.max("file_size").alias("file_size"),
        F.min(F.struct("at", _first_character("text").alias("first")))["first"].alias("first"),
    )
    start = F.coalesce(F.sum("quotes").over(_before(_blocks_of_file())), F.lit(0)) % 2
    step = F.when(F.col("start") == 0, F.col("step_0")).otherwise(F.col("step_1"))
    whole = _blocks_of_file()
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sums.withColumn("start", start).select(
        *_BLOCK, "start", F.coalesce(F.sum(step).over(_before(_blocks_of_file())), F.lit(0)).alias("depth"),
        F.when(F.first("first").over(every) == "[", 1).otherwise(0).alias("level"),
        # One byte too many: the last piece of the file has no } behind it.
        (F.lead("split").over(whole).isNull() & (F.sum("bytes").over(every) > F.col("file_size"))).alias("open_end"),
    )


def _closed(stepped: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pieces with whether each ends a record."""
    begins = blocks.select(*_BLOCK, *[F.col(c).alias(f"b_{c}") for c in blocks.columns if c not in _BLOCK])
    known = stepped.join(begins, _BLOCK)
    own = F.when(F.col("b_start") == 0, F.col("step_0")).otherwise(F.col("step_1"))
    depth = F.col("b_depth") + F.sum(own).over(_in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    outside = (F.col("quotes_before") + F.col("quotes") + F.col("b_start")) % 2 == 0
    last = F.col("b_open_end") & F.lead("at").over(_in_order()).isNull()
    return known.withColumn("closes", outside & (depth == F.col("b_level")) & ~last)


def array_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, record, text): the records of each file, numbered from 0, as JSON text."""
    pieces = stored(_pieces(spark, [paths] if isinstance(paths, str) else paths), "pieces")
    tasks = _tasks(pieces)
    small = pieces.withColumn("text", _first_character("text")).repartition(tasks, *_BLOCK)
    blocks = stored(_blocks(_stepped(small)), "block-states")
    closed = _closed(_stepped(pieces.repartition(tasks, *_BLOCK)), blocks)
    record = F.coalesce(F.sum(F.col("closes").cast("int")).over(_before(_in_order())), F.lit(0))
    parts = (
        closed.withColumn("own", record).groupBy(*_BLOCK, "own")
        .agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("texts"), F.max("closes").alias("closes"))
        .select(*_BLOCK, "own", "closes", F.array_join("texts.text", "}").alias("text"))
    )
    parts = stored(parts, "record-parts")
    ended = parts.groupBy(*_BLOCK).agg(F.count_if("closes").alias("n"))
    numbers = stored(ended.select(
        *_BLOCK, F.coalesce(F.sum("n").over(_before(_blocks_of_file())), F.lit(0)).alias("first")
    ), "block-numbers")
    parts = parts.join(numbers, _BLOCK).select(
        *_BLOCK, (F.col("first") + F.col("own")).alias("record"), "text", "closes", "own"
    )
    # Only the first and the unfinished record of a block can lie over a border.
    inner = (F.col("own") > 0) & F.col("closes")
    torn = (
        parts.where(~inner).groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("split", "block", "text"))).alias("texts"), F.max("closes").alias("closes"))
        .select("file", "record", F.array_join("texts.text", "}").alias("text"), "closes")
    )
    whole = parts.where(inner).select("file", "record", "text", "closes").unionByName(torn).where("closes")
    # What separates records stands before the first brace.
    text = F.concat(F.substring(F.col("text"), F.instr("text", "{"), F.length("text")), F.lit("}"))
    return whole.select("file", "record", text.alias("text"))


def read_split_array(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """The records with the given schema; a record that is no valid JSON is a row of NULLs, as in other JSON scans."""
    parsed = array_records(spark, paths).select(F.from_json("text", schema).alias("record"))
    return parsed.select("record.*")
