"""Near-duplicates with SetSketch registers.

Each document becomes a set of five-word shingles. A register keeps the smallest of
exponentially distributed hash values of the set, truncated to a whole exponent
``floor(1 - log_b(x))``; two sets agree in a register with about the probability of their
similarity, and sketches of a union are the larger exponents.

1. Documents with equal sets are one class, found by a digest of the set; from here on
   only one document of each class takes part, so copies cost nothing more.
2. Registers are banded. Members of a band bucket are compared with the bucket's smallest
   member. Where a bucket is not one component afterwards, its members that have enough
   shingles in common with other components are compared as a whole, in blocks of the
   bucket: two blocks are a product of two incidence matrices in one task, and of their
   links as many are kept as connect them. No pair is a row of its own there.
3. A pair with a centre goes on if its sizes allow the threshold, and if the likelihood of its joint
   register counts does not rule it out. What is left is compared on full sets.
4. Components come from star contraction; each document gets the smallest id it reaches.

With 32 bands of 4 registers a pair at the threshold of 0.75 is missed by all bands with
probability 5e-6, a closer pair far more rarely.

Defined results: null, empty and white-space texts have no shingles and are linked with
nothing. A text with fewer than five words is one shingle. Rows with a null id are linked
with nothing and get a null component. Ids are expected to be unique; rows that share an
id and a text are alike. Other columns are kept by ``drop_near_duplicates``; names that
begin with ``__`` are reserved.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelwright.llm.texts import map_texts, typed
from panelwright.session import stored

WORDS = 5
THRESHOLD = 75  # per cent
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534  # of SetSketch: b, a and q
UNLIKELY = 12.5  # log-likelihood lost at the threshold that rules a pair out
CACHED_WORDS = 300_000
CHUNK = 2048
BLOCK = 512  # members of a bucket that a task compares with as many others, on average

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_U30, _U27, _U31 = np.uint64(30), np.uint64(27), np.uint64(31)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U30)) * _MIX[0]
    x = (x ^ (x >> _U27)) * _MIX[1]
    return x ^ (x >> _U31)


_FACTORS = _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


class Shingles:
    """Sets of five-word shingles as sorted 64-bit hashes; remembers the hashes of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []  # of bytes: A-Z only
        n = len(words)
        if not n:
            return np.empty(0, dtype=np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        try:
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        except KeyError:
            for word in set(words).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        width = min(WORDS, n)
        joined = np.full(n - width + 1, np.uint64(width))
        for k in range(width):
            joined = _mixed(joined * _STEP + hashes[k: n - width + 1 + k])
        return np.unique(joined)


def registers(shingles: np.ndarray) -> np.ndarray:
    """Truncated exponents of the smallest exponential value per register, as 16-bit numbers."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(least, np.multiply.outer(_FACTORS, shingles[at: at + CHUNK]).min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 1) / 2.0**64
    values = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(values) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def likelihood_loss(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """How much log-likelihood the best similarity at or above the threshold lacks to the best of all."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    j = np.minimum(np.linspace(0, 1, 101)[None, :], np.minimum(u / v, v / u))

    def p(x):
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    up, down = p(u - v * j), p(v - u * j)
    ll = more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))
    close = np.where(j >= threshold - 1e-9, ll, -np.inf)
    return ll.max(axis=1) - close.max(axis=1)


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, hash of the text, size of the set, digest of the set, registers."""

    def start():
        shingles = Shingles()

        def step(ids, texts, hashes):
            sets = [shingles.of(t) for t in texts]
            return [
                ids, hashes, [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                [registers(s).tobytes() if len(s) else None for s in sets],
            ]

        return step

    fields = "__hash long, __n long, __set binary, __registers binary"
    return map_texts(df, [id_col, text_col, F.xxhash64(text_col).alias("__hash")], start, typed(df, id_col, fields))


def _likely(pairs: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose registers do not rule the threshold out."""

    def start():
        def step(a, left, b, right, n_a, n_b):
            x = np.frombuffer(b"".join(left), dtype="<u2").reshape(len(left), -1)
            y = np.frombuffer(b"".join(right), dtype="<u2").reshape(len(right), -1)
            loss = likelihood_loss(x, y, np.array(n_a, float), np.array(n_b, float), THRESHOLD / 100)
            close = np.flatnonzero(loss <= UNLIKELY)
            return [[a[i] for i in close], [b[i] for i in close]]

        return step

    return map_texts(pairs, ["a", "ra", "b", "rb", "na", "nb"], start, typed(pairs, "a", "b long"))


def _sets(texts: DataFrame) -> DataFrame:
    """(id, shingles): the full set of each text."""

    def start():
        shingles = Shingles()
        return lambda ids, given: [ids, [shingles.of(t).view(np.int64) for t in given]]

    return map_texts(texts, ["id", "text"], start, typed(texts, "id", "shingles array<long>"))


class _Members:
    """Sketches and full sets of the classes that share a band with another one."""

    def __init__(self, df: DataFrame, classes: DataFrame, reps: DataFrame, id_col: str, text_col: str):
        self.sides = stored(classes.join(reps, "rep", "left_semi").select("rep", "hash", "n", "registers"), "near-sides")
        texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
        same = (F.col("id") == F.col("rep")) & (F.col("h") == F.col("hash"))
        keys = self.sides.select("rep", "hash")
        chosen = texts.join(keys, same, "left_semi").select("id", "text").dropDuplicates(["id"])
        self.sets = stored(_sets(chosen), "near-sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of distinct (a, b), those that are linked."""
        a = self.sides.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
        b = self.sides.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
        fits = 100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb")
        likely = stored(_likely(pairs.join(a, "a").join(b, "b").where(fits)), "near-pairs")
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
        common = F.size(F.array_intersect("left", "right"))
        close = (100 + THRESHOLD) * common >= THRESHOLD * (F.size("left") + F.size("right"))
        return likely.join(left, "a").join(right, "b").where(close).select("a", "b")

    def able(self, opened: DataFrame) -> DataFrame:
        """The rows (band, rep, label) that can still have a link, with n and shingles.

        ``shingles`` are those of a member that members of other components have too. Two sets of
        n and m shingles need THRESHOLD / (100 + THRESHOLD) of n + m in common; m is at least
        THRESHOLD per cent of n, and no less than the smallest member of the bucket has.
        """
        members = opened.select("rep", "label").distinct()
        sets = self.sets.join(members, F.col("id") == F.col("rep")).select(
            "rep", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")
        )
        spread = sets.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        shared = (
            sets.join(spread, "shingle", "left_semi").groupBy("rep", "n")
            .agg(F.collect_list("shingle").alias("shingles"))  # no longer than the member's text
            .where(100 * F.size("shingles") >= THRESHOLD * F.col("n"))
        )
        rows = stored(opened.join(shared, "rep"), "near-able")
        smallest = rows.groupBy("band").agg(F.min("n").alias("least"))
        enough = (100 + THRESHOLD) * F.size("shingles") >= THRESHOLD * (F.col("n") + F.col("least"))
        return _in_several(rows.join(smallest, "band").where(enough).drop("least"))


def _in_several(rows: DataFrame) -> DataFrame:
    """The rows of buckets with members of more than one component."""
    split = rows.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    return rows.join(split, "band", "left_semi")


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of the links (a, b): the smallest id it is connected with.

    Alternates large and small stars until all are stars; no group is gathered, each step is
    a minimum per id and a join.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges"
    )
    while not _are_stars(edges):
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = (
            both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .where("v <> u").distinct()
        )
        large = stored(large, "large-stars")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .union(least.select("v", F.col("m").alias("u"))).where("v <> u").distinct()
        )
        edges = stored(small, "small-stars")
    return edges.select(F.col("v").alias("id"), F.col("u").alias("label"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id stands under one other id at most, which stands under none."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("under"), F.lit(0).alias("over")).union(
        edges.select("u", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("x").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
    return counts.where("under > 1 OR under = 1 AND over = 1").isEmpty()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    sketched = stored(sketches(df, id_col, text_col), "set-sketches")
    classes = stored(
        sketched.where(F.col("__n") > 0).where(F.col(id_col).isNotNull())
        .groupBy("__set").agg(
            F.min(F.struct(F.col(id_col).cast("long").alias("rep"), F.col("__hash").alias("hash"))).alias("first"),
            F.first("__n").alias("n"), F.first("__registers").alias("registers"),
        )
        .select("__set", "first.*", "n", "registers"),
        "set-classes",
    )
    labels = _class_labels(df, classes, id_col, text_col)
    named = classes.select("__set", "rep").join(labels, F.col("rep") == F.col("id"), "left").select(
        F.col("__set").alias("__class"), F.coalesce("label", "rep").alias("__label")
    )
    own = F.col(id_col).cast("long")
    component = F.when(own.isNotNull(), F.coalesce("__label", own))
    return sketched.join(named, F.col("__set") == F.col("__class"), "left").select(
        id_col, F.col("__n").alias("n_shingles"), component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )


def _class_labels(df: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("registers", b * (2 * ROWS) + 1, F.lit(2 * ROWS))),
    )
    rows = classes.select("rep", F.explode(bands).alias("band"))
    buckets = rows.groupBy("band").agg(F.min("rep").alias("center"), F.count("*").alias("size")).where("size > 1")
    members = stored(rows.join(buckets, "band").where("rep <> center"), "band-members")
    both = members.select("rep").union(members.select("center")).distinct()
    sets = _Members(df, classes, both, id_col, text_col)
    pairs = members.select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    labels = components(sets.confirmed(pairs))
    # Buckets of two are settled; in larger ones members may link with each other only.
    rest = stored(_opened(members.where("size > 2").select("band", "rep"), labels), "open-buckets")
    if rest.isEmpty():
        return labels
    return _relabelled(labels, stored(_bucket_links(sets.able(rest)), "near-links"))


def _opened(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, rep, label) of buckets that are not one component yet."""
    return _in_several(rows.join(labels, F.col("rep") == F.col("id"), "left").select(
        "band", "rep", F.coalesce("label", "rep").alias("label")
    ))


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after the found links; the old labels stand for what was linked already."""
    if found.isEmpty():
        return labels
    links = (
        found.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a", "left")
        .join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b", "left")
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    )
    stars = labels.select(F.col("id").alias("a"), F.col("label").alias("b"))
    return components(links.union(stars))


def _bucket_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) that join components of the same bucket, as many as it takes to connect them.

    ``rows`` has (band, rep, label, n, shingles). Buckets with the same members are compared
    once. Members are dealt into blocks of about ``BLOCK``; a task compares two blocks, or one
    with itself, by products of their incidence matrices, so that pairs never become rows.
    """
    marks = [F.sum(F.xxhash64(F.lit(seed), "rep").cast("decimal(38,0)")).alias(f"mark_{seed}") for seed in (1, 2)]
    buckets = rows.groupBy("band").agg(F.count("*").alias("size"), *marks)
    once = buckets.groupBy("size", "mark_1", "mark_2").agg(F.min("band").alias("band")).select(
        "band", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.join(once, "band").withColumn("block", block).withColumn("other", other).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "label",
        "n", "shingles",
    )
    fields = "a long, b long"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def compare(table: pa.Table) -> pa.Table:
        block, rep, label, n = (table.column(c).to_numpy() for c in ("block", "rep", "label", "n"))
        shingles = table.column("shingles").combine_chunks()
        common = common_counts(shingles.flatten().to_numpy(), np.diff(shingles.offsets.to_numpy()))
        linked = (100 + THRESHOLD) * common >= THRESHOLD * (n[:, None] + n[None, :])
        linked &= label[:, None] != label[None, :]
        if block.min() != block.max():
            linked &= block[:, None] != block[None, :]
        a, b = forest(linked)
        return pa.Table.from_arrays([pa.array(rep[a], pa.int64()), pa.array(rep[b], pa.int64())], schema=schema)

    return dealt.groupBy("band", "i", "j").applyInArrow(compare, fields)


def common_counts(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many values each two of the rows have in common; row k has the next ``sizes[k]`` of the values."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, columns, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[columns] > 1
    rows, columns = rows[several], columns[several]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    _, columns = np.unique(columns, return_inverse=True)
    common = np.zeros((len(sizes), len(sizes)), dtype=np.float32)  # exact below 2^24
    for at in range(0, int(columns.max(initial=-1)) + 1, CHUNK):
        own = slice(*np.searchsorted(columns, [at, at + CHUNK]))
        part = np.zeros((len(sizes), CHUNK), dtype=np.float32)
        part[rows[own], columns[own] - at] = 1
        common += part @ part.T
    return common.astype(np.int64)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of links that connect what the symmetric matrix connects, without circles."""
    free, ends = np.ones(len(linked), dtype=bool), ([], [])
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front:
            node = front.pop()
            near = np.flatnonzero(linked[node] & free)
            free[near] = False
            front += near.tolist()
            ends[0].extend([node] * len(near))
            ends[1].extend(near.tolist())
    return np.array(ends[0], dtype=np.int64), np.array(ends[1], dtype=np.int64)


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which one per group stays, with all their columns.

    Rows that share an id are kept or dropped together.
    """
    gone = near_duplicates(df, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct()
    return df.join(gone, df[id_col] == gone["__gone"], "left_anti")
