"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a versioned bit mask, so that other policies,
ablations and the reasons for a decision need no second look at the texts.

Defined results: a null or empty text has no words, all counts are 0 and it fails
``few_words``. Repeated rows are judged row by row. A very long text is measured whole; its
windows are compared as arrays of numbers instead of tuples of words. Other columns of the
input are not read, so their names cannot clash.
"""

from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.texts import SPACES, map_texts, spaced_words, typed

WINDOW = 5
LONG = 20_000  # words from which windows are compared as numbers
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(0x41, 0x5B))
_SMALL = bytes(range(0x61, 0x7B))

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
    "n_capitals long, n_letters long"
)


@dataclass(frozen=True)
class Rule:
    """A rule fails where its condition over the measurements holds."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule(5, "capitals", "2 * n_capitals > n_letters"),
)
BASE = ("few_words", "repeated_windows")
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "capitals"),
    "v3": (*BASE, "symbols", "repeated_lines", "word_length", "capitals"),
}
CURRENT = "v3"


def mask(names) -> int:
    """The bits of the named rules."""
    bits = {rule.name: 1 << rule.bit for rule in RULES}
    return sum(bits[name] for name in set(names))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that occur at least twice in the text."""
    if len(words) > LONG:
        return _repeated_numbers(words)
    windows = list(zip(*(islice(words, i, None) for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    once, again = set(), set()
    for window in windows:
        (again if window in once else once).add(window)
    covered = reach = 0
    for i, window in enumerate(windows):
        if window in again:
            covered += i + WINDOW - max(i, reach)
            reach = i + WINDOW
    return covered


def _repeated_numbers(words: list[bytes]) -> int:
    """``repeated_words`` in a few numbers per word: equal windows get equal numbers, pair by pair, exactly."""
    table: dict[bytes, int] = {}
    one = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))

    def joined(left, right):
        return np.unique(left * (right.max() + 1) + right, return_inverse=True)[1]

    two = joined(one[:-1], one[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], one[WINDOW - 1:])
    starts = np.flatnonzero(np.bincount(five)[five] > 1)
    change = np.zeros(len(words) + 1, dtype=np.int32)
    change[starts] += 1
    change[starts + WINDOW] -= 1
    return int((np.cumsum(change[:-1]) > 0).sum())


def measures(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or b""
    words = spaced_words(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        len(words),
        len(text.translate(None, SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        capitals,
        capitals + len(text) - len(text.translate(None, _SMALL)),
    )


def rule_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, measurements, and ``failure_bits`` over all rules."""

    def start():
        def step(ids, texts):
            return [ids, *(list(c) for c in zip(*map(measures, texts)))]

        return step

    measured = map_texts(df, [id_col, text_col], start, typed(df, id_col, MEASURES))
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failure_bits", failed.cast("long"))


def passes(policy: str | tuple = CURRENT, bits: str = "failure_bits") -> Column:
    """True where no rule of the policy has failed."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(bits).bitwiseAND(F.lit(mask(names)).cast("long")) == 0


def ablation(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: documents it fails, and those that only it fails.

    Documents are counted by their bits first (at most 2^rules groups); everything
    else is bit arithmetic over those counts.
    """
    names = POLICIES[policy]
    whole = F.lit(mask(names)).cast("long")
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for r in RULES if r.name in names
    ])
    counted = ledger.groupBy(F.col("failure_bits").bitwiseAND(whole).alias("bits")).agg(F.count("*").alias("n"))
    return (
        counted.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        )
    )
