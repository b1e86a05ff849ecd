"""Positions of regex matches as column expressions; no exchange, no Python.

Patterns are Java regexes that read a text once: runs are possessive and start where a
run starts (``\\G`` keeps matches that begin where the last one ended).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"  # of folded words: ASCII letters and digits, everything beyond ASCII
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
_BLOCK = 64


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body, or a lambda in it, uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    """Words of a text: maximal runs of WORD."""
    return F.regexp_count(text, F.lit(f"{WORD}++")).cast("long")


def phrase(words: str) -> str:
    """The words, one after the other, whatever stands between them; capitals count as small."""
    return f"(?i)(?<!{WORD})" + GAP.join(words.split()) + f"(?!{WORD})"


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def running_sums(values: Column) -> Column:
    """Sums of the first 1, 2, ... values of an array of longs.

    In blocks, so that the work stays close to linear in long arrays.
    """
    return let(values, lambda v: F.when(F.size(v) > 0, _sums(v)).otherwise(F.array().cast("array<long>")))


def _sums(values: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: _total(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))))
    return let(totals, lambda t: F.flatten(F.transform(
        blocks,
        lambda b: let(
            F.struct(
                F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)).alias("block"),
                _total(F.slice(t, F.lit(1), b)).alias("before"),
            ),
            lambda g: F.transform(g["block"], lambda _, i: g["before"] + _total(F.slice(g["block"], F.lit(1), i + 1))),
        ),
    )))


def spans(text: Column, regex: Column | str) -> Column:
    """Array of (start, end, match) of all matches, in code points, the end exclusive."""
    pattern = F.lit(regex) if isinstance(regex, str) else regex
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(
        F.size(found) == 0, F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    ).otherwise(let(
        F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
            lambda gap, m: F.struct(
                F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("own"), m.alias("m")
            ),
        ),
        lambda lengths: F.zip_with(
            running_sums(F.transform(lengths, lambda x: x["gap"] + x["own"])), lengths,
            lambda end, x: F.struct((end - x["own"]).alias("start"), end.alias("end"), x["m"].alias("match")),
        ),
    )))
