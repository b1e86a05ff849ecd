"""License scans with ordered signature rules.

A rule is a regex for a wording of a license (``licensed under the NAME``, ``NAME
license version 2 0``, an SPDX line ...) with a priority and a confidence. A text is
first searched for the rules' keywords; only rules whose keyword, a word of their own
phrase, stands in the text are tried. Where matches overlap, one that lies inside another
is dropped, and of equal intervals the rule of higher priority stays.

Base phrases (``mit license`` and the like) are counted apart; their labels always stay.

Defined results: a null text counts as empty. Texts without a match have no labels, a
score of 0 and null positions. Repeated rows are scanned row by row, a very long text as a
whole, in its row. An empty table gives no rows. Other columns are not read.
"""

import json
from collections import Counter
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.matches import WORD, let, phrase, spans, word_count

BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
BASE_SCORE = 0.6

# Families: label, keyword of the rules whose phrase holds it, names, versions that are told apart, SPDX stem.
FAMILIES = (
    ("mit", "mit", ("mit",), (), "mit"),
    ("mit", "expat", ("expat",), (), "expat"),
    ("apache", "apache", ("apache", "apache software"), ("2 0", "1 1", "1 0"), "apache"),
    ("gpl", "gpl", ("gpl", "gnu gpl"), ("3 0", "3", "2 0", "2"), "gpl"),
    ("gpl", "general", ("general public", "gnu general public"), ("3", "2"), "gnu gpl"),
    ("lgpl", "lesser", ("lesser general public", "gnu lesser general public"), ("3", "2 1"), "gnu lgpl"),
    ("lgpl", "lgpl", ("lgpl", "gnu lgpl"), ("3 0", "2 1"), "lgpl"),
    ("agpl", "affero", ("affero general public", "gnu affero general public"), ("3",), "gnu agpl"),
    ("agpl", "agpl", ("agpl", "gnu agpl"), ("3 0",), "agpl"),
    ("bsd", "bsd", ("bsd", "bsd 2 clause", "bsd 3 clause", "modified bsd", "simplified bsd"), (), "bsd"),
    ("mpl", "mozilla", ("mozilla public",), ("2 0", "1 1"), "mozilla mpl"),
    ("mpl", "mpl", ("mpl",), ("2 0", "1 1"), "mpl"),
    ("epl", "eclipse", ("eclipse public",), ("2 0", "1 0"), "epl"),
    ("cddl", "cddl", ("cddl",), ("1 1", "1 0"), "cddl"),
    ("cc-by", "cc", ("cc by",), ("4 0", "3 0"), "cc by"),
    ("cc-by-sa", "cc", ("cc by sa",), ("4 0", "3 0"), "cc by sa"),
    ("cc-by-nc", "cc", ("cc by nc",), ("4 0", "3 0"), "cc by nc"),
    ("cc-by-nd", "cc", ("cc by nd",), ("4 0", "3 0"), "cc by nd"),
    ("cc-by-nc-sa", "cc", ("cc by nc sa",), ("4 0", "3 0"), "cc by nc sa"),
    ("cc-by-nc-nd", "cc", ("cc by nc nd",), ("4 0", "3 0"), "cc by nc nd"),
    ("cc0", "cc0", ("cc0",), ("1 0",), "cc0"),
    ("creative-commons", "creative", ("creative commons", "creative commons attribution"), (), "creative commons"),
    ("unlicense", "unlicense", ("unlicense",), (), "unlicense"),
    ("wtfpl", "wtfpl", ("wtfpl",), (), "wtfpl"),
    ("zlib", "zlib", ("zlib", "zlib libpng"), (), "zlib"),
    ("isc", "isc", ("isc",), (), "isc"),
    ("bsl", "boost", ("boost software", "boost"), ("1 0",), "bsl"),
    ("artistic", "artistic", ("artistic",), ("2 0", "1 0"), "artistic"),
    ("psf", "python", ("python software foundation", "python"), ("2",), "psf"),
    ("postgresql", "postgresql", ("postgresql",), (), "postgresql"),
    ("openssl", "openssl", ("openssl",), (), "openssl"),
    ("php", "php", ("php",), ("3 01", "3 0"), "php"),
    ("ruby", "ruby", ("ruby",), (), "ruby"),
    ("eupl", "eupl", ("eupl", "european union public"), ("1 2", "1 1"), "eupl"),
    ("ofl", "sil", ("sil open font",), ("1 1",), "ofl"),
    ("gfdl", "documentation", ("free documentation", "gnu free documentation"), ("1 3", "1 2"), "gfdl"),
    ("odbl", "database", ("open database",), ("1 0",), "odbl"),
    ("ms-pl", "microsoft", ("microsoft public",), (), "ms pl"),
    ("ms-rl", "microsoft", ("microsoft reciprocal",), (), "ms rl"),
    ("cpl", "common", ("common public",), ("1 0",), "cpl"),
    ("ipl", "ibm", ("ibm public",), ("1 0",), "ipl"),
    ("apsl", "apple", ("apple public source",), ("2 0",), "apsl"),
    ("osl", "osl", ("osl", "open software"), ("3 0",), "osl"),
    ("afl", "academic", ("academic free",), ("3 0",), "afl"),
    ("ecl", "educational", ("educational community",), ("2 0",), "ecl"),
    ("ncsa", "ncsa", ("ncsa", "university of illinois ncsa"), (), "ncsa"),
    ("x11", "x11", ("x11",), (), "x11"),
    ("vim", "vim", ("vim",), (), "vim"),
    ("cecill", "cecill", ("cecill",), ("2 1",), "cecill"),
    ("busl", "business", ("business source",), ("1 1",), "busl"),
    ("sspl", "sspl", ("sspl", "server side public"), ("1",), "sspl"),
    ("elastic", "elastic", ("elastic",), ("2 0",), "elastic"),
    ("openrail", "openrail", ("openrail", "bigscience openrail"), (), "openrail"),
)
# Wordings: how a name (N) and a version (V) stand in them, priority (lower goes first), confidence.
WORDINGS = (
    ("spdx license identifier S", 0, 1.0),
    ("under the terms of the N license version V", 1, 0.98),
    ("licensed under the N license version V", 1, 0.98),
    ("licensed under N V", 1, 0.98),
    ("N license version V", 2, 0.95),
    ("N license V", 2, 0.95),
    ("N version V", 3, 0.9),
    ("under the terms of the N", 4, 0.9),
    ("licensed under the N", 4, 0.9),
    ("licensed under N", 4, 0.9),
    ("released under the N license", 4, 0.9),
    ("distributed under the N license", 4, 0.9),
    ("available under the N license", 4, 0.9),
    ("subject to the N license", 4, 0.85),
    ("N license", 6, 0.7),
    ("N licence", 6, 0.7),
)
# Wordings without a family: label, keyword (a word of the phrase), phrase, priority, confidence.
OTHERS = (
    ("public-domain", "domain", "released into the public domain", 4, 0.9),
    ("public-domain", "domain", "dedicated to the public domain", 4, 0.9),
    ("public-domain", "domain", "in the public domain", 6, 0.5),
    ("proprietary", "rights", "all rights reserved", 6, 0.5),
    ("proprietary", "proprietary", "proprietary and confidential", 5, 0.8),
    ("beerware", "beerware", "beerware license", 4, 0.9),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 1, 0.98),
    ("bsd", "redistribution", "redistribution and use in source and binary forms", 1, 0.95),
    ("isc", "permission", "permission to use copy modify and or distribute this software", 1, 0.95),
    ("gpl", "redistribute", "free software you can redistribute it and or modify it under the terms of the gnu", 1, 0.95),
)
_BASE_WORD = "(?i)license"  # stands in every base phrase


@dataclass(frozen=True)
class Rule:
    """A signature: what it finds and how it ranks."""

    keyword: str  # stands in every match
    label: str
    regex: str
    priority: int
    confidence: float


def signature_rules() -> list[Rule]:
    """All rules, built from families and wordings; without repeats, in order of priority."""
    found: dict[tuple[str, str], Rule] = {}
    families = Counter(w for _, _, names, _, spdx in FAMILIES for w in set(" ".join((*names, spdx)).split()))
    for label, keyword, names, versions, spdx in FAMILIES:
        for wording, priority, confidence in WORDINGS:
            for name in names if "N" in wording.split() else (spdx,):
                for version in versions if "V" in wording.split() else ("",):
                    words = " ".join({"N": name, "V": version, "S": spdx}.get(w, w) for w in wording.split())
                    held = [keyword] if keyword in name.split() else name.split()
                    rarest = min(held, key=lambda w: (families[w], -len(w), w))
                    rule = Rule(rarest, label, phrase(words), priority, confidence)
                    found.setdefault((label, rule.regex), rule)
    for label, keyword, words, priority, confidence in OTHERS:
        rule = Rule(keyword, label, phrase(words), priority, confidence)
        found.setdefault((label, rule.regex), rule)
    return sorted(found.values(), key=lambda r: (r.priority, r.label, r.regex))


_RULES = "ARRAY<STRUCT<keyword: STRING, label: STRING, regex: STRING, priority: INT, confidence: DOUBLE>>"


def _literal(rules: list[Rule]) -> Column:
    """The rules as one constant array."""
    return F.from_json(F.lit(json.dumps([asdict(r) for r in rules])), _RULES)


def detections(text: Column, rules: list[Rule] | None = None) -> Column:
    """Array of (start, back, priority, label, confidence, end) in order of start, of all matching rules.

    ``back`` is the negative end, so that of spans with one start the longest comes first.
    """
    rules = signature_rules() if rules is None else rules
    keywords = "|".join(sorted({r.keyword for r in rules}))
    named = F.array_distinct(F.transform(
        F.regexp_extract_all(text, F.lit(f"(?i)(?<!{WORD})(?:{keywords})(?!{WORD})"), F.lit(0)), F.lower
    ))
    tried = let(named, lambda words: F.when(F.size(words) == 0, F.array().cast(_RULES)).otherwise(F.filter(
        _literal(rules), lambda r: F.array_contains(words, r["keyword"]) & F.rlike(text, r["regex"])
    )))
    found = F.flatten(F.transform(
        tried,
        lambda r: F.transform(
            spans(text, r["regex"]),
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("back"), r["priority"].alias("priority"),
                r["label"].alias("label"), r["confidence"].alias("confidence"), s["end"].alias("end"),
            ),
        ),
    ))
    return F.array_sort(found)


_KEPT = "struct<reach:bigint,labels:array<string>,score:double>"


def resolved(found: Column) -> Column:
    """Labels and best confidence of the detections that lie inside no other one.

    The detections come in order of start, longer ones first; a detection lies inside an
    earlier one exactly if it ends no later than any has reached.
    """
    empty = F.struct(F.lit(0).alias("reach"), F.array().alias("labels"), F.lit(0.0).alias("score")).cast(_KEPT)

    def step(kept, d):
        return F.when(d["end"] <= kept["reach"], kept).otherwise(F.struct(
            d["end"].alias("reach"),
            F.array_union(kept["labels"], F.array(d["label"])).alias("labels"),
            F.greatest(kept["score"], d["confidence"]).alias("score"),
        ).cast(_KEPT))

    return F.aggregate(found, empty, step)


def license_scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None
) -> DataFrame:
    """One row per document: id, words, base places, labels and score."""
    text = F.col("__text")
    seen = text.rlike(_BASE_WORD)
    columns = []
    for label, words in BASE.items():
        parts = F.split(text, phrase(words), -1)
        columns.append(F.when(seen & text.rlike(phrase(words)), parts).alias(f"__{label}"))
    parted = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select(
        id_col, word_count(text).alias("n_words"), *columns,
        resolved(detections(text, rules)).alias("__kept"),
    )
    counts, firsts, lasts, labels = [], [], [], []
    for label, words in BASE.items():
        parts = F.col(f"__{label}")
        counts.append(F.coalesce(F.size(parts) - 1, F.lit(0)).cast("long"))
        firsts.append(F.when(parts.isNotNull(), word_count(parts[0])))
        lasts.append(F.when(
            parts.isNotNull(), F.col("n_words") - word_count(F.element_at(parts, -1)) - len(words.split())
        ))
        labels.append(F.when(parts.isNotNull(), F.lit(label)))
    base = F.array_compact(F.array(*labels))
    more = F.col("__kept")["labels"]
    score = F.greatest(
        F.when(F.size(base) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)),
        F.col("__kept")["score"],
    )
    return parted.select(
        id_col, "n_words", sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        score.alias("score"),
    )
