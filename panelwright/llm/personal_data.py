"""Personal data by patterns, and by weak supervision beyond them.

Base spans follow fixed patterns for e-mail addresses, IP numbers, card numbers and phone
numbers. Beyond those, candidates (long tokens that may be credentials, and local phone
numbers) are voted on by five labelers: formats, a gazetteer of words that announce such
values, the punctuation in front, the shape of the value, and a gazetteer of harmless
surroundings. Expectation-maximisation estimates from the votes alone how reliable each
labeler is; its posteriors train a logistic span classifier over votes and shape, which
decides. Base spans always stay; a candidate that overlaps one is none.

Both fits see counts over all documents: at most ``3^5 * 9`` rows per kind, whatever the
input's size. Everything else is column expressions: texts are read once, and no text
leaves its row.

Only places are ever stored or returned, never what stands there.

Defined results: a null text counts as empty and has no spans. Repeated rows are scanned
row by row; a very long text is scanned whole, in its row. An empty table gives no rows.
Other columns are not read.
"""

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.matches import spans
from panelwright.session import stored

KINDS = ("email", "ip", "card", "phone")
ADDED = ("phone", "secret")
LABELERS, BUCKETS = 5, 3
REACH = 32  # characters in front of a candidate that the gazetteers read

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What must stand in a text for the pattern to be tried.
GATES = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

CANDIDATES = {
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{12,}+",
}
_FORMATS = {
    "phone": r"^\([2-9][0-9]{2}\)|^[2-9][0-9]{2}([.-])[2-9][0-9]{2}\1",
    "secret": r"^AKIA[0-9A-Z]{16}$|^[0-9a-f]{16,}$|^gh[pousr]_[A-Za-z0-9]{20,}$|^sk-[A-Za-z0-9_-]{16,}$|^eyJ",
}
_ANNOUNCED = {
    "phone": r"(?i)\b(?:tel|telephone|phone|call|mobile|cell|fax|whatsapp|sms|contact)\b",
    "secret": r"(?i)(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key|credential|private[_ -]?key|auth)",
}
_PUNCTUATED = {"phone": r"[:(]\x20?$", "secret": r"[=:]\x20?[\"']?$|[\"']$"}
_HARMLESS = {
    "phone": r"(?i)\b(?:isbn|issn|doi|invoice|order|version|build|no|nr|page|pages|id)\b[^a-z]*$|[$#/=]$",
    "secret": r"(?i)(?:https?|www|doi|isbn|sha|commit|version|file|id)[^\x20]*$|[@./]$",
}


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digits pass the Luhn check."""
    places = F.reverse(F.split(digits, ""))
    doubled = F.transform(
        places,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = digits_of(match)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(match)).between(9, 15)
    return F.lit(True)


_NONE = "array<struct<start:bigint,end:bigint>>"


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end) of a base kind; matches that fail their check are dropped.

    What was matched stays in its row: only places are given on, and stored.
    """
    found = F.filter(spans(text, PATTERNS[kind]), lambda s: _valid(kind, s["match"]))
    places = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(GATES[kind]), places).otherwise(F.array().cast(_NONE)).cast(_NONE)


def _share(part: Column, value: Column) -> Column:
    """Thirds of a value that characters of a class make up: 0, 1, 2."""
    share = F.length(F.regexp_replace(value, part, "")) / F.length(value)
    return F.when(share <= 1 / 3, 2).when(share <= 2 / 3, 1).otherwise(0)


def _votes(kind: str, value: Column, front: Column) -> list[Column]:
    """1 for personal data, -1 against, 0 for no opinion, of each labeler."""
    def vote(for_, against=F.lit(False)):
        return F.when(for_, 1).when(against, -1).otherwise(0)

    mixed = (_share("[0-9]", value) == 1) | (F.length(value) >= 24)
    plain = value.rlike(r"^[A-Za-z]+[-_/]?[0-9]{1,4}$|^[0-9]{1,4}[-_/]?[A-Za-z]+$|^[0-9]+[-/][A-Za-z]+[-/][0-9]+$")
    shape = vote(value.rlike(r"^\("), value.contains(" ")) if kind == "phone" else vote(mixed, plain)
    return [
        vote(value.rlike(_FORMATS[kind])),
        vote(front.rlike(_ANNOUNCED[kind])),
        vote(front.rlike(_PUNCTUATED[kind]), ~front.rlike(r"[=:\"'(]")),
        shape,
        vote(F.lit(False), front.rlike(_HARMLESS[kind])),
    ]


def candidate_spans(text: Column, kind: str, taken: Column) -> Column:
    """Array of (start, end, votes, length, digits) of candidates that overlap no base span."""
    def judged(s):
        front = F.substring(text, F.greatest(s["start"] - REACH, F.lit(0)).cast("int") + 1,
                            F.least(s["start"], F.lit(REACH)).cast("int"))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.array(*_votes(kind, s["match"], front)).alias("votes"),
            F.when(F.length(s["match"]) < 16, 0).when(F.length(s["match"]) < 32, 1).otherwise(2).alias("length"),
            _share("[0-9]", s["match"]).alias("digits"),
        )

    free = F.filter(
        spans(text, CANDIDATES[kind]),
        lambda s: ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])),
    )
    gate = text.rlike("[0-9]{3}[\\x20.-][0-9]{4}" if kind == "phone" else "[A-Za-z0-9_+/-]{12}")
    none = "array<struct<start:bigint,end:bigint,votes:array<int>,length:int,digits:int>>"
    return F.when(gate & text.rlike("[0-9]"), F.transform(free, judged)).otherwise(F.array().cast(none)).cast(none)


def reliabilities(cells: dict[tuple, float], rounds: int = 60):
    """Expectation-maximisation over vote patterns: class share and P(vote | class) of each labeler.

    ``cells`` has the count of each tuple of votes. Starts from the majority of votes,
    so that class 1 is what labelers vote for.
    """
    total = sum(cells.values())
    posterior = {v: 0.9 if sum(v) > 0 else 0.1 if sum(v) < 0 else 0.5 for v in cells}
    share, given = 0.5, None
    for _ in range(rounds):
        weight = {1: sum(posterior[v] * n for v, n in cells.items())}
        weight[0] = total - weight[1]
        share = (weight[1] + 1) / (total + 2)
        given = []
        for k in range(LABELERS):
            table = {c: {x: 0.5 for x in (-1, 0, 1)} for c in (0, 1)}
            for v, n in cells.items():
                table[1][v[k]] += posterior[v] * n
                table[0][v[k]] += (1 - posterior[v]) * n
            given.append({c: {x: t / (weight[c] + 1.5) for x, t in table[c].items()} for c in (0, 1)})
        for v in cells:
            odds = math.log(share / (1 - share)) + sum(
                math.log(given[k][1][v[k]] / given[k][0][v[k]]) for k in range(LABELERS)
            )
            posterior[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, given, posterior


def span_classifier(cells: dict[tuple, float], posterior: dict[tuple, float], rounds: int = 400) -> dict:
    """Logistic weights of (feature, value) from soft labels; features are the votes, length and digits."""
    total = sum(cells.values())
    weights: dict[object, float] = defaultdict(float)
    for step in range(rounds):
        slope: dict[object, float] = defaultdict(float)
        for cell, n in cells.items():
            active = [None, *enumerate(cell)]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[a] for a in active)))))
            for a in active:
                slope[a] += n / total * (posterior[cell[:LABELERS]] - p)
        for a, s in slope.items():
            weights[a] += 1.0 * s - 0.0005 * weights[a]
    return dict(weights)


def _accepted(weights: dict, span: Column) -> Column:
    """True where the classifier gives a span at least an even chance."""
    values = [span["votes"][k] for k in range(LABELERS)] + [span["length"], span["digits"]]
    terms = [F.lit(weights.get(None, 0.0))]
    for feature, value in enumerate(values):
        for x in (-1, 0, 1, 2):
            if (feature, x) in weights:
                terms.append(F.when(value == x, F.lit(weights[feature, x])).otherwise(F.lit(0.0)))
    return reduce(lambda a, b: a + b, terms) >= 0


def _added(kind: str, weights: dict | None) -> Column:
    """The candidates of a kind that the classifier accepts; none if it had nothing to learn from."""
    kept = F.array()
    if weights is not None:
        accepted = F.filter(f"more_{kind}", lambda s: _accepted(weights, s))
        kept = F.transform(accepted, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return kept.cast("array<struct<start:bigint,end:bigint>>")


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, an array of base spans per kind, an array of candidates per added kind."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    base = df.select(id_col, F.col(text_col).alias("__text")).select(
        id_col, "__text", *[base_spans(text, k).alias(f"base_{k}") for k in KINDS]
    )
    taken = F.concat(*[F.col(f"base_{k}") for k in KINDS])
    return base.select(
        id_col, *[f"base_{k}" for k in KINDS],
        *[candidate_spans(text, k, taken).alias(f"more_{k}") for k in ADDED],
    )


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``base_KIND`` and ``added_KIND`` arrays of spans."""
    found = stored(scanned(df, id_col, text_col), "spans")
    models = {}
    for kind in ADDED:
        rows = (
            found.select(F.explode(f"more_{kind}").alias("s")).groupBy("s.votes", "s.length", "s.digits").count()
            .collect()  # at most 3^5 * 9 rows
        )
        cells = {(*r["votes"], r["length"], r["digits"]): float(r["count"]) for r in rows}
        if cells:
            patterns: dict[tuple, float] = defaultdict(float)
            for cell in sorted(cells):
                patterns[cell[:LABELERS]] += cells[cell]
            posterior = reliabilities(dict(patterns))[2]
            models[kind] = span_classifier(dict(sorted(cells.items())), posterior)
    added = [_added(kind, models.get(kind)).alias(f"added_{kind}") for kind in ADDED]
    return found.select(id_col, *[f"base_{k}" for k in KINDS], *added)
