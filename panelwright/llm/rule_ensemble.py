"""A sparse rule ensemble: tree paths as rules, weighted by a lasso logistic fit.

Shallow boosted trees over text statistics propose conjunctions such as
``capital_share > 0.4 AND distinct_share <= 0.7``. A logistic regression with an L1
penalty gives most of them the weight 0; the others become one Spark column
expression, so that scoring is plain column arithmetic.

The fit sees a bounded sample: at most ``sample_rows`` labelled documents, those with the
smallest hash of their id. Everything else covers all rows.

Defined results: a null or empty text has all statistics 0. Without labels of both classes
the score is the smoothed share of positive labels (0.5 without any). Labels that are null
are not used; a document with several labels counts once for each. Repeated rows are scored
row by row, a very long text as a whole. An empty table gives no rows.
"""

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.texts import add_columns

SAMPLE_ROWS = 20_000
KEEP = 0.3  # the score from which a document is kept
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "distinct_share", "top_share", "stutter_share", "capital_share",
    "digit_share", "symbol_share", "mark_share", "other_share", "line_bytes", "repeated_line_share", "longest_word",
)
_PREFIX = "__s_"
_CAPITALS, _SMALL, _DIGITS = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~_=+\\/{}[]", dtype=np.uint8)
_MARKS = np.frombuffer(b"!?.,;:'\"-()", dtype=np.uint8)


def statistics(text: bytes | None) -> tuple[float, ...]:
    """The values of STATISTICS for one text."""
    if not text:
        return (0.0,) * len(STATISTICS)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line]
    n, size = max(1, len(words)), len(text)
    bytes_of = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    capitals, letters = int(bytes_of[_CAPITALS].sum()), int(bytes_of[_CAPITALS].sum() + bytes_of[_SMALL].sum())
    counts = Counter(words)
    return (
        float(np.log1p(size)), float(np.log1p(len(words))), sum(map(len, words)) / n, len(counts) / n,
        max(counts.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, capitals / max(1, letters),
        int(bytes_of[_DIGITS].sum()) / size, int(bytes_of[_SYMBOLS].sum()) / n, int(bytes_of[_MARKS].sum()) / n,
        int(bytes_of[128:].sum()) / size, size / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(max(map(len, words), default=0))),
    )


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and the statistics, under reserved names."""

    def start():
        return lambda texts: [list(c) for c in zip(*map(statistics, texts))]

    return add_columns(df, text_col, start, ", ".join(f"{_PREFIX}{s} double" for s in STATISTICS))


Condition = tuple[int, bool, float]  # statistic, above?, bound


@dataclass
class RuleModel:
    """Weighted conjunctions over statistics, on the logistic scale."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self) -> Column:
        """The probability as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            parts = [
                F.col(_PREFIX + STATISTICS[s]) > bound if above else F.col(_PREFIX + STATISTICS[s]) <= bound
                for s, above, bound in conditions
            ]
            holds = parts[0]
            for part in parts[1:]:
                holds = holds & part
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _bounds(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def tree_paths(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, bins: int = 48) -> list[tuple]:
    """Paths to all inner nodes and leaves of boosted trees, as sorted conjunctions without repeats."""
    bounds = [_bounds(x[:, s], bins) for s in range(x.shape[1])]
    binned = np.stack([np.searchsorted(b, x[:, s], side="left") for s, b in enumerate(bounds)], axis=1)
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    margin = np.full(len(y), np.log(rate / (1 - rate)))
    found: dict[tuple, None] = {}

    def grow(rows, path, left):
        g, h = (y - p)[rows], (p * (1 - p))[rows]
        if path:
            found[tuple(sorted(path))] = None
        best = (1e-3, None)
        if left and len(rows) >= 40:
            whole = g.sum() ** 2 / (h.sum() + 1)
            for s, b in enumerate(bounds):
                if not len(b):
                    continue
                cell = binned[rows, s]
                gs, hs = np.cumsum(np.bincount(cell, g, len(b) + 1)), np.cumsum(np.bincount(cell, h, len(b) + 1))
                ns = np.cumsum(np.bincount(cell, minlength=len(b) + 1))
                gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - whole
                gain[(ns[:-1] < 15) | (ns[-1] - ns[:-1] < 15)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (s, at))
        if best[1] is None:
            margin[rows] += 0.3 * g.sum() / (h.sum() + 1)
            return
        s, at = best[1]
        low = binned[rows, s] <= at
        bound = float(bounds[s][at])
        grow(rows[low], [*path, (s, False, bound)], left - 1)
        grow(rows[~low], [*path, (s, True, bound)], left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), [], depth)
    return list(found)


def rule_matrix(x: np.ndarray, rules: list[tuple]) -> np.ndarray:
    """1.0 where a rule holds for a row."""
    out = np.ones((len(x), len(rules)))
    for j, conditions in enumerate(rules):
        for s, above, bound in conditions:
            out[:, j] *= (x[:, s] > bound) if above else (x[:, s] <= bound)
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps."""
    n, k = z.shape
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    b, w = float(np.log(rate / (1 - rate))), np.zeros(k)
    step = 4.0 / (np.linalg.norm(np.column_stack([np.ones(n), z]), 2) ** 2 / n)
    vb, vw, t = b, w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(vb + z @ vw, -30, 30)))
        nb = vb - step * float((p - y).mean())
        nw = vw - step * (z.T @ (p - y)) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vb, vw = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return b, w


def fit(x: np.ndarray, y: np.ndarray, penalties=(0.003, 0.001, 0.0003)) -> RuleModel:
    """Rules from trees on the sample; the penalty with the best loss on a quarter that is kept apart."""
    if not len(y) or y.min() == y.max():
        rate = (float(y.sum()) + 1) / (len(y) + 2)
        return RuleModel(float(np.log(rate / (1 - rate))))
    apart = np.arange(len(y)) % 4 == 3
    rules = tree_paths(x[~apart], y[~apart])
    if not rules:
        rate = float(y.mean())
        return RuleModel(float(np.log(rate / (1 - rate))))
    z = rule_matrix(x, rules)

    def loss(penalty):
        b, w = lasso_logistic(z[~apart], y[~apart], penalty)
        m = b + z[apart] @ w
        return float(np.mean(np.log1p(np.exp(-np.abs(m))) + np.maximum(m, 0) - m * y[apart]))

    b, w = lasso_logistic(z, y, min(penalties, key=loss))
    return RuleModel(b, [(rules[j], float(w[j])) for j in np.flatnonzero(np.abs(w) > 1e-9)])


def fold(id_col: str) -> Column:
    """Fifth of the documents by their id; 0 is never learned from. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0))


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """A model from at most ``sample_rows`` labelled documents outside of fold 0."""
    chosen = (
        labels.where((fold(id_col) != 0) & F.col(label_col).isin(0, 1))
        .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
        .distinct().orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample_rows)
    )
    texts = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        F.broadcast(chosen), "__id"  # at most sample_rows pairs of numbers
    )
    names = [_PREFIX + s for s in STATISTICS]
    rows = (
        with_statistics(texts, "__text").select("__id", "__label", *names)
        .orderBy(F.xxhash64("__id"), "__id", "__label", *names).limit(sample_rows).collect()
    )
    x = np.array([r[2:] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([float(r[1]) for r in rows]))


def scored(df: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """All columns and ``__score``."""
    return with_statistics(df, text_col).select(*[f"`{c}`" for c in df.columns], model.score().alias("__score"))
