"""Quality classifier: a sparse ensemble of rules, compiled to column expressions.

Statistics of a text (lengths, shares of kinds of characters, repeats of words
and lines) are built-in column expressions.  Small trees are grown on labelled
rows; each path from a root is a conjunctive rule, a lasso-penalised logistic
regression weighs rules and (clipped, scaled) statistics, and the rules with a
weight become one column expression.  Scoring is a projection: no shuffle and
no Python.

Fitting takes the TRAIN_ROWS labelled rows with the smallest hash of doc_id and
text (all, if there are fewer); everything else covers all rows.

Defined results: a null text is an empty text and has a score like any other;
labels that are null are not learned from; without labels the score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows used for fitting, at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, LEAST_ROWS, SPLITS = 24, 3, 20, 32
PENALTY, ITERATIONS = 1e-3, 400
#: Predicted 1 from this score on.
THRESHOLD = 0.3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
_MARKS = "#$%&*|<>{}[]~^=+\\_@/"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name; none is null."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    some = F.greatest(chars, F.lit(1))
    without = lambda kinds: F.length(F.translate(text, kinds, ""))
    words = F.split(F.lower(F.trim(text)), r"\s+")
    lines = F.split(text, "\n")
    n_words = F.greatest(F.size(words), F.lit(1))
    share = lambda kinds: (chars - without(kinds)) / some
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "word_chars": chars / n_words,
        "upper": share(_UPPER),
        "digits": share(_DIGITS),
        "marks": share(_MARKS),
        "bars": share("|"),
        "shouts": share("!?"),
        "stops": share(".,;:"),
        "beyond_ascii": (F.octet_length(text) - chars) / some,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "log_distinct_words": F.log1p(F.size(F.array_distinct(words)).cast("double")),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "line_chars": F.log1p(chars / F.greatest(F.size(lines), F.lit(1))),
    }


@dataclass
class RuleEnsemble:
    """Weights of rules, each a conjunction of (statistic, is_above, threshold), and of linear terms (low, high, mean, scale)."""

    names: list[str]
    intercept: float
    rules: list[tuple[tuple[tuple[int, bool, float], ...], float]]
    linear: list[tuple[int, float, float, float, float]]  # statistic, low, high, scale, weight

    def score_column(self, stats: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            test = None
            for j, above, cut in conditions:
                one = stats[self.names[j]] > F.lit(cut) if above else stats[self.names[j]] <= F.lit(cut)
                test = one if test is None else test & one
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        for j, low, high, scale, weight in self.linear:
            total = total + F.lit(weight / scale) * F.least(F.greatest(stats[self.names[j]].cast("double"), F.lit(low)), F.lit(high))
        return 1.0 / (1.0 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for conditions, weight in self.rules:
            total += weight * _holds(conditions, x)
        for j, low, high, scale, weight in self.linear:
            total += weight / scale * np.clip(x[:, j], low, high)
        return 1.0 / (1.0 + np.exp(-total))


def _holds(conditions, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in conditions:
        out &= x[:, j] > cut if above else x[:, j] <= cut
    return out


def _grow(x: np.ndarray, codes: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, rows: np.ndarray, path: tuple, depth: int, rng: np.random.Generator, out: set) -> None:
    if depth == 0 or len(rows) < 2 * LEAST_ROWS or y[rows].min() == y[rows].max():
        return
    best, gain = None, 1e-9
    mean = y[rows].mean()
    for j in rng.permutation(x.shape[1])[: max(1, int(np.ceil(np.sqrt(x.shape[1]))) + 1)]:
        k = len(cuts[j])
        if not k:
            continue
        n = np.bincount(codes[rows, j], minlength=k + 1).cumsum()[:-1]
        s = np.bincount(codes[rows, j], weights=y[rows], minlength=k + 1).cumsum()[:-1]
        rest = len(rows) - n
        fits = (n >= LEAST_ROWS) & (rest >= LEAST_ROWS)
        drop = np.where(fits, n * (s / np.maximum(n, 1) - mean) ** 2 + rest * ((mean * len(rows) - s) / np.maximum(rest, 1) - mean) ** 2, -1.0)
        i = int(drop.argmax())
        if drop[i] > gain:
            best, gain = (int(j), i), float(drop[i])
    if best is None:
        return
    j, i = best
    left = codes[rows, j] <= i
    for above, part in ((False, rows[left]), (True, rows[~left])):
        rule = tuple(sorted((*path, (j, above, float(cuts[j][i])))))
        out.add(rule)
        _grow(x, codes, cuts, y, part, rule, depth - 1, rng, out)


def fit(names: list[str], x: np.ndarray, y: np.ndarray, seed: int = 11) -> RuleEnsemble:
    """The ensemble for statistics ``x`` (rows x names) and labels ``y`` (0 or 1)."""
    if len(y) == 0:
        return RuleEnsemble(names, 0.0, [], [])
    if y.min() == y.max():
        return RuleEnsemble(names, 4.0 if y[0] else -4.0, [], [])
    rng = np.random.default_rng(seed)
    cuts = []
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        marks = np.unique(np.quantile(x[:, j], np.linspace(0, 1, SPLITS + 1)[1:-1], method="nearest"))
        # thresholds lie between values, so that rounding cannot move a row over one
        at = np.minimum(np.searchsorted(values, marks), len(values) - 2) if len(values) > 1 else np.zeros(0, int)
        cuts.append(np.unique((values[at] + values[at + 1]) / 2) if len(at) else np.zeros(0))
    codes = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
    found: set = set()
    for _ in range(TREES):
        _grow(x, codes, cuts, y.astype(float), rng.integers(0, len(y), len(y)), (), DEPTH, rng, found)
    rules = sorted(found)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    spread = np.clip(x, low, high).std(axis=0)
    useful = np.flatnonzero(spread > 1e-12)
    columns = [_holds(r, x).astype(float) for r in rules] + [np.clip(x[:, j], low[j], high[j]) * (0.4 / spread[j]) for j in useful]
    m = np.stack(columns, axis=1) if columns else np.zeros((len(y), 0))
    centre = m.mean(axis=0)
    a = m - centre
    step = 4.0 / max(np.linalg.norm(a, 2) ** 2 / len(y), 1e-9)
    w, z, b, bz, t = np.zeros(m.shape[1]), np.zeros(m.shape[1]), 0.0, 0.0, 1.0
    for _ in range(ITERATIONS):  # proximal gradient with momentum
        off = 1.0 / (1.0 + np.exp(-(a @ z + bz))) - y
        new = z - step * (a.T @ off) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0.0)
        new_b = bz - 4.0 * off.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, bz = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    kept = [(r, float(k)) for r, k in zip(rules, w[: len(rules)], strict=True) if abs(k) > 1e-6]
    linear = [(int(j), float(low[j]), float(high[j]), float(spread[j] / 0.4), float(k)) for j, k in zip(useful, w[len(rules) :], strict=True) if abs(k) > 1e-6]
    return RuleEnsemble(names, float(b - centre @ w), kept, linear)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Fit on labelled rows that are not held out: ``docs`` (doc_id, text), ``labels`` (doc_id, quality)."""
    named = labels.select("doc_id", "quality").filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    named = named.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(train_rows)
    stats = statistics(F.col("text"))
    names = list(stats)
    rows = docs.select("doc_id", "text").join(F.broadcast(named), "doc_id")  # TRAIN_ROWS rows at most
    rows = rows.select(F.xxhash64("doc_id", "text").alias("h"), F.col("quality").cast("int").alias("quality"), *[c.cast("double").alias(n) for n, c in stats.items()])
    got = rows.orderBy("h", "quality").limit(train_rows).toPandas()
    return fit(names, got[names].to_numpy(float), got["quality"].to_numpy(float))


def score_documents(docs: DataFrame, model: RuleEnsemble, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, held_out, score and predicted of every document."""
    staged = _with_statistics(docs, [F.col(c).alias(f"keep_{c}") for c in keep] + [held_out(F.col("doc_id")).alias("held_out")])
    score = _score(model)
    scored = staged.select(*[F.col(f"keep_{c}").alias(c) for c in keep], "held_out", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= F.lit(THRESHOLD)).cast("int"))


def keep_good(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at or over the threshold."""
    staged = _with_statistics(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")])
    return staged.filter(_score(model) >= threshold).select("row.*")


def _with_statistics(docs: DataFrame, others: list[Column]) -> DataFrame:
    """``others`` and the statistics, each computed once.

    The partition number beside them is not deterministic, which keeps the
    optimizer from copying the statistics into every rule of a filter above;
    it stays because the score asks for it.
    """
    stats = statistics(F.col("text"))
    return docs.select(*others, F.spark_partition_id().alias("stat_part"), *[c.cast("double").alias(f"stat_{n}") for n, c in stats.items()])


def _score(model: RuleEnsemble) -> Column:
    names = statistics(F.lit(""))
    return F.when(F.col("stat_part") >= 0, model.score_column({n: F.col(f"stat_{n}") for n in names}))
