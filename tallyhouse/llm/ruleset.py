"""Quality classifier: a sparse ensemble of rules taken from trees."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, documents
from tallyhouse.llm.textstats import FEATURES, measure

#: Bounded sample of labelled rows that the rules and weights are fitted on.
FIT_ROWS = 20_000
TREES, DEPTH, LEAST_LEAF, RATE, CUTS = 40, 3, 10, 0.3, 32
#: Weights of the lasso penalty that are tried; the one with the least loss on a quarter set aside is taken.
PENALTIES = (0.03, 0.01, 0.003, 0.001)
STEPS = 400


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (feature, below, cut): below means ``feature < cut``, else ``feature >= cut``."""

    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(x[f] < c) if below else (x[f] >= c) for f, below, c in self.conditions])

    def column(self, prefix: str = "") -> Column:
        def one(f: str, below: bool, c: float) -> Column:
            value = F.col(f"`{prefix}{f}`")
            return (value < F.lit(c)) if below else (value >= F.lit(c))

        return reduce(Column.__and__, [one(*c) for c in self.conditions])


@dataclass
class Ensemble:
    base: float
    rules: list[tuple[Rule, float]]

    def column(self, prefix: str = "") -> Column:
        """The score as an expression over the features: the logistic function of the weights of the rules that hold."""
        total = reduce(Column.__add__, [F.when(r.column(prefix), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.base))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: dict[str, np.ndarray]) -> np.ndarray:
        total = self.base + sum((w * r.holds(x) for r, w in self.rules), np.zeros(len(next(iter(x.values())))))
        return 1 / (1 + np.exp(-total))


def _split(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[float, int, float] | None:
    best = None
    for f, options in enumerate(cuts):
        if not len(options):
            continue
        bins = np.searchsorted(options, x[:, f], side="right")
        n, a, b = (np.bincount(bins, weights=w, minlength=len(options) + 1) for w in (None, g, h))
        n, a, b = n.cumsum()[:-1], a.cumsum()[:-1], b.cumsum()[:-1]
        gain = a**2 / (b + 1) + (g.sum() - a) ** 2 / (h.sum() - b + 1) - g.sum() ** 2 / (h.sum() + 1)
        gain[(n < LEAST_LEAF) | (len(x) - n < LEAST_LEAF)] = -1
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, float(options[k]))
    return best


def tree_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES, trees: int = TREES) -> list[Rule]:
    """Grow boosted trees and return the path to each of their nodes as a rule, each rule once."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1])) for f in range(x.shape[1])]
    raw = np.zeros(len(y))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        stack = [(np.arange(len(y)), ())]
        while stack:
            rows, path = stack.pop()
            found = _split(x[rows], cuts, g[rows], h[rows]) if len(path) < DEPTH else None
            if found is None:
                raw[rows] += RATE * g[rows].sum() / (h[rows].sum() + 1)
                continue
            _, f, c = found
            for below in (True, False):
                inside = (x[rows, f] < c) == below
                longer = (*path, (names[f], below, c))
                rules[Rule(longer)] = None
                stack.append((rows[inside], longer))
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Weights of a logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n, k = z.shape
    rate = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1)
    base, w = 0.0, np.zeros(k)
    ahead_base, ahead, t = base, w.copy(), 1.0
    for _ in range(steps):
        residual = 1 / (1 + np.exp(-(ahead_base + z @ ahead))) - y
        new_base = ahead_base - rate * residual.mean()
        new = ahead - rate * (z.T @ residual) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_base, ahead = new_base + (t - 1) / t_next * (new_base - base), new + (t - 1) / t_next * (new - w)
        base, w, t = new_base, new, t_next
    return float(base), w


def _loss(base: float, w: np.ndarray, z: np.ndarray, y: np.ndarray) -> float:
    raw = base + z @ w
    return float(np.mean(np.logaddexp(0, raw) - y * raw)) if len(y) else 0.0


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES) -> Ensemble:
    """Rules from trees, and sparse weights for them. With one class or no rows the score is that class's share, or one half."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = tree_rules(x, y, names)
    columns = {f: x[:, i] for i, f in enumerate(names)}
    z = np.stack([r.holds(columns) for r in rules], 1).astype(float) if rules else np.zeros((len(y), 0))
    apart = np.arange(len(y)) % 4 == 3
    tried = [(lasso(z[~apart], y[~apart], p), p) for p in PENALTIES]
    penalty = min(tried, key=lambda m: (_loss(*m[0], z[apart], y[apart]), -m[1]))[1]
    base, w = lasso(z, y, penalty)
    return Ensemble(base, [(r, float(v)) for r, v in zip(rules, w) if v != 0])


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned: CRC32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def learn(measures: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ensemble:
    """Fit on at most ``fit_rows`` labelled rows that are not held out, picked by a hash of their id.

    Labels that are null or have no document are not used. The id and the
    label are used for picking and fitting alone, never as features.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality in (0, 1)").where(~held_out()).distinct()
    known = measures.join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *FEATURES).limit(fit_rows)
    rows = known.select(*FEATURES, "quality").toPandas()
    return fit(rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    The score is the ensemble compiled into one expression over the measures
    of the whole text. Null and empty texts measure zero and get a score like
    any other; equal texts get equal scores; repeated rows keep their rows.
    """
    measures = cut_lineage(measure(documents(docs)).select("doc_id", *FEATURES))
    scored = measures.withColumn("score", learn(measures, labels).column())
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
