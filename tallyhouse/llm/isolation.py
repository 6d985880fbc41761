"""Quality rules: an isolation forest on rule statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, documents, map_batches
from tallyhouse.llm.textstats import COUNTS, measure

#: Bounded sample of labelled clean rows that the forest is grown from.
FIT_ROWS = 8_192
TREES, TREE_ROWS = 200, 256
#: Statistics that the forest splits. Those that depend on length alone are left out: short is not odd. So are the shares of
#: digits, stops and repeated lines: as each tree splits at random, they hide what the others show (figures in the README).
STATISTICS = ("mean_word", "symbols_per_word", "bang_share", "upper_share", "repeat_share", "short_share", "same_share", "vocabulary")
#: The threshold may reject at most this share of the labelled clean rows.
CLEAN_LOSS = 0.001
#: Anomalies are counted in bins of this width when the threshold is set.
BIN = 0.001
#: Base rules: fewest words, and the largest share of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 0.30


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays; node 0 is the root, a leaf has feature -1 and holds its path length in ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of every row: 2 to the power of minus its mean path length over the expected one."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t][node]
                inner = f >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(f, 0)] < self.cut[t][node]
                node = np.where(inner, np.where(below, self.left[t][node], self.right[t][node]), node)
            total += self.cut[t][node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.scale)


def grow(sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Grow a forest: every tree splits a subsample at random cuts of random statistics.

    A cut is drawn from the range of the node's rows, widened by a tenth of the
    sample's own range on either side, so that values outside of all that were
    seen come off early as well.
    """
    rng = np.random.default_rng(seed)
    rows = min(rows, len(sample))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))) + 2)
    spread = (sample.max(0) - sample.min(0)) * 0.1 + 1e-3 if len(sample) else np.ones(sample.shape[1])
    size = 2 ** (depth + 1)
    made = [np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size), np.int64), np.zeros((trees, size), np.int64)]
    feature, cut, left, right = made
    for t in range(trees):
        pick = rng.choice(len(sample), rows, replace=False) if len(sample) else np.zeros(0, np.int64)
        used = 1
        stack = [(0, sample[pick], 0)]
        while stack:
            node, x, level = stack.pop()
            if level >= depth or len(x) <= 1:
                cut[t, node] = level + float(expected_path(len(x)))
                continue
            f = rng.integers(sample.shape[1])
            at = rng.uniform(x[:, f].min() - spread[f], x[:, f].max() + spread[f])
            feature[t, node], cut[t, node], left[t, node], right[t, node] = f, at, used, used + 1
            below = x[:, f] < at
            stack += [(used, x[below], level + 1), (used + 1, x[~below], level + 1)]
            used += 2
    return Forest(feature, cut, left, right, float(max(expected_path(rows), 1.0)))


def base_failed(prefix: str = "") -> Column:
    words, repeat = F.col(f"`{prefix}n_words`"), F.col(f"`{prefix}n_repeat_words`")
    return (words < LEAST_WORDS) | (repeat * 100 > words * int(MOST_REPEATED * 100))


@dataclass
class QualityRules:
    """A forest and the anomaly above which a text is rejected."""

    forest: Forest | None
    threshold: float

    def __call__(self, measures: dict[str, np.ndarray]) -> np.ndarray:
        x = np.stack([measures[f] for f in STATISTICS], 1)
        return self.forest.score(x) if self.forest else np.zeros(len(x))


def fit(docs: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS, fit_rows: int = FIT_ROWS) -> QualityRules:
    """Grow the forest from labelled clean rows and calibrate its threshold.

    The forest sees at most ``fit_rows`` rows of quality 1, picked by a hash of
    their id. The threshold weighs *all* labelled rows of both qualities that
    pass the base rules, and rejects at most ``clean_loss`` of those of quality
    1, or one of fewer rows. See ``threshold_of``.

    Labels that are null, or whose document is missing, are not used; a
    document labelled twice counts once for each quality. Without a labelled
    clean row there is no forest and the base rules alone decide.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality in (0, 1)").distinct()
    measures = measure(documents(docs)).drop("text").where(~base_failed())
    known = cut_lineage(measures.join(marks, "doc_id").select("doc_id", "quality", *STATISTICS))
    clean = known.where("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(fit_rows)
    sample = clean.select(*STATISTICS).toPandas().to_numpy(float).reshape(-1, len(STATISTICS))
    if not len(sample):
        return QualityRules(None, 1.0)
    forest = grow(sample)

    def binned(parts):
        for part in parts:
            x = np.stack([part.column(c).to_numpy() for c in STATISTICS], 1)
            yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(np.floor(forest.score(x) / BIN).astype(np.int64))], names=["quality", "bin"])

    counted = map_batches(known, binned, "quality int, bin long").groupBy("bin").agg(
        F.count_if(F.col("quality") == 1).alias("clean"), F.count_if(F.col("quality") == 0).alias("junk"))
    found = counted.orderBy("bin").toPandas()  # at most 1 / BIN rows
    return QualityRules(forest, threshold_of(*(found[c].to_numpy() for c in ("bin", "clean", "junk")), clean_loss))


def threshold_of(bins: np.ndarray, clean: np.ndarray, junk: np.ndarray, clean_loss: float) -> float:
    """The threshold with the least error, from the labelled rows of every bin of anomalies, in order.

    The error is the share of the clean rows above plus the share of the junk
    below. At most ``clean_loss`` of the clean rows may be above, or one row of
    fewer: else a single wrong label would set the threshold. Where no label
    tells thresholds apart, the middle one is taken; without junk, the lowest.
    """
    lost, kept = clean.sum() - clean.cumsum(), junk.cumsum()
    allowed = lost <= max(1 if junk.any() else 0, clean_loss * clean.sum())
    if not junk.any():
        return float((bins[allowed].min() + 1) * BIN)
    error = np.where(allowed, lost / max(clean.sum(), 1) + kept / junk.sum(), np.inf)
    best = int(error.argmin())
    after = bins[best + 1] if best + 1 < len(bins) else bins[best] + 1
    return float((bins[best] + 1 + after) / 2 * BIN)


def judge(docs: DataFrame, rules: QualityRules, text: str = "text", prefix: str = "") -> DataFrame:
    """Append the measures of every text, its anomaly, ``base_failed`` and ``kept``.

    All columns and rows of ``docs`` stay; the new names begin with ``prefix``.
    A null or empty text has no words and fails the base rules. Equal texts
    get equal verdicts.
    """
    out = measure(docs, text, prefix, score=rules).withColumn(f"{prefix}base_failed", base_failed(prefix))
    kept = ~F.col(f"`{prefix}base_failed`") & (F.col(f"`{prefix}score`") <= F.lit(rules.threshold))
    return out.withColumn(f"{prefix}kept", kept)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts and verdict of every document. See ``fit`` and ``judge``."""
    judged = judge(documents(docs), fit(docs, labels))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", F.col("score").alias("anomaly"))
