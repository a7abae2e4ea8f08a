"""A quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins. Boosting goes round the features; at each it fits a shallow tree on
the bins to what the model still gets wrong and adds it, shrunk, to that feature's table. Then the
same is done for the pairs of features that help most. A score is a sum of table look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from srcsieve.llm.common import in_fold
from srcsieve.llm.quality_rules import quality_counts
from srcsieve.llm.text_stats import features
from srcsieve.session import materialise

THRESHOLD = 0.3
#: Labelled rows that the model is fitted on at most, those with the smallest hash of the id.
MAX_TRAINING_ROWS = 100_000


@dataclass
class Model:
    """Bin edges per feature and tables of log odds, per feature and per pair."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(values), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, j], "right")]
        coarse = [np.searchsorted(edges, values[:, j], "right") for j, edges in enumerate(self.coarse)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _leaf(g, h, smooth: float):
    return g / (h + smooth)


def _cut(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, int]:
    """The best gain of one cut of a row of bins, and where it lies."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + smooth) + right_g**2 / (right_h + smooth) - g.sum() ** 2 / (h.sum() + smooth)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Leaf values of a tree over a row of bins, grown best cut first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_cut(g[a:b], h[a:b], smooth), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-12:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), smooth)
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[np.ndarray, float]:
    """A tree over two features: one cut of the first, then one of the second in either half, or the reverse."""
    best, gain_of_best = np.zeros(g.shape), -1.0
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        _, at = _cut(gg.sum(axis=1), hh.sum(axis=1), smooth)
        values, gain = np.zeros(gg.shape), 0.0
        for rows in (slice(0, at), slice(at, None)):
            row_g, row_h = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
            _, cut = _cut(row_g, row_h, smooth)
            for columns in (slice(0, cut), slice(cut, None)):
                sum_g, sum_h = row_g[columns].sum(), row_h[columns].sum()
                values[rows, columns] = _leaf(sum_g, sum_h, smooth)
                gain += sum_g**2 / (sum_h + smooth)
        if gain > gain_of_best:
            best, gain_of_best = values.T if turned else values, gain
    return best, gain_of_best


def fit(
    values: np.ndarray,
    labels: np.ndarray,
    bins: int = 48,
    coarse_bins: int = 8,
    rounds: int = 120,
    pair_rounds: int = 40,
    n_pairs: int = 6,
    leaves: int = 4,
    rate: float = 0.15,
    smooth: float = 5.0,
) -> Model:
    """A model of ``labels`` (0 or 1) from rows of features; without rows every score is one half."""
    n, width = values.shape
    intercept = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    edges = [_edges(values[:, j], bins) for j in range(width)]
    coarse = [_edges(values[:, j], coarse_bins) for j in range(width)]
    place = [np.searchsorted(e, values[:, j], "right") for j, e in enumerate(edges)]
    cell = [np.searchsorted(e, values[:, j], "right") for j, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(n, intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds if n else 0):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = rate * _tree(np.bincount(place[j], g, size), np.bincount(place[j], h, size), leaves, smooth)
            tables[j] += step
            total += step[place[j]]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        at = cell[a] * shape[1] + cell[b]
        g, h = slopes()
        return tuple(np.bincount(at, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    ranked = sorted(combinations(range(width), 2), key=lambda p: -_pair_tree(*sums(*p), smooth)[1]) if n else []
    pairs = ranked[:n_pairs]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for table, (a, b) in zip(pair_tables, pairs):
            step = rate * _pair_tree(*sums(a, b), smooth)[0]
            table += step
            total += step[cell[a], cell[b]]
    return Model(intercept, edges, tables, pairs, coarse, pair_tables)


def learn(counts: DataFrame, labels: DataFrame, id_col: str, max_rows: int = MAX_TRAINING_ROWS, **shape) -> Model:
    """A model from labelled rows outside the held-out fold, at most ``max_rows`` of them.

    Of repeated labels the smallest counts; null ones do not.
    """
    known = (
        labels.select(labels[id_col].alias(id_col), labels["quality"].alias("quality"))
        .where(F.col("quality").isNotNull() & ~in_fold(F.col(id_col)))
        .groupBy(id_col)
        .agg(F.min("quality").alias("quality"))
    )
    columns = [c.alias(name) for name, c in features(F.col).items()]
    rows = counts.join(known, id_col).select(F.xxhash64(id_col).alias("_order"), "quality", *columns)
    sample = rows.orderBy("_order").limit(max_rows).toPandas()
    names = list(features(F.col))
    return fit(sample[names].to_numpy(dtype=float), (sample["quality"].to_numpy() > 0).astype(float), **shape)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    max_rows: int = MAX_TRAINING_ROWS,
    **shape,
) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` of every row of ``docs``.

    Only statistics of the text enter a score. A null text counts as empty, and an empty one is
    scored by its zero statistics. Null ids and repeated rows each come back; other columns are
    dropped.
    """
    counts = materialise(quality_counts(docs, id_col, text_col), "quality-counts")
    model = learn(counts, labels, id_col, max_rows, **shape)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    scored = counts.select(id_col, in_fold(F.col(id_col)).alias("held_out"), score(*features(F.col).values()).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
