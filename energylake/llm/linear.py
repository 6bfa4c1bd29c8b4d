"""Linear models on indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energylake.llm.ngrams import Grams, class_counts, rows_of_features, without_collisions


@dataclass
class Rows:
    """Sparse 0/1 rows: the features of row i are ``at[start[i]:start[i + 1]]``."""

    start: np.ndarray
    at: np.ndarray
    label: np.ndarray

    def __post_init__(self):
        self.row = np.repeat(np.arange(len(self.label)), np.diff(self.start))

    def times(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weight[self.at], minlength=len(self.label))

    def back(self, value: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.at, weights=value[self.row], minlength=width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def ratios(sample: DataFrame, grams: Grams, width: int, alpha: float, least_z: float
           ) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature hashes and their log-count ratios.

    The ratio compares the share of label-1 texts that hold an n-gram with that of label-0
    texts.  Features are the ``width`` ratios farthest from zero in standard errors.
    """
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    ones, zeros = F.col("ones") + alpha, F.col("zeros") + alpha
    ratio = F.log(ones / (sizes[1] + 2 * alpha)) - F.log(zeros / (sizes[0] + 2 * alpha))
    z = F.abs(ratio) / F.sqrt(1 / ones + 1 / zeros)
    best = (class_counts(sample, grams).select("gram", ratio.alias("ratio"), z.alias("z"))
            .filter(F.col("z") >= least_z).orderBy(F.desc("z"), "gram").limit(width).collect())
    value = {r["gram"]: r["ratio"] for r in best}
    kept = sorted(without_collisions([r["gram"] for r in best]))
    return np.array(kept, np.uint32), np.array([value[g] for g in kept], np.float64)


def gathered(sample: DataFrame, grams: Grams) -> Rows:
    label, start, at = rows_of_features(sample, grams)
    return Rows(start, at, label)


def fit_logistic(rows: Rows, ratio: np.ndarray, l2: float, steps: int = 100, memory: int = 10
                 ) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic model, by limited-memory BFGS."""
    n, width = len(rows.label), len(ratio)

    def loss(x):
        margin = rows.times(ratio * x[:width]) + x[width]
        value = np.logaddexp(0, margin).sum() - (rows.label * margin).sum()
        error = sigmoid(margin) - rows.label
        slope = np.append(ratio * rows.back(error, width) / n + l2 * x[:width], error.mean())
        return value / n + 0.5 * l2 * (x[:width] ** 2).sum(), slope

    x, past = np.zeros(width + 1), []
    value, slope = loss(x)
    for _ in range(steps):
        way, used = -slope, []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            used.append(a)
            way = way - a * y
        if past:
            s, y = past[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(used)):
            way = way + (a - (y @ way) / (s @ y)) * s
        size, gain = 1.0, slope @ way
        while size > 1e-10:
            next_value, next_slope = loss(x + size * way)
            if next_value <= value + 1e-4 * size * gain:
                break
            size /= 2
        else:
            break
        step, change = size * way, next_slope - slope
        if step @ change > 1e-14:
            past = [*past, (step, change)][-memory:]
        done = value - next_value < 1e-7
        x, value, slope = x + step, next_value, next_slope
        if done:
            break
    return ratio * x[:width], float(x[width])


def fit_hinge(rows: Rows, ratio: np.ndarray, c: float, epochs: int = 20, seed: int = 7
              ) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-loss support vector machine, by dual coordinate descent.

    Rows are scaled to unit length; the intercept is the weight of a constant feature.
    """
    n, y = len(rows.label), 2 * rows.label - 1
    norm = np.sqrt(rows.times(ratio * ratio) + 1e-12)
    w, b, dual = np.zeros(len(ratio)), 0.0, np.zeros(n)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(n):
            at = rows.at[rows.start[i]:rows.start[i + 1]]
            x = ratio[at] / norm[i]
            slack = y[i] * (x @ w[at] + b) - 1
            new = min(max(dual[i] - slack / (x @ x + 1), 0.0), c)
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[at] += step * x
                b += step
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3 * c:
            break
    return w, b


def fit_scale(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Newton steps."""
    ones = label.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        d, h = p - target, p * (1 - p) + 1e-9
        ga, gb = (d * margin).sum() + 1e-3 * a, d.sum()
        haa, hab, hbb = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum()
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return float(a), float(b)
