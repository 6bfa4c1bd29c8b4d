"""Ridge regression from one pass over the data.

A fit needs only counts, means and products of columns.  These are summed per
fold on the executors and the driver gets one small matrix per fold, whatever the
number of rows.  Every penalty, every fold and the scaling follow from them, so
cross-validation does not read the table again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energylake.functions.columns import col, encoded

PACKED = "fold int, n double, mean array<double>, matrix array<double>"
SALTS = 1_024


@dataclass(frozen=True)
class Moments:
    """Row count, means and centred products of (features..., target)."""

    n: float
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        """Of a table with one row per feature (and the target last) and one column per record."""
        mean = rows.mean(axis=1)
        rows = rows - mean[:, None]
        return cls(float(rows.shape[1]), mean, rows @ rows.T)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n),
                       self.scatter + other.scatter
                       + np.outer(gap, gap) * (self.n * other.n / n))

    def deviations(self) -> np.ndarray:
        """Population deviations; 1 for a constant column."""
        std = np.sqrt(np.maximum(np.diag(self.scatter), 0) / self.n)
        # rounding leaves a constant column with a tiny spread instead of none
        return np.where(std > 1e-12 * np.abs(self.mean), std, 1.0)

    def scaled(self, mean: np.ndarray, std: np.ndarray) -> Moments:
        """Moments of the same rows with features (x - mean) / std; the target is kept."""
        mean, std = np.append(mean, 0.0), np.append(std, 1.0)
        return Moments(self.n, (self.mean - mean) / std, self.scatter / np.outer(std, std))

    def ridge(self, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and unpenalised intercept."""
        xx, xy = self.scatter[:-1, :-1], self.scatter[:-1, -1]
        coef = np.linalg.solve(xx + alpha * np.eye(len(xy)), xy)
        return coef, float(self.mean[-1] - coef @ self.mean[:-1])

    def r2(self, coef: np.ndarray, intercept: float) -> float:
        """R2 of a fit on these rows; with a constant target 1 without error, else 0."""
        v = np.append(-coef, 1.0)
        bias = self.mean @ v - intercept
        sse = v @ self.scatter @ v + self.n * bias * bias
        sst = self.scatter[-1, -1]
        # as in deviations(), rounding alone is no spread
        if sst > self.n * (1e-12 * self.mean[-1]) ** 2:
            return float(1 - sse / sst)
        return float(sse <= self.n * (1e-12 * self.mean[-1]) ** 2)


@dataclass(frozen=True)
class Factors:
    """As ``Moments``, with a triangle ``root`` whose square the centred products are.

    Products square the condition of the columns and lose half the digits where some are nearly
    collinear; a triangle does not.  Triangles merge by a factorisation of one above the other.
    """

    n: float
    mean: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Factors:
        """Of a table with one row per feature (and the target last) and one column per record."""
        mean = rows.mean(axis=1)
        return cls(float(rows.shape[1]), mean, triangle((rows - mean[:, None]).T))

    def __add__(self, other: Factors) -> Factors:
        n = self.n + other.n
        gap = other.mean - self.mean
        shift = gap * np.sqrt(self.n * other.n / n)
        return Factors(n, self.mean + gap * (other.n / n), triangle(np.vstack([self.root, other.root, shift])))

    def deviations(self) -> np.ndarray:
        """Population deviations; 1 for a constant column."""
        std = np.sqrt((self.root * self.root).sum(axis=0) / self.n)
        return np.where(std > 1e-12 * np.abs(self.mean), std, 1.0)

    def scaled(self, mean: np.ndarray, std: np.ndarray) -> Factors:
        """Factors of the same rows with features (x - mean) / std; the target is kept."""
        mean, std = np.append(mean, 0.0), np.append(std, 1.0)
        return Factors(self.n, (self.mean - mean) / std, self.root / std)

    def ridge(self, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and unpenalised intercept; the smallest ones where several fit alike."""
        p = len(self.mean) - 1
        rows = np.vstack([self.root[:, :-1], np.sqrt(alpha) * np.eye(p)])
        coef = np.linalg.lstsq(rows, np.append(self.root[:, -1], np.zeros(p)), rcond=None)[0]
        return coef, float(self.mean[-1] - coef @ self.mean[:-1])

    def r2(self, coef: np.ndarray, intercept: float) -> float:
        """R2 of a fit on these rows; with a constant target 1 without error, else 0."""
        v = np.append(-coef, 1.0)
        bias = self.mean @ v - intercept
        sse = np.square(self.root @ v).sum() + self.n * bias * bias
        sst, nought = np.square(self.root[:, -1]).sum(), self.n * (1e-12 * self.mean[-1]) ** 2
        return float(1 - sse / sst) if sst > nought else float(sse <= nought)


def triangle(rows: np.ndarray) -> np.ndarray:
    """The square upper triangle with the same products of columns as ``rows``."""
    root, width = np.linalg.qr(rows, mode="r"), rows.shape[1]
    return np.vstack([root, np.zeros((width - len(root), width))])


def fold_moments(df: DataFrame, features: Sequence[str], y: str, fold: str | None = None,
                 vocab: Mapping[str, Sequence[str]] | None = None,
                 kind: type = Moments) -> dict[int, Moments | Factors]:
    """Moments per fold number (fold 0 alone without a fold column), in one job.

    ``vocab`` adds the dummies of category columns after the numeric features, the
    first value of each being the base; a category travels as one small number and
    becomes dummies inside the task.

    Each task keeps one centred matrix per fold, so nothing cancels however far the data
    lie from zero.  The matrices travel as packed rows and are merged in two levels, by a
    salt and by fold; the driver gets one row per fold.  With ``kind=Factors`` they are
    triangles, for columns that are nearly collinear, at some twice the time of the products.
    """
    names, vocab = [*features, y], vocab or {}
    widths = [max(0, len(values) - 1) for values in vocab.values()]
    rows = df.select(
        (col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
        *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)],
        *[encoded(col(c).cast("string"), {v: k for k, v in enumerate(values)}, 0).alias(f"c{i}")
          for i, (c, values) in enumerate(vocab.items())])
    parts = rows.mapInArrow(_batch_moments(len(names), widths, kind), PACKED)
    salted = parts.repartition("fold", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    merge = _merge(kind)
    merged = salted.mapInArrow(merge, PACKED).repartition("fold").mapInArrow(merge, PACKED)
    found = {r["fold"]: _unpacked(kind, r["n"], r["mean"], r["matrix"]) for r in merged.collect()}
    if not found:
        raise ValueError("no rows to fit on")
    if any(np.isnan(m.mean).any() for m in found.values()):
        raise ValueError("features and target must not hold nulls")
    return dict(sorted(found.items()))


def _unpacked(kind: type, n: float, mean, matrix) -> Moments | Factors:
    mean = np.array(mean, dtype=float)
    return kind(n, mean, np.array(matrix, dtype=float).reshape(len(mean), len(mean)))


def _packed(sums: Mapping[int, Moments | Factors]) -> Iterator[pa.RecordBatch]:
    for k, m in sums.items():
        matrix = m.root if isinstance(m, Factors) else m.scatter
        lists = [pa.array([x.ravel()], pa.list_(pa.float64())) for x in (m.mean, matrix)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([m.n], pa.float64()), *lists],
            names=["fold", "n", "mean", "matrix"])


def _merge(kind: type):
    """Task function: one matrix per fold from many, a few rows in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for i in range(batch.num_rows):
                k, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                part = _unpacked(kind, n, *(batch.column(c)[i].values.to_numpy() for c in (2, 3)))
                sums[k] = sums[k] + part if k in sums else part
        yield from _packed(sums)

    return run


def _batch_moments(numbers: int, widths: list[int], kind: type):
    """Task function: moments per fold of (numbers..., dummies..., target)."""

    def table(columns: list[np.ndarray]) -> np.ndarray:
        z = np.zeros((numbers + sum(widths), len(columns[0])))
        z[:numbers - 1] = columns[:numbers - 1]
        z[-1] = columns[numbers - 1]
        base = numbers - 2
        for codes, width in zip(columns[numbers:], widths):
            hits = np.flatnonzero(codes)
            z[base + codes[hits], hits] = 1.0
            base += width
        return z

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            folds, *columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            z = table(columns)
            for k in map(int, np.unique(folds)):
                found = kind.of(z[:, folds == k])
                sums[k] = sums[k] + found if k in sums else found
        yield from _packed(sums)

    return run


def fit_ridge(df: DataFrame, features: Sequence[str], y: str, alpha: float, kind: type = Moments) -> DataFrame:
    """Coefficient rows (feature, coef) with the intercept under ``(intercept)``."""
    coef, intercept = fold_moments(df, features, y, kind=kind)[0].ridge(alpha)
    rows = [*zip(features, map(float, coef)), ("(intercept)", intercept)]
    return df.sparkSession.createDataFrame(rows, "feature string, coef double")


def cross_validate(moments: dict[int, Moments | Factors], alphas: Sequence[float]) -> list[tuple]:
    """(alpha, mean R2, deviation of R2) over the held-out folds."""
    results = []
    for alpha in alphas:
        scores = []
        for k, held_out in moments.items():
            rest = reduce(add, [m for i, m in moments.items() if i != k])
            scores.append(held_out.r2(*rest.ridge(alpha)))
        results.append((float(alpha), float(np.mean(scores)), float(np.std(scores))))
    return results


def best_alpha(results: Sequence[tuple]) -> float:
    """Penalty with the highest mean R2, the first one on a tie; NaN ranks last."""
    return max(results, key=lambda r: -np.inf if np.isnan(r[1]) else r[1])[0]


def select_alpha(df: DataFrame, features: Sequence[str], y: str, alphas: Sequence[float],
                 fold: str, kind: type = Moments) -> DataFrame:
    """Cross-validated score per penalty; ``chosen`` marks the one to use."""
    results = cross_validate(fold_moments(df, features, y, fold, kind=kind), alphas)
    chosen = best_alpha(results)
    return df.sparkSession.createDataFrame(
        [(a, m, s, a == chosen) for a, m, s in results],
        "alpha double, r2_mean double, r2_std double, chosen boolean")
