"""Inputs of the regression: target, dummy columns, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energylake.functions.columns import col, finite_ratio
from energylake.operators.rows import filter_open

MAX_VALUES = 1_000


def training_target(df: DataFrame, num: str, den: str, low: float, high: float,
                    out: str = "target_conso_m2") -> DataFrame:
    """Adds num / den and keeps the rows where it is strictly between low and high."""
    return filter_open(df.withColumn(out, finite_ratio(col(num), col(den))), out, low, high)


def vocabulary(df: DataFrame, cols: Sequence[str], most: int | None = None) -> dict[str, list[str]]:
    """Sorted values of each category column, in one pass.

    Each value becomes a column of the model and a row of its matrix on the driver, so
    more than ``most`` values in all (1,000 unless given) are refused rather than cut.
    """
    most = MAX_VALUES if most is None else most
    if not cols:
        return {}
    rows = (df.select([col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "feature", "value").filter("value is not null")
            .distinct().limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"more than {most} category values; group them first or allow more")
    found = {c: [] for c in cols}
    for feature, value in rows:
        found[feature].append(value)
    return {c: sorted(values) for c, values in found.items()}


def dummies(vocab: Mapping[str, Sequence[str]], taken: Sequence[str] = ()
            ) -> dict[str, tuple[str, str]]:
    """Dummy name to (column, value); the first value of each column is the base.

    A name is ``column_value``, with a number behind it where that is taken already, by
    another dummy or by a column in ``taken``; names differ in more than case.
    """
    found, used = {}, {name.lower() for name in taken}
    for c, values in vocab.items():
        for v in values[1:]:
            name, k = f"{c}_{v}", 2
            while name.lower() in used:
                name, k = f"{c}_{v}_{k}", k + 1
            used.add(name.lower())
            found[name] = (c, v)
    return found


def one_hot(df: DataFrame, cols: Sequence[str],
            vocab: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The category columns replaced by 0/1 columns, first value left out."""
    vocab = vocabulary(df, cols) if vocab is None else vocab
    return df.withColumns({
        name: F.when(col(c).cast("string") == v, 1.0).otherwise(0.0)
        for name, (c, v) in dummies(vocab, df.columns).items()}).drop(*cols)


def fit_scaler(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column in one pass; deviation 1 for a constant column."""
    row = df.agg(*[f(col(c)) for c in features for f in (F.avg, F.stddev_pop)]).first()
    return {c: (row[2 * i], row[2 * i + 1] or 1.0) for i, c in enumerate(features)}


def apply_scaler(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Columns centred and divided by their deviation, in place."""
    return df.withColumns({c: (col(c) - mean) / std for c, (mean, std) in scaler.items()})
