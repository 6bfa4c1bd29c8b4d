"""Cleaning steps of the bronze to silver stage.

Every step adds its columns in one projection.  Steps whose source types are not
under our control use ``try_cast``: a bad value becomes null, as with ANSI off.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.functions.columns import col, encoded, flag, number
from energylake.operators.quantiles import medians, numeric_columns, quantiles


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names the frame has, in the order given."""
    have = set(df.columns)
    return [n for n in names if n in have]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named columns; absent names do not matter."""
    return df.drop(*names)


def has_value(df: DataFrame, name: str) -> Column:
    """The column is neither null nor NaN, the rule of ``drop_incomplete``."""
    known = col(name).isNotNull()
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return known & ~F.isnan(col(name)) if floating else known


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that have a value in every named column."""
    return df.dropna(subset=list(cols))


def encode_ordinal(df: DataFrame, cols: str | Sequence[str], mapping: Mapping[str, int],
                   default: int | None = None, lower: bool = False,
                   out: str | None = None) -> DataFrame:
    """Adds ``<c>_num`` (or ``out``) with the code of each text value."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({
        out or f"{c}_num": encoded(col(c), mapping, default, lower) for c in cols})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null to 0.0, other values rounded to single precision."""
    return _replace(df, {c: F.coalesce(col(c).try_cast("float"), F.lit(0.0))
                         for c in present(df, cols)})


def encode_boolean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """True to 1, everything else to 0."""
    return _replace(df, {c: flag(df, c) for c in present(df, cols)})


def impute_median(df: DataFrame, cols: Sequence[str], rel_err: float = 0.01,
                  exact: bool = False) -> DataFrame:
    """Null to the column's median, found in one job for all columns.

    The default works in single precision on the numeric columns only.  With
    ``exact`` text is read as a number first and double precision is kept; the
    median is only searched in columns that do have gaps.
    """
    if exact:
        return _impute_exact(df, present(df, cols))
    names = numeric_columns(df, cols)
    middle = quantiles(df, names, [0.5], rel_err)
    return fill_gaps(df, {c: middle[c][0] for c in names if middle[c]})


def fill_gaps(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Null to the column's given value, in single precision."""
    return _replace(df, {c: F.coalesce(col(c).cast("float"), F.lit(float(v))) for c, v in values.items()})


def _impute_exact(df: DataFrame, names: list[str]) -> DataFrame:
    middle = medians(df, names, gaps_only=True)
    return _replace(df, {
        c: number(col(c)) if middle.get(c) is None
        else F.coalesce(number(col(c)), F.lit(middle[c])) for c in names})


def clip_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5,
             rel_err: float = 0.01) -> DataFrame:
    """Values beyond k interquartile ranges from the quartiles are set to that bound."""
    names = numeric_columns(df, cols)
    quartiles = quantiles(df, names, [0.25, 0.75], rel_err)
    return clip_between(df, {c: fences(*quartiles[c], k) for c in names if quartiles[c]})


def fences(q1: float, q3: float, k: float = 1.5) -> tuple[float, float]:
    """Bounds ``k`` interquartile ranges beyond the quartiles."""
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def clip_between(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values beyond a column's given bounds are set to the bound, in single precision."""
    return _replace(df, {
        c: F.when(col(c) < low, low).when(col(c) > high, high).otherwise(col(c)).cast("float")
        for c, (low, high) in bounds.items()})


def log_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """log(1 + x) in place; null where x is -1 or less."""
    return _replace(df, {c: F.log1p(col(c).try_cast("float")) for c in present(df, cols)})


def fill_label(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Null categories to a label of their own."""
    return df.fillna(label, subset=present(df, cols))


def _replace(df: DataFrame, columns: dict) -> DataFrame:
    return df.withColumns(columns) if columns else df
