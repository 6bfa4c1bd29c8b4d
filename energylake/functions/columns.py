"""Scalar column expressions, all inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def encoded(c: Column, mapping: Mapping[str, int], default: int | None = None,
            lower: bool = False) -> Column:
    """Code of a text value; ``default`` for null and for values not listed."""
    text = F.lower(c) if lower else c
    return lookup(text, mapping, default).cast("int")


def lookup(c: Column, mapping: Mapping, default=None) -> Column:
    """Value of ``c`` in a small literal mapping, ``default`` on a miss.

    A flat CASE stays inside generated code and stops at the first hit.
    """
    if not mapping:
        return F.lit(default)
    branches = None
    for key, value in mapping.items():
        branches = F.when(c == F.lit(key), F.lit(value)) if branches is None else (
            branches.when(c == F.lit(key), F.lit(value)))
    return branches if default is None else branches.otherwise(F.lit(default))


def flag(df: DataFrame, name: str) -> Column:
    """0/1 of a true/false column; null and unreadable values count as 0."""
    kind, c = df.schema[name].dataType, col(name)
    if isinstance(kind, T.BooleanType):
        truth = c
    elif isinstance(kind, T.NumericType):
        truth = c == 1
    else:
        truth = c.try_cast("boolean")
    return F.when(truth, 1).otherwise(0)


def band_closed(c: Column, bands: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first band holding ``c``; both ends of a band count.

    ``bands`` holds (low, high, label); low ``None`` means strictly below high.
    Null and values between two bands get ``otherwise``.
    """
    out = None
    for low, high, label in bands:
        inside = c < high if low is None else c.between(low, high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(otherwise)


def band_upper(c: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by bounds that belong to the class below them; null stays null."""
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(c <= bound, label)
    return out.otherwise(labels[len(bounds)])


def band_lower(c: Column, bounds: Sequence[float], labels: Sequence[str],
               start: float = 0) -> Column:
    """Label by bounds that belong to the class above them; null stays null.

    Values under ``start`` fit no class and get the last label.
    """
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for low, high, label in zip([start, *bounds], bounds, labels):
        out = out.when((c >= low) & (c < high), label)
    return out.otherwise(labels[len(bounds)])


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den where den is positive, else null."""
    return F.when(den > 0, num / den)


def finite_ratio(num: Column, den: Column) -> Column:
    """num / den; null for a zero denominator and for a result that is not finite."""
    return finite(F.try_divide(num.try_cast("double"), den.try_cast("double")))


def finite(c: Column) -> Column:
    """``c`` with NaN and infinities as null."""
    return F.when(F.abs(c) < float("inf"), c)


def clamp(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """``c`` held between low and high; null stays null."""
    out = c
    if low is not None:
        out = F.when(out < low, float(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, float(high)).otherwise(out)
    return out


def transition_label(start: Column, end: Column) -> Column:
    """``F->E``; null when one side is."""
    return F.concat(start, F.lit("->"), end)


def format_amount(c: Column, digits: int = 0, suffix: str = "") -> Column:
    """Number with thousands separators and a unit, as text."""
    return F.concat(F.format_number(c, digits), F.lit(suffix))


def decode_json(c: Column, schema: T.StructType | str) -> Column:
    """Struct read from JSON text (text or bytes of a message)."""
    return F.from_json(c.cast("string"), schema)


def encode_json(*columns: Column | str) -> Column:
    """JSON object of the columns; a null is written as ``null``, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def ingest_parts(ts: Column) -> dict[str, Column]:
    """Partition date and time-of-day tag of an arrival time."""
    return {"date": F.to_date(ts), "heure": F.date_format(ts, "HHmmss")}


def number(c: Column) -> Column:
    """``c`` as double with NaN as null, the form in which values are counted."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)
