"""Scalar expressions at their edges."""

import pytest
from pyspark.sql import functions as F

from energylake import fixed_values as fv
from energylake.functions import columns as c


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", "v", expression(F.col("v")).alias("out"))
            .orderBy("i").select("out").collect()]


def test_period_edges(spark):
    years = [None, 1974.0, 1975.0, 1989.0, 1989.5, 1990.0, 2005.0, 2012.0, 2013.0]
    got = values(spark, years, "double",
                 lambda v: c.band_closed(v, fv.PERIOD_BANDS, fv.PERIOD_LAST))
    last = "Après 2012 (RT2012)"
    assert got == [last, "Avant 1975", "1975-1989", "1975-1989", last, "1990-2005", "1990-2005",
                   "2006-2012 (RT2005)", last]


def test_class_bounds_differ_only_on_the_bound(spark):
    consumption = [None, -1.0, 0.0, 69.9, 70.0, 110.0, 420.0, 421.0]
    upper = values(spark, consumption, "double",
                   lambda v: c.band_upper(v, fv.CLASS_BOUNDS, fv.CLASS_LABELS))
    lower = values(spark, consumption, "double",
                   lambda v: c.band_lower(v, fv.CLASS_BOUNDS, fv.CLASS_LABELS))
    assert upper == [None, "A", "A", "A", "A", "B", "F", "G"]
    assert lower == [None, "G", "A", "A", "B", "C", "G", "G"]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(10.0, 2.0), (10.0, 0.0), (10.0, -2.0), (None, 2.0), (1e308, 1e-308), (float("nan"), 1.0)],
        "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(c.safe_ratio(a, b)).limit(4).collect()] == [5.0, None, None, None]
    assert [r[0] for r in df.select(c.finite_ratio(a, b)).collect()] == [
        5.0, None, -5.0, None, None, None]


def test_clamp_keeps_null(spark):
    assert values(spark, [None, -3.0, 5.0, 900.0], "double", lambda v: c.clamp(v, 0, 500)) == [
        None, 0.0, 5.0, 500.0]


def test_lookup(spark):
    got = values(spark, ["A", "G", "z", None], "string", lambda v: c.lookup(v, fv.CLASS_SCORE, -1.0))
    assert got == [0.5, 6.5, -1.0, -1.0]
    assert values(spark, ["A", None], "string", lambda v: c.lookup(v, {"B": 1})) == [None, None]


def test_flags_by_type(spark):
    def flags(rows, kind):
        df = spark.createDataFrame([(v,) for v in rows], f"v {kind}")
        return [r[0] for r in df.select(c.flag(df, "v")).collect()]

    assert flags([True, False, None], "boolean") == [1, 0, 0]
    assert flags([1, 0, 2, None], "bigint") == [1, 0, 0, 0]
    assert flags(["true", "0", "abc", None], "string") == [1, 0, 0, 0]


@pytest.mark.parametrize("digits, want", [(0, ["1,234,568 €", "0 €", "-1,000 €", "2 €"]),
                                          (2, ["1,234,567.89 €", "0.40 €", "-1,000.00 €", "2.50 €"])])
def test_format_amount_like_python(spark, digits, want):
    numbers = [1234567.891, 0.4, -1000.0, 2.5]
    assert want == [f"{n:,.{digits}f} €" for n in numbers]
    assert values(spark, numbers, "double", lambda v: c.format_amount(v, digits, " €")) == want


def test_json_keeps_nulls_and_accents(spark):
    df = spark.createDataFrame([("très", None)], "a string, b int")
    text = df.select(c.encode_json("a", "b")).first()[0]
    assert text == '{"a":"très","b":null}'
    back = spark.createDataFrame([(bytearray(text.encode()),)], "v binary")
    assert back.select(c.decode_json(F.col("v"), "a string, b int").alias("r")).first().r.a == "très"


def test_transition_label_needs_both(spark):
    assert values(spark, ["F", None], "string", lambda v: c.transition_label(v, F.lit("E"))) == [
        "F->E", None]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1,)], ["v_2006.5 (`x`)"])
    assert df.select(c.col("v_2006.5 (`x`)")).first()[0] == 1
