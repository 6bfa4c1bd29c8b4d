"""Exact and sketched quantiles against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from energylake.operators import quantiles as q


def disc(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    return values[max(1, math.ceil(p * len(values))) - 1]


def frames():
    rng = np.random.default_rng(7)
    smooth = rng.normal(size=4000).tolist()
    hot = [5.0] * 2500 + rng.normal(5, 1, 1500).tolist()
    wide = (10.0 ** rng.uniform(-200, 200, 4000)).tolist()
    gaps = [None if i % 3 == 0 else float("nan") if i % 7 == 0 else float(i) for i in range(4000)]
    ends = [float("-inf")] * 10 + rng.uniform(size=3980).tolist() + [float("inf")] * 10
    return {"smooth": smooth, "hot": hot, "wide": wide, "gaps": gaps, "ends": ends}


@pytest.fixture(scope="module")
def data(spark):
    columns = frames()
    rows = [tuple(columns[c][i] for c in columns) for i in range(4000)]
    schema = ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame(rows, schema).repartition(7).cache()


@pytest.mark.parametrize("final_rows", [10_000, 50])
def test_exact_many_rounds(data, monkeypatch, final_rows):
    """A small limit on collected values forces several narrowing rounds."""
    monkeypatch.setattr(q, "FINAL_ROWS", final_rows)
    if final_rows < 10_000:
        monkeypatch.setattr(q, "SKETCH_ERROR", 0.02)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = q.quantiles(data, data.columns, probs, 0)
    for name, values in frames().items():
        assert found[name] == [disc(values, p) for p in probs], name


def test_a_wrong_sketch_cannot_give_a_wrong_value(data, monkeypatch):
    """Edges only steer the search; the counts decide."""
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    monkeypatch.setattr(q, "_brackets", lambda df, searches: [
        (s.low, s.high) if s.inside <= 50 else _some_value(df, s) for s in searches])
    assert q.quantiles(data, ["smooth"], [0.5], 0)["smooth"] == [disc(frames()["smooth"], 0.5)]


def _some_value(df, search):
    inside = df.select(search.candidates().alias("x")).where("x is not null")
    v = inside.agg(F.avg("x")).first()[0]
    below = inside.where(F.col("x") <= v).agg(F.max("x")).first()[0]
    return below, below


def test_medians_average_the_middle(spark):
    df = spark.createDataFrame([(1.0, "4", None), (3.0, "x", None), (8.0, "2", None), (4.0, None, None)],
                               "even double, text string, none double")
    assert q.medians(df, df.columns) == {"even": 3.5, "text": 3.0, "none": None}


def test_empty_column_and_no_columns(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    for err in (0, 0.01):
        assert q.quantiles(df, ["a", "b"], [0.5], err) == {"a": [], "b": [1.0]}
    assert q.quantiles(df, [], [0.5]) == {}


def test_sketch_is_within_its_error(data):
    values = sorted(frames()["smooth"])
    found = q.quantiles(data, ["smooth"], [0.1, 0.5, 0.9], 0.01)["smooth"]
    for p, v in zip([0.1, 0.5, 0.9], found):
        assert abs(values.index(v) / len(values) - p) <= 0.0101


def test_partitions_do_not_matter(data):
    one, many = (q.quantiles(data.repartition(n), ["hot", "gaps"], [0.3, 0.5], 0) for n in (1, 17))
    assert one == many


def test_sketches_merge_in_two_levels(spark, data, monkeypatch):
    """The scan keeps its splits, and a task of the first level merges those of one salt."""
    monkeypatch.setattr(q, "SALTS", 3)
    values = sorted(frames()["smooth"])
    plans = []
    collect = type(data).collect
    monkeypatch.setattr(type(data), "collect", lambda df: plans.append(
        df._jdf.queryExecution().toString()) or collect(df))
    found = q.quantiles(data.repartition(60), ["smooth"], [0.5], 0.01)["smooth"][0]
    assert abs(values.index(found) / len(values) - 0.5) <= 0.0101
    assert len(plans) == 1 and "Coalesce" not in plans[0]
    assert "keys=[column" in plans[0] and "salt" in plans[0]
