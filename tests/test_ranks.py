"""Rows at given ranks against sorted lists, and exact splits."""

import datetime
import math

import pytest

from energylake.operators import ranks
from energylake.operators import rows as r
from energylake.plans import jobs
from pyspark.sql import functions as F

DAY = datetime.datetime(2026, 3, 29, 1, 30)
KINDS = {
    "double": [float("nan"), float("inf"), float("-inf"), -0.5, 2.5, None] * 3 + [i / 7 for i in range(60)],
    "string": ["", "é", "漢", None, "a'b", "a\\b"] + [f"k{i % 13}" for i in range(60)],
    "timestamp": [DAY + datetime.timedelta(minutes=20 * i) for i in range(70)] + [None],
    "struct<a:int,b:array<string>>": [(i % 3, [str(i % 5), None][:i % 3]) for i in range(60)] + [None, (None, None)],
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_slices_of_any_type(spark, monkeypatch, kind):
    monkeypatch.setattr(ranks, "SAMPLE", 30)
    monkeypatch.setattr(ranks, "FINAL_KEYS", 15)
    monkeypatch.setattr(r, "TOP_ROWS", 0)
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(KINDS[kind])], f"k {kind}, i int").repartition(3)
    order = ranks.sort_key(frame, F.col("k"))
    want = [x["i"] for x in frame.orderBy(order).collect()]
    assert [x["i"] for x in r.slice_rows(frame, "k", 7, 11).collect()] == want[11:18]
    assert r.slice_rows(frame, "k", 5, len(want)).count() == 0


def test_equal_rows_are_cut_at_both_ends(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLE", 20)
    monkeypatch.setattr(ranks, "FINAL_KEYS", 30)
    monkeypatch.setattr(r, "TOP_ROWS", 0)
    values = [1] * 5 + [2] * 40 + [3] * 2 + [4] * 30
    frame = spark.createDataFrame([(v, {"m": v}) for v in values], "k int, m map<string,int>").repartition(4)
    for limit, offset in ((10, 3), (20, 10), (None, 44)):
        got = r.slice_rows(frame, "k", limit, offset).collect()
        assert [x["k"] for x in got] == values[offset:][:limit]
        assert all(x["m"] == {"m": x["k"]} for x in got)


@pytest.mark.parametrize("n", [0, 4, 1000])
def test_split_and_folds_have_their_exact_sizes(spark, monkeypatch, n):
    monkeypatch.setattr(ranks, "SAMPLE", 100)
    monkeypatch.setattr(ranks, "FINAL_KEYS", 100)
    frame = spark.range(n).select((F.col("id") % 300).alias("k"), (F.col("id") % 2).alias("v"))
    split = r.split_exactly(frame, ["k"])
    counts = {x["split"]: x["count"] for x in split.groupBy("split").count().collect()}
    assert counts.get("test", 0) == math.ceil(0.2 * n) and sum(counts.values()) == n
    folds = {x["fold"]: x["count"] for x in r.fold_exactly(frame, ["k"]).groupBy("fold").count().collect()}
    assert [folds.get(i, 0) for i in range(5)] == [n // 5 + (i < n % 5) for i in range(5)]
    assert split.drop("split").exceptAll(frame).isEmpty() and frame.exceptAll(split.drop("split")).isEmpty()
    if n == 1000:
        again = r.split_exactly(frame.repartition(7), ["k"])
        assert split.exceptAll(again).isEmpty()
        assert not split.exceptAll(r.split_exactly(frame, ["k"], seed=7)).isEmpty()
        torn = split.groupBy("k").agg(F.count_distinct("split").alias("sides")).filter("sides > 1").count()
        assert torn <= 1  # only the key on the border may lie on both sides


def test_one_hot_key_is_split_exactly(spark):
    frame = spark.range(1000).select(F.lit("same").alias("k"))
    assert r.split_exactly(frame, ["k"]).groupBy("split").count().orderBy("split").collect() == [("test", 200), ("train", 800)]


def test_training_rows_with_exact_sizes(spark):
    spec = jobs.TrainingSpec(categories=["c"], numbers=["x"], conso="y", surface="s", exact=True)
    frame = spark.range(503).select(F.lit("a").alias("c"), F.col("id").cast("double").alias("x"),
                                    F.lit(2.0).alias("s"), (F.col("id") % 50 + 100.0).alias("y"))
    rows = jobs.training_rows(frame, spec).groupBy("fold").count().orderBy("fold").collect()
    assert [tuple(x) for x in rows] == [(-1, 101), (0, 81), (1, 81), (2, 80), (3, 80), (4, 80)]
