"""Field discovery in one pass, kept sketches, and silver that grows by days."""

import json
import os
import pathlib
import subprocess
import sys

import numpy as np
import pytest

from energylake import fixed_values as fv
from energylake.operators.quantiles import from_sketches, kept_sketches, place_among_values, quantiles
from energylake.plans import jobs
from energylake.session import scratch_path
from energylake.sources.layers import (
    parse_bronze, read_layer, replace_partitions, with_others, write_layer)
from pyspark.sql import functions as F

RULES = jobs.CleaningSpec(dropped=["secret"], critical=["k"], median=["x"], clipped=["x", "y"], rel_err=0.01)
KNOWN = "k long, x double, y double"


def put(root, part, lines):
    folder = os.path.join(root, part)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.json"), "w", encoding="utf-8") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines))


def schema(spark):
    return spark.createDataFrame([], KNOWN).schema


def test_fields_are_found_while_the_lines_are_parsed_once(spark, tmp_path):
    put(tmp_path, "dataset=a/date=2026-03-05", [
        {"k": 1, "x": 1.5, "é t": "ü", "deep": {"p": [1, 2]}, "secret": 1, "dataset": "other"},
        '{"k": 2, "n": 1.5, "none": null}', "{broken", "", "[1]", '{"k": "word", "n": true}'])
    put(tmp_path, "dataset=b/date=2026-03-05", [{"k": 3, "elsewhere": 1}])
    staging = scratch_path(spark, "staging")
    parsed = parse_bronze(spark, str(tmp_path), schema(spark), ["secret"]).filter("dataset = 'a'")
    assert len(parsed.inputFiles()) >= 1 and str(parsed._jdf.queryExecution().optimizedPlan()).count("Relation") == 1
    write_layer(parsed, staging)
    found = with_others(read_layer(spark, staging))
    assert all(staging in f for f in found.inputFiles())
    assert found.columns == ["k", "x", "y", "dataset", "date", "deep", "n", "é t"]
    rows = sorted((tuple(r) for r in found.drop("date").collect()), key=repr)
    assert rows == sorted([
        (1, 1.5, None, "a", '{"p":[1,2]}', None, "ü"), (2, None, None, "a", None, "1.5", None),
        (None, None, None, "a", None, None, None), (None, None, None, "a", None, None, None),
        (None, None, None, "a", None, "true", None)], key=repr)


def test_fields_of_one_dataset_only(spark, tmp_path):
    put(tmp_path, "dataset=a", [{"k": i, "x": float(i), "y": 1.0, "note": f"n{i}"} for i in range(9)])
    put(tmp_path, "dataset=b", [{"k": 1, "elsewhere": 1}])
    silver = scratch_path(spark, "silver")
    report = jobs.bronze_to_silver(spark, str(tmp_path), silver, scratch_path(spark, "staging"), RULES,
                                   schema(spark), "a", discover=True)
    assert {(r["rows_in"], r["rows_out"]) for r in report.collect()} == {(9, 9)}
    out = read_layer(spark, silver)
    assert out.columns == ["k", "x", "y", "dataset", "note"]
    assert {r["note"] for r in out.collect()} == {f"n{i}" for i in range(9)}


def files(path, part):
    return {f: os.stat(os.path.join(path, part, f)).st_mtime_ns
            for f in os.listdir(os.path.join(path, part)) if f.endswith(".parquet")}


def test_a_day_is_cleaned_without_reading_the_others(spark, tmp_path):
    random = np.random.default_rng(1)
    days = {d: [{"k": i, "y": float(random.normal()), **({"x": float(random.normal(m, s))} if random.random() > gaps else {})}
                for i in range(3000)] for d, m, s, gaps in (("2026-03-05", 0, 1, .1), ("2026-03-06", 5, 2, .4))}
    bronze = str(tmp_path)
    silver, sketches = (scratch_path(spark, n) for n in ("silver", "sketches"))

    def clean(day):
        return jobs.clean_day(spark, bronze, silver, scratch_path(spark, "staging"), sketches, day, RULES, schema(spark))

    def within(values, p, v, err=0.0101):
        values = np.sort(np.array(values, np.float32))
        return (np.searchsorted(values, np.float32(v), "left") / len(values) <= p + err
                and np.searchsorted(values, np.float32(v), "right") / len(values) >= p - err)

    def check(found, names):
        x = [r.get("x") for d in names for r in days[d]]
        known = [v for v in x if v is not None]
        assert within(known, 0.5, found.medians["x"])
        for name, all_values in (("x", [found.medians["x"] if v is None else v for v in x]),
                                 ("y", [r["y"] for d in names for r in days[d]])):
            low, high = found.fences[name]
            step = (high - low) / (1 + 2 * fv.IQR_FACTOR)
            assert within(all_values, 0.25, low + fv.IQR_FACTOR * step)
            assert within(all_values, 0.75, high - fv.IQR_FACTOR * step)

    first, second = days
    put(bronze, f"date={first}", days[first])
    put(bronze, f"date={second}", [{"k": 1, "x": 9.0}])
    check(clean(first), [first])
    before = files(silver, f"date={first}")
    clean(second)
    put(bronze, f"date={first}", ["no longer", "what it was"])
    put(bronze, f"date={second}", days[second])
    found = clean(second)
    check(found, [first, second])
    assert files(silver, f"date={first}") == before
    out = read_layer(spark, silver)
    assert {str(r["date"]): r["count"] for r in out.groupBy("date").count().collect()} == {first: 3000, second: 3000}
    low, high = found.fences["x"]
    new = out.filter(F.col("date") == second).agg(
        F.count("x"), F.min("x"), F.max("x"), F.count_if(F.col("x") == F.lit(found.medians["x"]).cast("float"))).first()
    assert new[0] == 3000 and new[1] >= np.float32(low) and new[2] <= np.float32(high)
    assert new[3] >= sum("x" not in r for r in days[second])
    clean("2026-03-09")  # a day without rows
    assert read_layer(spark, silver).count() == 6000


@pytest.mark.parametrize("gaps", [0, 1, 7, 40, 200])
def test_quartiles_of_a_filled_column_follow_from_its_values(gaps):
    values = np.sort(np.random.default_rng(gaps).normal(size=101))
    middle = values[50]
    filled = np.sort(np.concatenate([values, [middle] * gaps]))
    for p in (0.1, 0.25, 0.5, 0.75, 0.9):
        place = place_among_values(p, 101 + gaps, 101)
        got = values[max(0, int(np.ceil(place * 101)) - 1)]
        want = filled[max(0, int(np.ceil(p * len(filled))) - 1)]
        near = np.searchsorted(values, got) - np.searchsorted(values, want)
        assert abs(near) <= 1, (p, got, want)


def test_kept_sketches_merge_into_those_of_the_whole(spark):
    rows = spark.range(20_000).select((F.col("id") % 7).alias("day"), (F.col("id") * 37 % 20_000).alias("x"),
                                      F.lit(None).cast("double").alias("empty"),
                                      F.when(F.col("id") % 2 == 0, F.col("id")).alias("odd.name"))
    kept = kept_sketches(rows, ["x", "empty", "odd.name"], by=["day"])
    assert kept.columns == ["day", "column", "rows", "n", "sketch"] and kept.count() == 21
    found = from_sketches(kept, [0.25, 0.9])
    assert found["empty"] == (20_000, 0, {}) and found["odd.name"][:2] == (20_000, 10_000)
    assert all(abs(found["x"][2][p] / 20_000 - p) <= 0.01 for p in (0.25, 0.9))
    assert abs(found["x"][2][0.25] - quantiles(rows, ["x"], [0.25])["x"][0]) <= 400


def test_only_the_partitions_of_the_rows_are_replaced(spark):
    path = scratch_path(spark, "parts")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    replace_partitions(frame, path, ["p"])
    replace_partitions(spark.createDataFrame([(3, "b"), (4, "c")], "v int, p string"), path, ["p"])
    failing = spark.createDataFrame([(5, "a")], "v int, p string").withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        replace_partitions(failing, path, ["p"])
    assert sorted(map(tuple, read_layer(spark, path).collect())) == [(1, "a"), (3, "b"), (4, "c")]


SPILL_EARLY = """
import sys
from energylake.queries import cleaning
from energylake.session import build_session
data, log, shared = sys.argv[1:]
spark = build_session("spills", {
    "spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": shared,
    "spark.shuffle.spill.numElementsForceSpillThreshold": "200",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log, "spark.eventLog.compress": "false"})
assert cleaning.quantiles_by_day(spark, data).count() == 5
assert cleaning.silver_by_day(spark, data).count() == 4000
spark.stop()
"""


def test_days_are_written_without_a_spill(spark, tmp_path):
    """A sort of over 200 rows would spill here, as one of millions does."""
    i = F.col("id")
    spark.range(4000).select(
        i.alias("l_orderkey"), *[(i % n + 1).alias(c) for c, n in (("l_partkey", 90), ("l_suppkey", 40))],
        (i % 7 + 1).cast("int").alias("l_linenumber"), (i % 49 + 1).cast("double").alias("l_quantity"),
        (i * 37 % 4000 + 0.25).cast("double").alias("l_extendedprice"), (i % 11 / 100).alias("l_discount"), (i % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (i % 3 + 1).cast("int")).alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.when(i % 100 > 0, F.timestamp_seconds(757_382_400 + i * 37 % 4000 * 43_200)).alias("l_shipdate"),
    ).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", SPILL_EARLY, *[str(tmp_path / n) for n in ("", "log", "shared")]], check=True,
                   cwd=pathlib.Path(jobs.__file__).parents[2], timeout=240)
    events = [json.loads(x) for f in (tmp_path / "log").rglob("events_*") for x in f.read_text().splitlines()]
    metrics = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert sum(m["Output Metrics"]["Records Written"] for m in metrics) > 20_000
    assert sum(m["Memory Bytes Spilled"] + m["Disk Bytes Spilled"] for m in metrics) == 0
