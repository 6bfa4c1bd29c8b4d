"""Ingest through the file source, with the columns a topic delivers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from energylake.operators.scoring import RidgeModel, Term, score
from energylake.session import scratch_path
from energylake.sources.layers import read_bronze
from energylake.streaming.ingest import (
    bronze_totals, ingest_to_bronze, read_stream, route, run_totals, topic_options, with_ingest_date)

SCHEMA = "topic string, value binary, timestamp timestamp"
DAY = dt.datetime(2026, 3, 5, 23, 59, 30)


def send(spark, path, messages):
    spark.createDataFrame(
        [(t, bytearray(v.encode()), DAY + dt.timedelta(minutes=i)) for i, (t, v) in enumerate(messages)],
        SCHEMA).write.mode("append").parquet(path)


def stream(spark, path, per_trigger=1):
    return read_stream(spark, {"maxFilesPerTrigger": str(per_trigger)}, "parquet",
                       spark.createDataFrame([], SCHEMA).schema, path)


def test_ingest_routes_and_resumes(spark):
    topic, bronze, checkpoint = (scratch_path(spark, n) for n in ("topic", "bronze", "checkpoint"))
    send(spark, topic, [("open-data-existant", '{"n":1,"t":"é"}'), ("open-data-neuf", '{\n"n": 2}'),
                        ("other", '{"n":3}')])

    def run():
        ingest_to_bronze(stream(spark, topic), bronze, checkpoint).awaitTermination(120)
        return sorted(tuple(r) for r in read_bronze(
            spark, bronze, spark.createDataFrame([], "n int, t string").schema).select(
                "n", "t", "dataset", F.col("date").cast("string")).collect())

    first = [(1, "é", "existant", "2026-03-05"), (2, None, "neuf", "2026-03-06"),
             (3, None, "inconnu", "2026-03-06")]
    assert run() == first
    assert run() == first
    send(spark, topic, [("open-data-existant", '{"n":4}')])
    assert run() == [*first, (4, None, "existant", "2026-03-05")]
    assert {r["dataset"]: r["messages"] for r in bronze_totals(spark, bronze).collect()} == {
        "existant": 2, "neuf": 1, "inconnu": 1}


def test_totals_are_those_of_the_run(spark):
    topic, bronze, checkpoint = (scratch_path(spark, n) for n in ("topic", "bronze", "checkpoint"))

    def run():
        return run_totals(ingest_to_bronze(stream(spark, topic), bronze, checkpoint))

    for n in range(3):
        send(spark, topic, [("open-data-existant", f'{{"n":{n}}}'), ("other", "{}")])
    assert run() == {"existant": 3, "inconnu": 3}
    assert run() == {}
    send(spark, topic, [("open-data-neuf", "{}"), ("open-data-neuf", "{}")])
    assert run() == {"neuf": 2}


def test_the_text_of_a_message_is_kept(spark):
    text = json.dumps({"b": 1.0, "a": None, "nested": {"x": [1, 2]}}, ensure_ascii=False)
    df = spark.createDataFrame([("open-data-neuf", bytearray(text.encode()), DAY)], SCHEMA)
    assert [tuple(r) for r in route(df).collect()] == [(text, "neuf", DAY.date())]


def test_arrival_parts(spark):
    df = spark.createDataFrame([(DAY,)], "ts timestamp")
    row = with_ingest_date(df, "ts").first()
    assert (str(row["date"]), row["heure"]) == ("2026-03-05", "235930")
    assert with_ingest_date(df).first()["date"] is not None


def test_topic_options():
    assert topic_options("b:9092", max_per_trigger=200) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "open-data-existant,open-data-neuf",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "200"}
    assert topic_options("b:9092", {"a": "x"}, min_partitions=64) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "a", "startingOffsets": "earliest",
        "minPartitions": "64"}


def test_scoring_works_on_a_stream(spark):
    topic, out, checkpoint = (scratch_path(spark, n) for n in ("topic", "out", "checkpoint"))
    send(spark, topic, [("t", '{"x":2.0}'), ("t", '{"x":-9.0}')])
    model = RidgeModel((Term("x", "x", None, 0.0, 2.0, 10.0),), 5.0)
    homes = stream(spark, topic).select(
        F.from_json(F.col("value").cast("string"), "x double").alias("r")).select("r.x")
    (score(homes, model).writeStream.format("parquet").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(out).awaitTermination(120))
    assert sorted(r[0] for r in spark.read.parquet(out).select("conso_predite_m2").collect()) == [0.0, 15.0]


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from energylake import session

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://m:7077"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Cluster, "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
