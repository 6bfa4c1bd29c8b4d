"""Tables written and read back, and the streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake.functions.columns import decode_json, encode_json
from energylake.operators.metrics import class_distribution
from energylake.queries.registry import query, table
from energylake.session import scratch_path
from energylake.sources.layers import read_bronze, read_layer, write_layer
from energylake.sources.messages import publish, publish_stream
from energylake.streaming.ingest import (
    bronze_totals, ingest_to_bronze, read_stream, run_totals)

EVENT_TOPICS = {"click": "existant", "view": "neuf", "purchase": "achat"}
EVENT_FOLDER_SQL = """case event_type when 'click' then 'existant' when 'view' then 'neuf'
                           when 'purchase' then 'achat' else 'inconnu' end"""
EVENT_FIELDS = "event_id bigint, user_id bigint, event_type string, value double"


@query("""select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') as date
          from events""")
def bronze_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze")
    (table(spark, sf, "events").withColumn("date", F.to_date("ts")).drop("ts", "props")
     .write.partitionBy("date").json(path))
    bronze = read_bronze(spark, path, spark.createDataFrame([], EVENT_FIELDS).schema)
    return bronze.withColumn("date", F.col("date").cast("string"))


@query("select event_id, user_id, event_type, value, epoch_us(ts) as ts from events")
def silver_roundtrip(spark, sf):
    path = scratch_path(spark, "silver")
    write_layer(table(spark, sf, "events"), path, ["event_type"])
    back = read_layer(spark, path, ["event_id", "user_id", "event_type", "value", "ts"])
    return back.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


@query("""select event_id, event_type, value, json_extract(props, '$.k')::bigint as k from events""")
def publish_messages(spark, sf):
    """Rows sent as messages, and the messages read."""
    path = scratch_path(spark, "topic")
    publish(table(spark, sf, "events").select("event_id", "event_type", "value", "props"),
            "open-data-existant", {"path": path}, fmt="text")
    sent = spark.read.text(path).select(decode_json(
        F.col("value"), "event_id bigint, event_type string, value double, props string").alias("m"))
    return sent.select("m.event_id", "m.event_type", "m.value",
                       decode_json(F.col("m.props"), "k bigint").getField("k").alias("k"))


@query("select o_orderpriority as value, count(*) as n from orders group by 1")
def paged_resume(spark, sf):
    """A stream of messages that ends half-way and is taken up from its checkpoint."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("value"))
    source, path, checkpoint = (scratch_path(spark, n) for n in ("pages", "pulled", "pulled-checkpoint"))
    for half in (0, 1):
        orders.filter(F.pmod("o_orderkey", F.lit(2)) == half).select("value").write.mode("append").text(source)
        publish_stream(read_stream(spark, {}, "text", path=source), "open-data-existant", {"path": path},
                       checkpoint, fmt="text").awaitTermination()
    return class_distribution(spark.read.text(path), "value", out="n")


def _ingest(spark, sf, label):
    """All events sent through the streaming ingest: the running query and the bronze path."""
    events = read_stream(spark, {"pathGlobFilter": "events.parquet"}, "parquet",
                         table(spark, sf, "events").schema, sf)
    messages = events.select(
        F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"),
        encode_json("event_id", "user_id", "event_type", "value").cast("binary").alias("value"))
    path = scratch_path(spark, label)
    return ingest_to_bronze(messages, path, scratch_path(spark, f"{label}-checkpoint"),
                            EVENT_TOPICS), path


def _ingested(spark, sf, label):
    running, path = _ingest(spark, sf, label)
    running.awaitTermination()
    return path


@query(f"""select event_id, user_id, event_type, value, {EVENT_FOLDER_SQL} as dataset,
                  strftime(ts, '%Y-%m-%d') as date from events""")
def stream_ingest(spark, sf):
    bronze = read_bronze(spark, _ingested(spark, sf, "ingest"),
                         spark.createDataFrame([], EVENT_FIELDS).schema)
    return bronze.withColumn("date", F.col("date").cast("string"))


@query(f"select {EVENT_FOLDER_SQL} as dataset, count(*) as messages from events group by 1")
def topic_totals(spark, sf):
    return bronze_totals(spark, _ingested(spark, sf, "totals"))


@query(f"select {EVENT_FOLDER_SQL} as dataset, count(*) as messages from events group by 1")
def ingest_run_totals(spark, sf):
    """What one run of the ingest counted on its way."""
    totals = run_totals(_ingest(spark, sf, "run")[0])
    return spark.createDataFrame(list(totals.items()), "dataset string, messages long")
