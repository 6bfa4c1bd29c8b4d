"""Topics to bronze, exactly once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from energylake.fixed_values import TOPIC_FOLDER, UNKNOWN_FOLDER
from energylake.functions.columns import col, ingest_parts, lookup
from energylake.operators.metrics import topic_totals


OBSERVED = "messages per folder"


def topic_options(brokers: str, topics: Mapping[str, str] = TOPIC_FOLDER,
                  max_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options that subscribe to all topics from the earliest message on.

    A topic often has few partitions; ``min_partitions`` lets more tasks share them.
    """
    options = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics),
               "startingOffsets": "earliest"}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka",
                schema: T.StructType | None = None, path: str | None = None) -> DataFrame:
    """Stream of messages; with another format, of files that hold the same columns."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def with_ingest_date(df: DataFrame, ts_col: str | None = None) -> DataFrame:
    """Adds the arrival date and time of day; the clock counts where no column is named."""
    return df.withColumns(ingest_parts(col(ts_col) if ts_col else F.current_timestamp()))


def route(messages: DataFrame, folders: Mapping[str, str] = TOPIC_FOLDER,
          ts_col: str | None = "timestamp") -> DataFrame:
    """Message text with the folder of its topic and its arrival date.

    The text is kept as it came, so a new field needs no change here; line breaks
    between JSON tokens would break the line format and become blanks.
    """
    return with_ingest_date(messages, ts_col).select(
        F.regexp_replace(col("value").cast("string"), r"[\r\n]+", " ").alias("value"),
        lookup(col("topic"), folders, UNKNOWN_FOLDER).alias("dataset"), "date")


def ingest_to_bronze(messages: DataFrame, path: str, checkpoint: str,
                     folders: Mapping[str, str] = TOPIC_FOLDER,
                     ts_col: str | None = "timestamp") -> StreamingQuery:
    """Write all waiting messages as JSON lines under ``dataset=…/date=…`` and stop.

    The sink's log and the checkpoint commit together: a restart neither loses nor
    repeats a message.  Messages per folder are observed on the way, for ``run_totals``.
    """
    names = sorted({*folders.values(), UNKNOWN_FOLDER})
    routed = route(messages, folders, ts_col).observe(
        OBSERVED, *[F.count_if(F.col("dataset") == n).alias(n) for n in names])
    return (routed.writeStream.format("text")
            .partitionBy("dataset", "date").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(path))


def run_totals(query: StreamingQuery) -> dict[str, int]:
    """Waits for the end of an ingest and gives the messages of this run per folder.

    Progress is gathered while the run goes on, as Spark keeps only the last reports; a
    batch whose report was missed raises, as the totals would be too low.
    """
    seen = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        seen.update((p.batchId, p.observedMetrics[OBSERVED].asDict())
                    for p in query.recentProgress if OBSERVED in p.observedMetrics)
    if seen and len(seen) <= max(seen) - min(seen):
        raise RuntimeError("reports of some batches were missed; count the bronze layer instead")
    names = next(iter(seen.values()), {})
    return {n: total for n in names if (total := sum(s[n] for s in seen.values()))}


def bronze_totals(spark: SparkSession, path: str) -> DataFrame:
    """Messages per dataset folder, without parsing them."""
    return topic_totals(spark.read.text(path), "dataset")
