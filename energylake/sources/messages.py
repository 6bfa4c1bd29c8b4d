"""Rows as messages of a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from energylake.fixed_values import PUBLISH_OPTIONS
from energylake.functions.columns import col, encode_json


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON message per row, nulls written out, no key."""
    return df.select(encode_json(*[col(c) for c in df.columns]).alias("value"))


def publish(df: DataFrame, topic: str, options: Mapping[str, str], fmt: str = "kafka") -> None:
    """Send every row of a batch to a topic, from all executors at once."""
    publish_text(as_messages(df), topic, options, fmt)


def publish_text(df: DataFrame, topic: str, options: Mapping[str, str],
                 fmt: str = "kafka") -> None:
    """Send rows that are JSON text already, unchanged.

    Every replica confirms and failed sends are repeated; ``options`` names the
    brokers and may override.
    """
    (df.select("value").write.format(fmt).mode("append").option("topic", topic)
     .options(**{**PUBLISH_OPTIONS, **options}).save())


def publish_stream(df: DataFrame, topic: str, options: Mapping[str, str], checkpoint: str,
                   fmt: str = "kafka") -> StreamingQuery:
    """Send a stream of JSON text, such as a paged source; a restart goes on where it stopped."""
    return (df.select("value").writeStream.format(fmt).option("topic", topic)
            .options(**{**PUBLISH_OPTIONS, **options})
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
