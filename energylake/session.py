"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE picks join sides, splits skewed partitions and merges small ones at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "energylake", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with our defaults; ``conf`` wins.

    Object-store access is plain configuration of the caller, for example
    ``spark.hadoop.fs.s3a.endpoint`` and ``spark.hadoop.fs.s3a.path.style.access``;
    credentials come from the cluster's provider and are never in code.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a local session may go on, in a temporary folder:
    on a cluster the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="energylake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
