"""Helpers shared by the operators: column picking, Arrow slices, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from energylake.session import scratch_path

SLICE_BYTES = 1 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under the names given as keywords.

    An exact name wins, then one that differs in case; of columns with the same name
    the first counts.  Whatever else the frame holds cannot clash any more.
    """
    found = {out: positional(df, name) for out, name in wanted.items()}
    return next(iter(found.values()))[0].select([F.col(c).alias(out) for out, (_, c) in found.items()])


def positional(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame with columns c0, c1, ... and which of them ``name`` was, chosen as in ``pick``."""
    at = [i for same in (str, str.lower) for i, c in enumerate(df.columns) if same(c) == same(name)]
    if not at:
        raise KeyError(f"no column {name} in {df.columns}")
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), f"c{at[0]}"


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each; a longer row is a part of its own."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(length, dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows, where the session still has Spark's default.

    Ten thousand long documents at once would not fit beside the other tasks of an executor.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def map_texts(df: DataFrame, text: str, added: Sequence[T.StructField],
              make: Callable[[], Callable[[list[str | None]], Sequence]],
              keep_text: bool = False, also: int | None = None) -> DataFrame:
    """The frame with columns computed from its text column, slice by slice in Arrow batches.

    ``make`` is called once a task; its result gets the texts of a slice and returns one
    list or array for each added column; with ``also`` it gets the values of that column, too.
    The text itself is dropped unless ``keep_text``.
    """
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    kept = [i for i in range(len(df.columns)) if keep_text or i != at]
    schema = T.StructType([*[df.schema.fields[i] for i in kept], *added])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, at):
                given = [part.column(i).to_pylist() for i in (at, also) if i is not None]
                made = work(*given)
                arrays = [part.column(i).cast(arrow.field(k).type) for k, i in enumerate(kept)]
                arrays += [m if isinstance(m, pa.Array) else pa.array(m, arrow.field(k).type)
                           for k, m in enumerate(made, len(kept))]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_remainder(c: Column, divisor: int = 3) -> Column:
    """crc32 of a key as text, modulo ``divisor``; null for a null key."""
    return F.crc32(c.cast("string").cast("binary")) % divisor


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of an array of span structs, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sha256_text(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
