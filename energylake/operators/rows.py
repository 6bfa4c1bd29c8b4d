"""Row selection: filters, slices, splits, unions and joins with a small side."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energylake.functions.columns import col
from energylake.operators.ranks import between, groups, sort_key

TOP_ROWS = 100_000
SMALL_ROWS = 10_000
BUCKETS = 10_000


def filter_rows(df: DataFrame, isin: Mapping[str, Sequence] | None = None,
                between: Mapping[str, tuple] | None = None) -> DataFrame:
    """Rows whose columns are in the given lists and closed ranges."""
    for c, values in (isin or {}).items():
        df = df.filter(col(c).isin(list(values)))
    for c, (low, high) in (between or {}).items():
        df = df.filter(col(c).between(low, high))
    return df


def filter_open(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    """Rows strictly between low and high."""
    return df.filter((col(c) > low) & (col(c) < high))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def union_layers(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a column one side lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_domain(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """Sorted distinct values of two columns together, read in one scan."""
    return df.select(F.explode(F.array(col(first), col(second))).alias(out)).distinct().orderBy(out)


def count_rows(df: DataFrame, out: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def ordered(df: DataFrame, *keys: Column, partitions: int | None = None) -> DataFrame:
    """Globally sorted rows; a large table wants more partitions than the session's default."""
    if partitions is None:
        return df.orderBy(*keys)
    return df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)


def slice_rows(df: DataFrame, order_by: str, limit: int | None = None, offset: int = 0,
               partitions: int | None = None) -> DataFrame:
    """``limit`` rows after the first ``offset`` rows in the order of a column.

    The column has any type that can be sorted; nulls come first and equal keys go by a
    hash of the row.  A slice near the start is a bounded top-k.  For any other, the keys at both
    ends are searched for by rank, and only the rows between them are sorted.  Nothing is
    written, no partition is ever gathered, and both ways give the same rows.
    """
    key = sort_key(df, col(order_by))
    if limit is None and offset == 0:
        return ordered(df, key, partitions=partitions)
    if limit is not None and offset + limit <= TOP_ROWS:
        return df.orderBy(key).offset(offset).limit(limit)
    total = df.count()
    stop = total if limit is None else min(total, offset + limit)
    if offset >= stop:
        return df.limit(0)
    return ordered(between(df, key, offset, stop, total), key, partitions=partitions)


def hash_bucket(cols: Sequence[str], seed: int, n: int) -> Column:
    """Number 0..n-1 that depends only on the key, not on partitions or row order."""
    return F.pmod(F.xxhash64(*[col(c) for c in cols], F.lit(seed)), F.lit(n))


def portable_bucket(cols: Sequence[str], seed: int, n: int) -> Column:
    """Like ``hash_bucket``, by MD5: slower, but other engines can compute it too."""
    text = F.concat_ws("|", F.lit(seed).cast("string"), *[col(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(n))


Bucket = Callable[[Sequence[str], int, int], Column]


def split_by_key(df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42,
                 bucket: Bucket = hash_bucket, out: str = "split") -> DataFrame:
    """Adds ``train`` or ``test`` by a seeded hash of the key columns."""
    held_out = bucket(key, seed, BUCKETS) < F.lit(round(test * BUCKETS))
    return df.withColumn(out, F.when(held_out, "test").otherwise("train"))


def fold_by_key(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42,
                bucket: Bucket = hash_bucket, out: str = "fold") -> DataFrame:
    """Adds a fold number 0..folds-1; the seed is moved so that folds ignore the split."""
    return df.withColumn(out, bucket(key, seed + 1, folds).cast("int"))


def seeded_order(df: DataFrame, key: Sequence[str], seed: int) -> Column:
    """Sort key of a seeded random order; rows with equal key columns stand together."""
    return sort_key(df, F.xxhash64(*[col(c) for c in key], F.lit(seed)))


def split_exactly(df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42,
                  out: str = "split") -> DataFrame:
    """Adds ``train`` or ``test``; ceil(test * rows) rows are ``test``, however they are partitioned.

    The seeded hash of the key columns is the rank, and the key at the exact border is found
    without a sort.  Rows with one key fall on the same side unless the border lies among them.
    """
    total = df.count()
    held_out = math.ceil(round(test * total, 9))
    parted = groups(df, seeded_order(df, key, seed), [held_out], total, out)
    return parted.withColumn(out, F.when(F.col(out) == 0, "test").otherwise("train"))


def fold_exactly(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """Adds a fold number 0..folds-1; sizes differ by one at most, larger folds first."""
    total = df.count()
    sizes = [total // folds + (i < total % folds) for i in range(folds - 1)]
    return groups(df, seeded_order(df, key, seed + 1), sizes, total, out)


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int = 42,
                 partitions: int | None = None) -> DataFrame:
    """Rows in a seeded random order that is the same on every run."""
    columns = [col(c) for c in key]
    return ordered(df, F.xxhash64(*columns, F.lit(seed)), *columns, partitions=partitions)


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
               bound: int | None = None) -> DataFrame:
    """Join with a side that is expected to be small.

    It is broadcast when the caller states its largest possible number of rows, say as
    it has one row per class.  Otherwise nothing is run beforehand: the planner decides
    by bytes, measured by AQE, and splits skewed partitions of a shuffled join.
    """
    known = bound is not None and bound <= SMALL_ROWS
    return big.join(F.broadcast(small) if known else small, on, how)
