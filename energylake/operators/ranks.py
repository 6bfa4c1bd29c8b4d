"""The rows at given ranks of a sort order, found without sorting the table.

A sample of the keys gives a border on either side of each wanted rank, and one aggregation
counts the rows below, on and between them; the next round looks only between.  A round
leaves about one row in 40, so 10^12 rows take six rounds of two scans over the key columns,
with no shuffle of rows.  The driver sees ``SAMPLE`` keys a rank and round, and at the end
``FINAL_KEYS`` at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.functions.columns import col

SAMPLE, FINAL_KEYS = 10_000, 10_000
SPREAD = 4  # deviations of a sampled rank on either side


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns, so that only equal rows tie."""
    def hashable(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if isinstance(field.dataType, T.MapType):
            return F.to_json(F.array_sort(F.map_entries(col(field.name))))
        return F.to_json(col(field.name)) if "map<" in kind or "variant" in kind else col(field.name)

    return F.xxhash64(*[hashable(f) for f in df.schema.fields])


def sort_key(df: DataFrame, *keys: Column) -> Column:
    """One column that sorts as the keys do, nulls first, then by the hash of the row.

    Timestamps become numbers, as their Python form is ambiguous when clocks change.
    """
    kinds = [f.dataType for f in df.select(*keys).schema.fields]
    plain = [F.unix_micros(k) if isinstance(t, T.TimestampType) else k for k, t in zip(keys, kinds)]
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate([*plain, row_hash(df)])])


def literal(value, kind: T.DataType) -> Column:
    """A collected value as a constant of its type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
    if isinstance(kind, T.ArrayType):
        return F.array(*[literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(kind)


@dataclass
class Border:
    """The key at a rank (from 1): ``below`` rows come before it and ``equal`` rows have it."""

    key: Column
    below: int
    equal: int


@dataclass
class _Search:
    """One wanted rank; ``inside`` rows lie strictly between the keys low and high."""

    rank: int
    inside: int
    below: int = 0
    low: Column | None = None
    high: Column | None = None
    found: Border | None = None

    def holds(self, key: Column) -> Column:
        keep = F.lit(True)
        if self.low is not None:
            keep = keep & (key > self.low)
        return keep if self.high is None else keep & (key < self.high)

    def settle(self, edges: list, counts: list[int], kind: T.DataType) -> None:
        """Take over the edges; counts are those below, on, between, on, ... and above them."""
        seen = self.below
        for i, n in enumerate(counts):
            if self.rank <= seen + n:
                break
            seen += n
        if i % 2:
            self.found = Border(literal(edges[i // 2], kind), seen, n)
            return
        self.low = literal(edges[i // 2 - 1], kind) if i else self.low
        self.high = literal(edges[i // 2], kind) if i // 2 < len(edges) else self.high
        self.below, self.inside = seen, n


KEY = "key"


def borders(df: DataFrame, key: Column, ranks: Sequence[int], total: int) -> dict[int, Border]:
    """The key at each rank from 1 to ``total``, the number of rows."""
    keys = df.select(key.alias(KEY))
    kind, key = keys.schema[KEY].dataType, F.col(KEY)
    searches = [_Search(r, total) for r in dict.fromkeys(ranks)]
    while wide := [s for s in searches if s.found is None and s.inside > FINAL_KEYS]:
        edges = [_edges(keys, s) for s in wide]
        counts = []
        for s, marks in zip(wide, edges):
            code = F.lit(0)
            for m in (literal(v, kind) for v in marks):
                code = code + (key >= m).cast("int") + (key > m).cast("int")
            counts += [F.count_if(s.holds(key) & (code == i)) for i in range(2 * len(marks) + 1)]
        found = list(keys.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first())
        for s, marks in zip(wide, edges):
            size = 2 * len(marks) + 1
            s.settle(marks, found[:size], kind)
            found = found[size:]
    for s in searches:
        if s.found is None:
            rows = keys.filter(s.holds(key)).groupBy(KEY).count().orderBy(KEY).collect()
            s.settle([r[0] for r in rows], [n for r in rows for n in (0, r[1])] + [0], kind)
    return {s.rank: s.found for s in searches}


def _edges(keys: DataFrame, s: _Search) -> list:
    """One or two sampled keys around the wanted rank."""
    inside = keys.filter(s.holds(F.col(KEY)))
    share = min(1.0, SAMPLE / s.inside)
    drawn = [r[0] for r in inside.sample(share, seed=s.rank).orderBy(KEY).collect()]
    if not drawn:
        drawn = [inside.first()[0]]
    at = (s.rank - s.below) / s.inside * len(drawn)
    room = SPREAD * (at * max(1 - at / len(drawn), 0)) ** 0.5 + 1
    low, high = (min(max(round(x), 0), len(drawn) - 1) for x in (at - room, at + room))
    return [drawn[i] for i in sorted({low, high}) if i == low or drawn[i] != drawn[low]]


def between(df: DataFrame, key: Column, start: int, stop: int, total: int) -> DataFrame:
    """The rows of the ranks after ``start`` up to ``stop``, in no order.

    Rows that share the key at an end are equal, so the number wanted is made of one of them.
    """
    ends = borders(df, key, [start + 1, stop], total)
    first, last = ends[start + 1], ends[stop]

    def copies(border: Border, n: int) -> DataFrame:
        return df.filter(key == border.key).limit(1).withColumn(
            COPY, F.explode(F.sequence(F.lit(1), F.lit(n)))).drop(COPY)

    if first.below == last.below:
        return copies(first, stop - start)
    head, tail = first.below + first.equal - start, stop - last.below
    inner = df.filter((key >= first.key if head == first.equal else key > first.key)
                      & (key <= last.key if tail == last.equal else key < last.key))
    for border, n in ((first, head), (last, tail)):
        if n < border.equal:
            inner = inner.unionByName(copies(border, n))
    return inner


COPY = "_copy"


def groups(df: DataFrame, key: Column, sizes: Sequence[int], total: int, out: str) -> DataFrame:
    """Adds a number to every row: 0 for the first ``sizes[0]`` rows in order of the key, and so on.

    Sizes are exact, and what they leave is the last group.  Of equal rows on a border the
    right number of copies goes to either side.
    """
    ranks, seen = [], 0
    for size in sizes:
        seen += size
        ranks.append(min(seen, total))
    cut = borders(df, key, [r for r in ranks if 0 < r < total], total)
    number, torn = F.lit(0), {}
    for r in ranks:
        if r == 0:
            number = number + 1
        elif r < total:
            border = cut[r]
            number = number + (key > border.key).cast("int")
            if border.below + border.equal > r:
                torn[border.below] = border
    plain = df
    for border in torn.values():
        plain = plain.filter(key != border.key)
    result = plain.withColumn(out, number)
    for border in torn.values():
        place = F.col(COPY) + border.below
        own = sum(((place > r).cast("int") for r in ranks), F.lit(0))
        result = result.unionByName(
            df.filter(key == border.key).limit(1)
            .withColumn(COPY, F.explode(F.sequence(F.lit(1), F.lit(border.equal))))
            .withColumn(out, own).drop(COPY))
    return result
