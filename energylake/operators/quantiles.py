"""Quantiles of many columns in few passes.

``err > 0`` is one mergeable-sketch job over all columns.  A sketch without error
would keep every value, so exact quantiles (``err = 0``) are found by narrowing: a
sketch gives a value on either side of every wanted rank, and one aggregation counts
the rows between these edges.  While too many rows are left between two edges the
next round looks only there.  A round leaves about one row in 250, so two passes do
up to some million rows and four a thousand times that.  The driver sees a few counts
per round and at the end at most ``FINAL_ROWS`` distinct values per rank.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.functions.columns import col, number

FINAL_ROWS = 10_000
SKETCH_ERROR = 0.001
SALTS = 200
# A sketch with k places is off by about 3 / k, 99 times in 100; k ends at 65,535.
KEPT, MOST_KEPT = 8, 65_535


def numeric_columns(df: DataFrame, names) -> list[str]:
    """The names that are present and hold numbers."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [n for n in names if isinstance(kinds.get(n), T.NumericType)]


def quantiles(df: DataFrame, cols, probs, err: float = 0.01) -> dict[str, list[float]]:
    """Quantiles per column, nulls and NaN left out; an empty list for a column without values."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    if err > 0:
        look = _look(df, [number(col(c)) for c in cols], probs, err)
        return {c: [marks[p] for p in probs] if n else [] for c, (_, n, marks) in zip(cols, look)}
    look = _look(df, [number(col(c)) for c in cols], {p for q in probs for p in _around(q)})
    sizes = {c: n for c, (_, n, _) in zip(cols, look) if n}
    ranks = {c: [max(1, math.ceil(p * n)) for p in probs] for c, n in sizes.items()}
    spans = {(c, r): tuple(marks[p] for p in _around(q))
             for c, (_, n, marks) in zip(cols, look) if n for r, q in zip(ranks[c], probs)}
    return {**{c: [] for c in cols}, **values_at_ranks(df, ranks, sizes, spans)}


def _look(df: DataFrame, columns: list[Column], probs,
          err: float = SKETCH_ERROR) -> list[tuple[int, int, dict]]:
    """Rows, values and sketched quantiles of every column, in one pass.

    The columns are stacked, and every input split makes one sketch per column.  These
    merge in two levels, first per column and salt and then per column, so that no task
    merges more than a share of them however many splits there are.
    """
    probs, names = sorted(probs), [str(i) for i in range(len(columns))]
    stacked = (df.select([c.alias(n) for c, n in zip(columns, names)])
               .withColumn("salt", F.spark_partition_id() % SALTS)
               .unpivot(["salt"], names, "column", "value"))
    size = F.lit(min(MOST_KEPT, math.ceil(KEPT / err)))
    parts = stacked.groupBy("column", "salt").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"),
        F.kll_sketch_agg_double("value", size).alias("sketch"))
    merged = parts.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), size).alias("sketch"))
    marks = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(
        "sketch", F.array(*map(F.lit, probs))))
    found = {int(r[0]): r[1:] for r in merged.select("column", "rows", "n", marks).collect()}
    return [(rows, n, dict(zip(probs, marks or ())))
            for rows, n, marks in (found.get(i, (0, 0, ())) for i in range(len(names)))]


def kept_sketches(df: DataFrame, cols, err: float = 0.01, by=()) -> DataFrame:
    """(*by, column, rows, n, sketch): a sketch to keep of each column, per value of ``by``.

    ``rows`` counts all rows and ``n`` those with a value.  Sketches of parts of a table merge
    into one of the whole, so each part is read once, however often the whole is asked about.
    As in ``quantiles``, every input split makes a sketch and these merge in two levels.
    """
    by, cols, size = list(by), list(cols), F.lit(min(MOST_KEPT, math.ceil(KEPT / err)))
    numbers = [str(i) for i in range(len(cols))]
    stacked = (df.select(*[col(c) for c in by], *[number(col(c)).alias(n) for c, n in zip(cols, numbers)])
               .withColumn("salt", F.spark_partition_id() % SALTS)
               .unpivot([*by, "salt"], numbers, "column", "value"))
    parts = stacked.groupBy(*by, "column", "salt").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"),
        F.kll_sketch_agg_double("value", size).alias("sketch"))
    return parts.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), _merged(size).alias("sketch")).withColumn(
        "column", F.element_at(F.array(*map(F.lit, cols)), F.col("column").cast("int") + 1))


def _merged(size: Column) -> Column:
    return F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), size)


def from_sketches(kept: DataFrame, probs, err: float = 0.01) -> dict[str, tuple[int, int, dict]]:
    """Rows, values and quantiles by probability of each column, from ``kept_sketches`` of all parts."""
    probs, size = sorted(set(probs)), F.lit(min(MOST_KEPT, math.ceil(KEPT / err)))
    merged = kept.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), _merged(size).alias("sketch"))
    marks = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, probs))))
    return {r[0]: (r[1], r[2], dict(zip(probs, r[3] or ())))
            for r in merged.select("column", "rows", "n", marks).collect()}


def place_among_values(p: float, rows: int, n: int) -> float:
    """Where the quantile ``p`` of a column whose gaps hold its median lies among its ``n`` values alone.

    The copies of the median lie in the middle, so quantiles outside them move outwards.
    """
    at = p * rows
    return at / n if at <= n / 2 else 0.5 if at <= n / 2 + rows - n else (at - (rows - n)) / n


def _around(p: float) -> tuple[float, float]:
    return max(0.0, p - SKETCH_ERROR), min(1.0, p + SKETCH_ERROR)


def medians(df: DataFrame, cols, gaps_only: bool = False) -> dict[str, float | None]:
    """Exact medians; the mean of the two middle values when the count is even.

    With ``gaps_only`` columns that have a value in every row are left out.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    look = _look(df, [number(col(c)) for c in cols], _around(0.5))
    sizes = {c: n for c, (rows, n, _) in zip(cols, look) if n and not (gaps_only and n == rows)}
    ranks = {c: sorted({(n + 1) // 2, n // 2 + 1}) for c, n in sizes.items()}
    spans = {(c, r): tuple(marks[p] for p in _around(0.5))
             for c, (_, _, marks) in zip(cols, look) if c in ranks for r in ranks[c]}
    found = values_at_ranks(df, ranks, sizes, spans)
    return {c: sum(found[c]) / len(found[c]) if c in found else None for c in cols
            if c in found or not gaps_only}


@dataclass
class _Search:
    """One wanted rank; ``inside`` rows lie strictly between low and high."""

    name: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def candidates(self) -> Column:
        x = number(col(self.name))
        keep = F.lit(True)
        if self.low is not None:
            keep = keep & (x > self.low)
        if self.high is not None:
            keep = keep & (x < self.high)
        return F.when(keep, x)

    def settle(self, edges: list[float], counts: dict, values: dict) -> None:
        """Find the rank among the counted intervals: even codes lie between two
        edges, odd codes on an edge."""
        seen = 0
        for code in range(2 * len(edges) + 1):
            n = counts.get(code, 0)
            if seen + n >= self.rank:
                break
            seen += n
        if code % 2:
            self.value = edges[code // 2]
            return
        for value, n in sorted(values.get(code, ())):
            seen += n
            if seen >= self.rank:
                self.value = value
                return
        self._narrow(edges, code // 2, seen, seen + n)

    def _narrow(self, edges: list[float], place: int, seen: int, upto: int) -> None:
        """Take over the neighbouring edges where they are tighter than the known ends."""
        end = self.below + self.inside
        if place > 0 and (self.low is None or edges[place - 1] > self.low):
            self.low, self.below = edges[place - 1], seen
        if place < len(edges) and (self.high is None or edges[place] < self.high):
            self.high, end = edges[place], upto
        self.inside = end - self.below


def values_at_ranks(df: DataFrame, ranks: dict[str, list[int]], sizes: dict[str, int],
                    spans: dict | None = None) -> dict[str, list[float]]:
    """The values at 1-based ranks of the sorted columns, exactly.

    ``spans`` may hold a first guess (low, high) per (column, rank).
    """
    searches = [_Search(c, r, sizes[c]) for c, rs in ranks.items() for r in dict.fromkeys(rs)]
    guesses = [spans[s.name, s.rank] for s in searches] if spans else None
    while open_ones := [s for s in searches if s.value is None]:
        _round(df, open_ones, guesses or _brackets(df, open_ones))
        guesses = None
    found = {(s.name, s.rank): s.value for s in searches}
    return {c: [found[c, r] for r in rs] for c, rs in ranks.items()}


def _round(df: DataFrame, searches: list[_Search], spans: list[tuple]) -> None:
    """Count the rows between the edges on either side of every rank."""
    edges, kept = defaultdict(set), defaultdict(list)
    last = all(_expected(s) <= FINAL_ROWS for s in searches)
    for s, (a, b) in zip(searches, spans):
        edges[s.name] |= {v for v in (a, b) if v is not None}
        if last:
            kept[s.name].append((a, b))
    edges = {name: sorted(values) for name, values in edges.items()}
    counts, values = _count_between(df, edges, kept)
    for s in searches:
        s.settle(edges[s.name], counts[s.name], values[s.name])


def _expected(search: _Search) -> float:
    """Most rows that can lie within the search's next bracket."""
    return search.inside if search.inside <= FINAL_ROWS else 4 * SKETCH_ERROR * search.inside + 1


def _brackets(df: DataFrame, searches: list[_Search]) -> list[tuple]:
    """(a, b) around every rank by one sketch job; short candidate lists need no sketch."""
    wide = [s for s in searches if s.inside > FINAL_ROWS]
    if not wide:
        return [(s.low, s.high) for s in searches]
    ranges = list(dict.fromkeys((s.name, s.low, s.high) for s in wide))
    first = {(s.name, s.low, s.high): s for s in reversed(wide)}
    places = {id(s): _around((s.rank - s.below) / s.inside) for s in wide}
    look = _look(df, [first[r].candidates() for r in ranges],
                 {p for place in places.values() for p in place})
    marks = {r: found for r, (_, _, found) in zip(ranges, look)}
    return [tuple(marks[s.name, s.low, s.high][p] for p in places[id(s)])
            if id(s) in places else (s.low, s.high) for s in searches]


def _count_between(df: DataFrame, edges: dict[str, list[float]],
                   kept: dict[str, list[tuple]]) -> tuple[dict, dict]:
    """Rows per interval code, and per value within the brackets to keep."""
    parts = []
    for i, (name, marks) in enumerate(edges.items()):
        x = number(col(name))
        code = F.when(x.isNull(), None)
        for k, mark in enumerate(marks):
            code = code.when(x < mark, 2 * k).when(x == mark, 2 * k + 1)
        value = F.lit(None).cast("double")
        for a, b in dict.fromkeys(kept.get(name, ())):
            near = (F.lit(True) if a is None else x > a) & (F.lit(True) if b is None else x < b)
            value = F.coalesce(value, F.when(near, x))
        parts.append(F.struct(F.lit(i).alias("column"),
                              code.otherwise(2 * len(marks)).alias("code"), value.alias("value")))
    part = parts[0] if len(parts) == 1 else F.explode(F.array(*parts))
    rows = (df.select(part.alias("part")).select("part.*").where("code is not null")
            .groupBy("column", "code", "value").agg(F.count(F.lit(1)).alias("n")).collect())
    names = list(edges)
    counts, values = defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(list))
    for column, code, value, n in rows:
        counts[names[column]][code] += n
        if value is not None:
            values[names[column]][code].append((value, n))
    return counts, values
