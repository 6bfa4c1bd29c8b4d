"""Approximate nearest neighbours by an inverted multi-index, for the inner product."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from energylake.llm.common import pick, staged

SHARD_ROWS, LEAST_SHARDS, QUERY_ROWS = 4_096, 16, 4_096
PROBES_AT_ONCE, WALKS_PER_TASK = 512, 256


def usable(v: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(sound & F.exists(v, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, k: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    """Centroids by Lloyd's rounds from a seeded start; a centroid without points stays."""
    centre = points[np.sort(np.random.default_rng(seed).choice(len(points), k, replace=False))].copy()
    for _ in range(rounds):
        own = nearest(points, centre)
        size = np.bincount(own, minlength=k)
        for d in range(points.shape[1]):
            total = np.bincount(own, weights=points[:, d], minlength=k)
            centre[:, d] = np.where(size > 0, total / np.maximum(size, 1), centre[:, d])
    return centre


def nearest(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centre.T - 0.5 * (centre * centre).sum(axis=1), axis=1)


@dataclass
class Codebook:
    """Centroids of the two halves of a vector; a cell is a pair of centroids."""

    left: np.ndarray
    right: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        d = self.left.shape[1]
        return nearest(vectors[:, :d], self.left) * len(self.right) + nearest(vectors[:, d:], self.right)

    def walk(self, vector: np.ndarray, size: np.ndarray, wanted: int) -> np.ndarray:
        """Cells in order of the two centroids' summed nearness, until they hold ``wanted`` rows.

        The multi-sequence walk: both centroid lists are sorted, and a heap holds the pairs
        whose two predecessors have been taken.
        """
        d = self.left.shape[1]
        a, b = self.left @ vector[:d], self.right @ vector[d:]
        oa, ob = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b = a[oa].tolist(), b[ob].tolist()
        width, sizes = len(ob), size.tolist()
        heap, out, seen = [(-(a[0] + b[0]), 0, 0)], [], 0
        next_column = [0] * (len(oa) + 1)  # how far each row of the grid has been taken
        while heap and seen < wanted:
            _, i, j = heappop(heap)
            cell = oa[i] * width + ob[j]
            next_column[i] = j + 1
            if sizes[cell]:
                out.append(cell)
                seen += sizes[cell]
            if i + 1 < len(oa) and next_column[i + 1] == j:
                heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
            if j + 1 < width and (i == 0 or next_column[i - 1] > j + 1):
                heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        return np.array(out, np.int64)


@dataclass
class Layout:
    """Where the rows of each cell lie: cells in order, cut into shards of equal size.

    A cell may span many shards, so a crowded one is no larger a task than others.
    """

    size: np.ndarray
    shards: int

    def __post_init__(self):
        self.total = int(self.size.sum())
        self.first = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def shard_of(self, cell: np.ndarray, key: np.ndarray) -> np.ndarray:
        place = self.first[cell] + key % np.maximum(self.size[cell], 1)
        return place * self.shards // max(self.total, 1)

    def shards_of(self, cells: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The shards that hold rows of the cells, each with those cells."""
        low = self.first[cells] * self.shards // max(self.total, 1)
        high = (self.first[cells] + self.size[cells] - 1) * self.shards // max(self.total, 1)
        span = high - low + 1
        shard = np.repeat(low, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        cell = np.repeat(cells, span)
        order = np.argsort(shard, kind="stable")
        shard, cell = shard[order], cell[order]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        return [(int(s[0]), c) for s, c in zip(np.split(shard, cuts), np.split(cell, cuts)) if len(s)]


def fit(vectors: DataFrame, cells: int, sample_rows: int) -> Codebook:
    """Codebook from the ``sample_rows`` rows with the smallest hash, of which there is one at least."""
    rows = (vectors.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample_rows)
            .select("v").toArrow().column("v").to_pylist())
    points = np.array(rows, np.float64)
    half = max(points.shape[1] // 2, 1)
    return Codebook(*[kmeans(part, min(cells, len(part))) for part in (points[:, :half], points[:, half:])])


def cells_for(rows: int) -> int:
    """Centroids of each half: a power of two near an eighth of the root of the rows, 32 to 1,024.

    A cell then holds some 64 rows, whose products cost about as much as the step of the walk to it.
    """
    return int(min(1_024, max(32, 2 ** round(np.log2(max(rows, 1) ** 0.5 / 8)))))


def needed_visit(index: DataFrame, asked: DataFrame, book: Codebook, size: np.ndarray, k: int,
                 recall: float, trials: int) -> float:
    """The share of rows to visit at which ``trials`` of the queries find ``recall`` of their neighbours.

    Their true neighbours come from one pass over all rows; each neighbour tells how many rows
    its query's walk passes before its cell.
    """
    sample = (asked.orderBy(F.xxhash64("ask", F.lit(7)), "ask").limit(trials)
              .select("ask", "v").toArrow().to_pydict())
    if not sample["ask"]:
        return 1.0
    own, q = np.array(sample["ask"]), np.array(sample["v"], np.float64)

    def best(batches):
        near, cell = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            score = q @ np.vstack(batch.column(0).to_numpy(zero_copy_only=False)).T
            score[own[:, None] == batch.column(1).to_numpy()] = -np.inf
            near = np.hstack([near, score])
            cell = np.hstack([cell, np.broadcast_to(batch.column(2).to_numpy(), score.shape)])
            if near.shape[1] > k:
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                near, cell = np.take_along_axis(near, top, 1), np.take_along_axis(cell, top, 1)
        at, _ = np.nonzero(near > -np.inf)
        yield pa.RecordBatch.from_pydict({
            "q": pa.array(at), "near": pa.array(near[near > -np.inf]), "cell": pa.array(cell[near > -np.inf])})

    order = Window.partitionBy("q").orderBy(F.desc("near"), "cell")
    found = (index.select("v", "ask", "cell").mapInArrow(best, "q long, near double, cell long")
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
             .select("q", "cell").toPandas())  # at most trials x k rows
    d, needed = book.left.shape[1], []
    for at, cells in found.groupby("q")["cell"]:
        sums = ((book.left @ q[at, :d])[:, None] + book.right @ q[at, d:]).ravel()
        walked = np.argsort(-sums, kind="stable")
        before = np.empty(len(sums), np.int64)
        before[walked] = np.cumsum(size[walked]) - size[walked]
        needed.append((before[cells.to_numpy()] + 1) / max(size.sum(), 1))
    return float(np.quantile(np.concatenate(needed), recall, method="higher")) if needed else 1.0


def search(vectors: DataFrame, queries: Column, k: int = 20, cells: int | None = None,
           sample_rows: int = 20_000, visit: float | None = None, recall: float = 0.94, trials: int = 128,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` rows found nearest to each query row: query_id, rank, vec_id, score.

    ``queries`` is a condition on the column ``id``; all rows but the query's own are
    candidates.  Nearness is the inner product in double precision, ties go to the smaller
    id.  ``cells`` is the number of centroids of each half, fitted on ``sample_rows`` rows at
    most and by default chosen from the number of rows; every row is indexed.  A query walks the
    cells by summed nearness until they hold the share ``visit`` of all rows, and all rows of
    those cells are ranked by their true score.  Without ``visit``, it is the share at which
    ``trials`` of the queries find ``recall`` of their true neighbours.
    Rows without an id, with a null or zero vector or one with a null or non-finite
    component take no part.  Vectors of each length are a table of their own, with its own cells
    and one search for each length that has queries.
    Rows that repeat an id are candidates each for itself, also for each other, and as queries get
    ``k`` rows each.  An empty table gives no rows.
    """
    rows = pick(vectors, id=id_col, v=vec_col).select("id", F.col("v").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(
        F.bool_or(queries).alias("asked"), F.count(F.lit(1)).alias("rows")).filter("asked").collect()
    parts = [_search(rows.filter(F.size("v") == r["n"]), queries, k, cells or cells_for(r["rows"]),
                     sample_rows, visit, recall, trials) for r in sorted(lengths)]
    if parts:
        return reduce(DataFrame.unionAll, parts)
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")


def best_of_shard(entries: pd.DataFrame, probes: pd.DataFrame, k: int):
    """(probe number, entry number, score) of the ``k`` best visited entries of each probe.

    ``entries`` are in order of cell, so the rows of a cell meet all probes that visit it in one product.
    """
    e, ask = np.vstack(entries["v"]), entries["ask"].to_numpy()
    ids = entries["id"].to_numpy()
    here, first = np.unique(entries["cell"].to_numpy(), return_index=True)
    ends = np.append(first[1:], len(e))
    for low in range(0, len(probes), PROBES_AT_ONCE):
        part = probes.iloc[low:low + PROBES_AT_ONCE]
        q = np.vstack(part["v"])
        visits = np.zeros((len(q), len(here)), bool)
        for row, wanted in zip(visits, part["cells"]):
            row[np.searchsorted(here, wanted)] = True
        near = np.full((len(q), len(e)), -np.inf)
        for c, (a, b) in enumerate(zip(first, ends)):
            who = np.flatnonzero(visits[:, c])
            near[who, a:b] = q[who] @ e[a:b].T
        _, x, y = np.intersect1d(part["ask"].to_numpy(), ask, return_indices=True)
        near[x, y] = -np.inf  # a query's own row
        if near.shape[1] > k:  # the product's last digits hang on the layout: leave some room
            room = 1e-9 * (1 + np.abs(np.where(near > -np.inf, near, 0)).max(axis=1))
            least = np.partition(near, -k, axis=1)[:, -k] - room
            near[near < least[:, None]] = -np.inf
        at, row = np.nonzero(near > -np.inf)
        score = (e[row] * q[at]).sum(axis=1)
        order = np.lexsort((ids[row], -score, at))
        at, row, score = at[order], row[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        yield low + at[place < k], row[place < k], score[place < k]


def _search(rows: DataFrame, queries: Column, k: int, cells: int, sample_rows: int, visit: float | None,
            recall: float, trials: int) -> DataFrame:
    """``search`` among rows (id, v) with vectors of one length."""
    book = fit(rows, cells, sample_rows)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                v = np.vstack(batch.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(book.cells(v))], ["id", "v", "ask", "cell"])

    id_type = rows.schema["id"].dataType.simpleString()
    found = f"query_id {id_type}, vec_id {id_type}, score double"
    numbered = rows.withColumn("ask", F.monotonically_increasing_id())  # tells rows of one id apart
    index = staged(numbered.mapInArrow(assign, f"id {id_type}, v array<double>, ask long, cell long"), "index")
    size = np.zeros(len(book.left) * len(book.right), np.int64)
    for r in index.groupBy("cell").count().collect():  # at most cells squared
        size[r["cell"]] = r["count"]
    layout = Layout(size, max(LEAST_SHARDS, -(-int(size.sum()) // SHARD_ROWS)))
    asked = index.filter(queries).select("id", "v", "ask")
    n_asked = asked.count()
    blocks = max(1, -(-n_asked // QUERY_ROWS))
    share = needed_visit(index, asked, book, size, k, recall, trials) if visit is None else visit
    wanted = max(int(np.ceil(share * layout.total)), min(k + 1, layout.total))

    def place(batches):
        for batch in batches:
            shard = layout.shard_of(batch.column(3).to_numpy(), batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shard)],
                                             ["id", "v", "ask", "cell", "shard"])

    def probe(batches):
        for batch in batches:
            out = []
            for query, vector, ask in zip(*(c.to_pylist() for c in batch.columns)):
                walked = book.walk(np.array(vector), layout.size, wanted)
                out += [(query, vector, ask, s, c) for s, c in layout.shards_of(walked)]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([o[0] for o in out], batch.column(0).type),
                "v": pa.array([o[1] for o in out], pa.list_(pa.float64())),
                "ask": pa.array([o[2] for o in out], pa.int64()),
                "shard": pa.array([o[3] for o in out], pa.int64()),
                "cells": pa.array([o[4] for o in out], pa.list_(pa.int64()))})

    def rank(entries: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(probes):
            entries = entries.sort_values(["cell", "id"], kind="stable")
            # a shard holds a part of some cells, perhaps without rows of a cell it might hold
            here = entries["cell"].unique()
            probes = probes.assign(cells=[np.asarray(c)[np.isin(c, here)] for c in probes["cells"]])
            for at, row, score in best_of_shard(entries, probes, k):
                out.append(pd.DataFrame({
                    "query_id": probes["id"].to_numpy()[at], "vec_id": entries["id"].to_numpy()[row],
                    "score": score, "ask": probes["ask"].to_numpy()[at]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "ask": []})

    # entries go to each block of queries, so a shard that many queries probe is split by query
    keyed = index.select("id", "v", "ask", "cell",
                         F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 1).alias("key"))
    entries = keyed.mapInArrow(
        place, f"id {id_type}, v array<double>, ask long, cell long, shard long").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    probes = (asked.repartition(max(2, -(-n_asked // WALKS_PER_TASK)), "ask").mapInArrow(
        probe, f"id {id_type}, v array<double>, ask long, shard long, cells array<long>")
        .withColumn("block", F.pmod(F.xxhash64("ask", F.lit(1)), F.lit(blocks)).cast("int")))
    ranked = entries.groupBy("shard", "block").cogroup(probes.groupBy("shard", "block")).applyInPandas(
        rank, f"{found}, ask long")
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    return (ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
