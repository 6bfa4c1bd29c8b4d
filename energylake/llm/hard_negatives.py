"""Hard-negative mining: pair scores in sort keys, one sorted stream per anchor."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm.common import pick, staged

BLOCK_ROWS, BLOCK_ANCHORS = 4_096, 1_024
KEY = np.dtype([("anchor", ">u8"), ("row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
OWN, POSITIVE, NEGATIVE = 0, 1, 2  # an anchor's own record opens its stream
ANCHOR_BYTES = 16
SIGN = np.uint64(1 << 63)

Pair = tuple[bytes, bytes]


def keys(anchor, row, score, kind, ids) -> list[bytes]:
    """Bytes that sort by anchor, then score downwards, kind, and id."""
    ids = np.asarray(ids, np.int64)
    made = np.empty(len(ids), KEY)
    made["anchor"], made["id"] = (np.asarray(x, np.int64).view(np.uint64) ^ SIGN for x in (anchor, ids))
    made["row"], made["kind"] = row, kind
    made["score"] = ~(np.asarray(score).astype(np.int64).view(np.uint64) ^ SIGN)
    data = made.tobytes()
    return [data[i:i + KEY.itemsize] for i in range(0, len(data), KEY.itemsize)]


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    """anchor, row, score, kind, id of a key."""
    k = np.frombuffer(key, KEY)[0]
    half = 1 << 63
    return int(k["anchor"]) - half, int(k["row"]), half - 1 - int(k["score"]), int(k["kind"]), int(k["id"]) - half


def dealt(key: bytes) -> int:
    return crc32(key[:ANCHOR_BYTES])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: doubles where they can hold them, else longs."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0 ** 53:
        return a @ b.T
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    if max(abs(x) for x in exact.flat) >= 1 << 63:
        raise OverflowError("an inner product is beyond 64 bits")
    return exact.astype(np.int64)


def first(among: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``among``, the ``k`` with the highest score, ties by smaller id."""
    if len(among) > k:
        own = score[among]
        among = among[own >= np.partition(own, -k)[-k]]
    return among[np.lexsort((ids[among], -score[among]))][:k]


def packed(rows: DataFrame, size: int, scale: float, label: str) -> DataFrame:
    """Blocks of ``size`` rows or fewer with vectors of one length, pickled, a row of the frame each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def flush(parts):
            ids, row, labels, vectors = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(
                (ids, row, labels, np.floor(scale * vectors)))], pa.binary())})

        for batch in batches:
            ids, row, labels, vectors = (batch.column(batch.schema.names.index(n)) for n in ("id", "row", label, "v"))
            sizes = np.diff(vectors.offsets.to_numpy())
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                part = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), n)
                held = waiting.setdefault(int(n), [])
                held.append((ids.to_numpy()[at], row.to_numpy()[at], labels.to_numpy()[at], part))
                if sum(len(h[0]) for h in held) >= size:
                    yield flush(waiting.pop(int(n)))
        for held in waiting.values():
            yield flush(held)

    return rows.mapInArrow(run, "block binary")


def grid(blocks: RDD, count: int, anchors: RDD) -> RDD:
    """Every block of rows followed, in one sorted stream a block, by every block of anchors."""
    met = anchors.flatMap(lambda a: (((i, 1), a) for i in range(count)))
    return (blocks.union(met).repartitionAndSortWithinPartitions(count, lambda k: k[0])
            .mapPartitions(meetings))


def meetings(stream: Iterable[tuple[tuple[int, int], bytes]]) -> Iterator[tuple[tuple, tuple]]:
    rows = None
    for (_, kind), data in stream:
        block = pickle.loads(data)
        if kind == 0:
            rows = block
        elif rows[3].shape[1] == block[3].shape[1]:
            yield rows, block


def local_positives(k: int, met: Iterable) -> Iterator[Pair]:
    """The first ``k`` rows of an anchor's label in each block; the anchor's own row is no partner."""
    for (ids, row, label, vectors), (anchor, own, its, asked) in met:
        score = scores(asked, vectors)
        for i in range(len(anchor)):
            best = first(np.flatnonzero((label == its[i]) & (row != own[i])), score[i], ids, k)
            yield from ((key, b"") for key in keys(anchor[i], own[i], score[i][best], POSITIVE, ids[best]))


def with_positives(k: int, size: int, stream: Iterable[Pair]) -> Iterator[bytes]:
    """Blocks of anchors, each with the scores and ids of its first ``k`` partners overall."""
    held: dict[int, list] = {}
    for _, own in groupby(stream, lambda kv: kv[0][:ANCHOR_BYTES]):
        found, record = [], None
        for key, value in own:
            if value:
                record = pickle.loads(value)
            elif len(found) < k:
                found.append(key)
        if not found:
            continue
        part = held.setdefault(len(record[3]), [])
        part.append((*record, [unpacked(key)[2::2] for key in found]))
        if len(part) >= size:
            yield block_of(held.pop(len(record[3])))
    yield from map(block_of, held.values())


def block_of(records: list[tuple]) -> bytes:
    ids, row, label, vectors, found = zip(*records)
    return pickle.dumps((np.array(ids), np.array(row), np.array(label), np.stack(vectors), list(found)))


def local_negatives(k: int, low: int, high: int, met: Iterable) -> Iterator[Pair]:
    """For each window of an anchor, the first ``k`` rows of another label in each block."""
    for (ids, row, label, vectors), (anchor, own, its, asked, found) in met:
        score = scores(asked, vectors)
        for i in range(len(anchor)):
            other = np.flatnonzero(label != its[i])
            theirs, best = score[i][other], []
            for s in {s for s, _ in found[i]}:
                fits = other[(theirs <= high * s // 100) & (theirs >= -(-low * s // 100))]
                best.append(first(fits, score[i], ids, k))
            at = np.unique(np.concatenate(best))
            yield from ((key, b"") for key in keys(anchor[i], own[i], score[i][at], NEGATIVE, ids[at]))


def windows(k: int, low: int, high: int, stream: Iterable[Pair]) -> Iterator[tuple]:
    """Rows of the result from the sorted keys: a positive opens a window, negatives fall into open ones.

    A positive comes before the negatives of its window, as their scores are at most a share
    of its own; of equal scores positives sort first.  Full windows are closed.
    """
    for _, own in groupby(stream, lambda kv: kv[0][:ANCHOR_BYTES]):
        open_: list[list] = []
        for key, _ in own:
            anchor, _, score, kind, other = unpacked(key)
            if kind == POSITIVE:
                open_.append([other, score, 0])
                continue
            for window in open_:
                if low * window[1] <= 100 * score <= high * window[1]:
                    window[2] += 1
                    yield anchor, window[0], window[2], other, window[1], score
            open_ = [w for w in open_ if w[2] < k]


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30,
         high: int = 90, scale: float = 256, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the column ``id``; all other rows are partners.  Components
    become floor(scale * x), scores are whole inner products; higher ones come first, ties by
    smaller id.  An anchor's positives are its first ``positives`` rows of the same label.  For
    each, the negatives are the first ``negatives`` rows of other labels whose score is ``low``
    to ``high`` percent of the positive's.

    Anchors meet rows block by block, and each block sends on only the first of its own
    partners that could count, which loses none.  A first sorted shuffle on packed keys
    (anchor, falling score, id) gives the positives, so the windows; a second one merges the
    blocks' negatives with them, and one pass over its stream opens windows and fills them.
    No task holds the partners of an anchor, whatever they number.

    Rows without id, label or vector, or with a null or non-finite component, take no part.
    Vectors of different lengths are no partners.  Rows that repeat an id count each for itself,
    also as anchors.  Labels that are no whole numbers are compared by a 64-bit hash.  An inner product beyond 64
    bits is an error.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id=id_col, label=label_col, v=vec_col)
    whole = isinstance(rows.schema["label"].dataType, T.IntegralType)
    label = F.col("label").cast("long") if whole else F.xxhash64(F.col("label").cast("string"))
    sound = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.filter("id is not null and label is not null and v is not null").select(
        F.col("id").cast("long").alias("id"), label.alias("label"), F.col("v").cast("array<double>").alias("v"))
    rows = staged(rows.filter(sound).withColumn("row", F.monotonically_increasing_id()), "rows")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(anchors)).first()
    blocks = staged(packed(rows.repartition(max(1, -(-n // block_rows)), "row"), block_rows, scale, "label"), "blocks")
    asking = staged(packed(rows.filter(anchors).repartition(max(1, -(-asked // block_anchors)), "row"),
                           block_anchors, scale, "label"), "anchors")
    count = max(1, blocks.count())
    numbered = blocks.rdd.map(lambda r: bytes(r[0])).zipWithIndex().map(lambda bi: ((bi[1], 0), bi[0]))
    asking = asking.rdd.map(lambda r: bytes(r[0]))

    def records(block: bytes) -> Iterator[Pair]:
        ids, row, labels, v = pickle.loads(block)
        opening = keys(ids, row, np.full(len(ids), (1 << 63) - 1), OWN, ids)
        return ((k, pickle.dumps(r)) for k, r in zip(opening, zip(ids, row, labels, v)))

    def positive_keys(block: bytes) -> Iterator[Pair]:
        ids, row, _, _, found = pickle.loads(block)
        for i, own in enumerate(found):
            yield from ((k, b"") for k in keys(ids[i], row[i], [s for s, _ in own], POSITIVE, [p for _, p in own]))

    tops = grid(numbered, count, asking).mapPartitions(partial(local_positives, positives))
    partners = (tops.union(asking.flatMap(records)).repartitionAndSortWithinPartitions(count, dealt)
                .mapPartitions(partial(with_positives, positives, block_anchors)))
    partners = spark.createDataFrame(partners.map(lambda b: (bytearray(b),)), "block binary")
    partners = staged(partners, "positives").rdd.map(lambda r: bytes(r[0]))
    hard = grid(numbered, count, partners).mapPartitions(partial(local_negatives, negatives, low, high))
    stream = hard.union(partners.flatMap(positive_keys)).repartitionAndSortWithinPartitions(count, dealt)
    return spark.createDataFrame(
        stream.mapPartitions(partial(windows, negatives, low, high)),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        verifySchema=False)
