"""SimHash near-duplicates: blocks by the pigeonhole principle, then the Hamming distance."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm.common import map_texts, pick, positional, staged
from energylake.llm.components import Forest, components

SHINGLE, DISTANCE, SEED = 4, 4, 42
BUCKET = 4_096
PAIR_COST = 0.02
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, as a signed number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(
        starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        counts += np.unpackbits(hashes[i:i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8),
                                axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def _fingerprints(rows: DataFrame, text: str, shingle: int) -> DataFrame:
    return map_texts(rows, text, [T.StructField("fp", T.LongType())],
                     lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]])


def block_keys(fp: Column, distance: int, blocks: int) -> list[Column]:
    """Keys of which two fingerprints within ``distance`` bits share at least one.

    Of ``blocks`` blocks at most ``distance`` can differ, so some choice of the others is
    equal.  A key is the number of the choice and the bits of its blocks.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return keys


def blocks_for(n: int, distance: int) -> int:
    """The cheapest number of blocks for ``n`` fingerprints; the links are the same for any.

    More blocks make more rows, one for each choice of blocks, but longer keys, on which fewer
    fingerprints meet by chance.  Comparing a pair costs ``PAIR_COST`` of shuffling a row.
    """
    def cost(blocks: int) -> float:
        bits = (blocks - distance) * (64 // blocks)
        return comb(blocks, distance) * (1 + PAIR_COST * n / 2 ** (bits + 1))

    return min(range(distance + 2, distance + 6), key=cost)


def _links(choice: np.ndarray, bits: np.ndarray, fp: np.ndarray, distance: int, forest: Forest):
    """A forest of the pairs within ``distance`` inside the runs of equal keys."""
    kept, i, step = [], np.arange(len(fp)), 1
    while True:
        i = i[i + step < len(fp)]
        i = i[(bits[i] == bits[i + step]) & (choice[i] == choice[i + step])]
        if not len(i):
            return kept
        near = i[np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64)) <= distance]
        kept += forest.add(fp[near], fp[near + step])
        step += 1


def _link_task(distance: int, bucket: int):
    """Sorted (choice, bits, fp) rows to links and, for keys with over ``bucket`` rows, the rows."""

    def run(batches):
        held = None  # rows of the last key, which may go on in the next batch
        for batch in batches:
            choice, bits, fp = (batch.column(k).to_numpy() for k in range(3))
            if held is not None:
                choice, bits, fp = (np.concatenate([a, b]) for a, b in zip(held, (choice, bits, fp)))
            new = np.flatnonzero((np.diff(choice) != 0) | (np.diff(bits) != 0)) + 1
            begin = int(new[-1]) if len(new) else 0
            yield from _emit(choice[:begin], bits[:begin], fp[:begin], distance, bucket)
            if len(fp) - begin > bucket + 1:  # enough rows stay behind to show that the key is large
                yield _hot(fp[begin:])
                begin = len(fp) - bucket - 1
            held = choice[begin:], bits[begin:], fp[begin:]
        if held is not None:
            yield from _emit(*held, distance, bucket)

    return run


def _hot(fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(len(fp), pa.int64())], ["u", "v"])


def _emit(choice, bits, fp, distance, bucket):
    if not len(fp):
        return
    first = np.flatnonzero(np.concatenate([[True], (np.diff(choice) != 0) | (np.diff(bits) != 0)]))
    size = np.diff(np.append(first, len(fp)))
    small = np.repeat(size <= bucket, size)
    if not small.all():
        yield _hot(fp[~small])
    kept = _links(choice[small], bits[small], fp[small], distance, Forest())
    if kept:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64())],
            ["u", "v"])


def _ball_links(hot: DataFrame, distance: int) -> DataFrame:
    """Links of the fingerprints of large keys, linear in their number.

    Two fingerprints are within ``distance`` exactly if some point lies within
    floor(distance / 2) of one and the rest of the other.  Each is dealt to all points that
    near; at a point, the least of those within the smaller radius is linked to all others.
    """
    near, far = distance // 2, distance - distance // 2

    def points(batches):
        flips = [sum(1 << b for b in bits) for r in range(far + 1) for bits in combinations(range(64), r)]
        mask = np.array(flips, np.uint64).view(np.int64)
        inner = np.repeat([True, False], [m := sum(
            1 for f in flips if f.bit_count() <= near), len(flips) - m])
        for batch in batches:
            for fp in batch.column(0).to_numpy():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp ^ mask), pa.array(np.full(len(mask), fp)), pa.array(inner)],
                    ["point", "fp", "inner"])

    dealt = hot.mapInArrow(points, "point long, fp long, inner boolean")
    least = dealt.groupBy("point").agg(
        F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"),
        F.count(F.lit(1)).alias("n")).filter("n > 1 and a is not null")
    both = dealt.join(least, "point")
    return both.select(F.col("fp").alias("u"), F.col("a").alias("v")).filter("u != v").distinct()


def near_links(fingerprints: DataFrame, distance: int = DISTANCE, blocks: int | None = None,
               bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) that connect what is linked.

    Every pair within ``distance`` bits is joined by a path of edges, and each edge is such a
    pair.  Fingerprints meet on their block keys; keys are sorted and compared run by run, a
    spanning forest of the verified pairs is kept, and keys with over ``bucket`` rows are
    only streamed through and linked by ``_ball_links``.  Without ``blocks`` their number
    follows from that of the fingerprints.
    """
    blocks = blocks or blocks_for(fingerprints.count(), distance)
    keyed = fingerprints.select("fp", F.explode(F.array(*block_keys(F.col("fp"), distance, blocks))).alias("k"))
    sorted_ = (keyed.select(F.col("k.choice").alias("choice"), F.col("k.bits").alias("bits"), "fp")
               .repartition("choice", "bits").sortWithinPartitions("choice", "bits", "fp"))
    found = staged(sorted_.mapInArrow(_link_task(distance, bucket), "u long, v long"), "links")
    edges = found.filter("v is not null")
    hot = found.filter("v is null").select("u").distinct()
    if hot.isEmpty():
        return edges
    return edges.unionAll(_ball_links(hot, distance))


def _classes(prints: DataFrame, distance: int, blocks: int | None, bucket: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of (doc_id, fp) rows."""
    least = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    root = components(near_links(least.select("fp"), distance, blocks, bucket))
    named = least.join(root, least["fp"] == root["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    blocks: int | None = None, bucket: int = BUCKET, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Whole texts are fingerprinted: A-Z lower-cased, words between ASCII white space, shingles
    of ``shingle`` words with repeats, a bit set if over half the shingles' hashes have it.
    Fewer words are one shingle; null and empty texts have fingerprint zero and link like any
    other.  Fingerprints that differ in ``distance`` bits at most are linked, and
    component_id is the least doc_id reached.  Null ids do not count for that; a component
    with null ids only has a null one.  Repeated rows keep a row each.
    """
    prints = staged(_fingerprints(pick(docs, doc_id=id_col, text=text_col), "text", shingle), "prints")
    classes = _classes(prints, distance, blocks, bucket)
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
             blocks: int | None = None, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, less all but the least doc_id (null last) of each component.

    Of rows with the same least id, or with null ids only, the first stays.
    """
    rows, text = positional(docs, text_col)
    key = positional(docs, id_col)[1]
    table = staged(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    prints = staged(_fingerprints(table.select("row", F.col(key).alias("doc_id"), text), text, shingle),
                    "prints")
    classes = _classes(prints, distance, blocks, bucket)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    first = (prints.join(classes, "fp").groupBy("root").agg(F.min(place).alias("first"))
             .select(F.col("first.row").alias("row")))
    return table.join(first, "row", "left_semi").select(rows.columns).toDF(*docs.columns)
