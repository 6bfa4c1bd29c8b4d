"""Hashed character n-grams of texts, in numpy, and labelled samples to learn from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energylake.llm.common import key_remainder, pick, slices, staged

PIECE = 1 << 19
SLOT_BITS = 20
SLOT_MASK = np.uint32((1 << SLOT_BITS) - 1)


def pieces(texts: Sequence[str], overlap: int, size: int = PIECE
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points and owning rows, in runs of about ``size`` characters.

    A longer text is cut with ``overlap`` characters repeated, so that each n-gram of
    ``overlap + 1`` characters lies in one run, and none lies in two.
    """
    held, owners, total = [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - overlap, 1), size):
            part = text[start:start + size + overlap]
            held.append(part)
            owners.append(i)
            total += len(part)
            if total >= size:
                yield _run(held, owners)
                held, owners, total = [], [], 0
    if held:
        yield _run(held, owners)


def _run(parts: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = "".join(parts).encode("utf-32-le", "surrogatepass")
    return (np.frombuffer(data, np.uint32),
            np.repeat(np.array(owners, np.int64), [len(p) for p in parts]))


def hashes(points: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hash and owner of each n-gram that lies inside one text."""
    m = len(points) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    h = np.full(m, n, np.uint32)
    for k in range(n):
        h *= np.uint32(0x01000193)
        h ^= points[k:k + m]
        h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    inside = owner[:m] == owner[n - 1:]
    return h[inside], owner[:m][inside]


class Grams:
    """Distinct n-grams of texts: all of them, or the chosen ``features`` (sorted hashes)."""

    def __init__(self, sizes: Sequence[int], lower: bool, features: np.ndarray | None = None):
        self.sizes, self.lower, self.features = tuple(sizes), lower, features

    def ready(self, texts: Sequence[str | None]) -> list[str]:
        return [(t.lower() if self.lower else t) if t else "" for t in texts]

    def pairs(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and n-grams, each pair once, in order of row and n-gram."""
        found = [np.unique((row << 32) | h) for n in self.sizes
                 for points, owner in pieces(self.ready(texts), n - 1)
                 for h, row in [hashes(points, owner, n)]]
        keys = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return keys >> 32, keys & 0xFFFFFFFF

    def present(self, texts: Sequence[str | None], block: int = 128
                ) -> Iterator[tuple[int, np.ndarray]]:
        """First row and 0/1 matrix (text by feature) of each block of texts."""
        slot = np.full(1 << SLOT_BITS, -1, np.int32)
        slot[self.features & SLOT_MASK] = np.arange(len(self.features))
        ready = self.ready(texts)
        for start in range(0, len(ready), block):
            part = ready[start:start + block]
            out = np.zeros((len(part), len(self.features)), bool)
            for n in self.sizes if len(self.features) else ():
                for points, owner in pieces(part, n - 1):
                    h, row = hashes(points, owner, n)
                    at = slot[h & SLOT_MASK]
                    real = (at >= 0) & (self.features[at] == h)
                    out[row[real], at[real]] = True
            yield start, out


def without_collisions(ranked: Sequence[int]) -> list[int]:
    """The hashes whose slot no hash before them has taken."""
    taken, kept = set(), []
    for gram in ranked:
        if gram & int(SLOT_MASK) not in taken:
            taken.add(gram & int(SLOT_MASK))
            kept.append(gram)
    return kept


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` texts with a label 0 or 1, staged as (text, label).

    Only keys whose crc32 modulo 3 is not 1 take part; of those the ones with the smallest
    hash are taken, so the choice does not hang on row order.  A key that is labelled twice
    counts with each distinct label.  The broadcast holds ``max_rows`` keys at most.
    """
    marked = (pick(labels, key=id_col, label=label)
              .filter(F.col("label").isin(0, 1) & (key_remainder(F.col("key")) != 1))
              .select("key", F.col("label").cast("int").alias("label")).distinct()
              .orderBy(F.xxhash64(F.col("key").cast("string")), "key", "label").limit(max_rows))
    texts = pick(docs, key=id_col, text=text_col).filter(F.col("text").isNotNull())
    return staged(texts.join(F.broadcast(marked), "key").select("text", "label"), "sample")


def class_counts(sample: DataFrame, grams: Grams) -> DataFrame:
    """Texts of label 1 and of label 0 that hold each n-gram: (gram, ones, zeros)."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            label = batch.column(1).to_numpy(zero_copy_only=False)
            row, gram = grams.pairs(batch.column(0).to_pylist())
            ids, at = np.unique(gram, return_inverse=True)
            ones = np.bincount(at, weights=label[row], minlength=len(ids)).astype(np.int64)
            every = np.bincount(at, minlength=len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(ones), pa.array(every - ones)], ["gram", "ones", "zeros"])

    return (sample.mapInArrow(run, "gram long, ones long, zeros long")
            .groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")))


def rows_of_features(sample: DataFrame, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, row starts and feature positions of the sampled texts, in order of the texts' hashes.

    Bounded by the rows of the sample times the features; kept in flat arrays throughout.
    """

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            lists = [np.flatnonzero(x) for _, block in grams.present(batch.column(0).to_pylist())
                     for x in block]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(lists, pa.list_(pa.int32()))], ["label", "key", "at"])

    got = (sample.select("text", "label", F.xxhash64("text").alias("key"))
           .mapInArrow(run, "label int, key long, at array<int>").toArrow().combine_chunks())
    label, key = (got.column(k).to_numpy() for k in ("label", "key"))
    lists = pa.concat_arrays(got.column("at").chunks)
    size = np.diff(lists.offsets.to_numpy())
    values = lists.values.to_numpy()[lists.offsets[0].as_py():]
    order = np.lexsort((size, label, key))
    first = np.concatenate([[0], np.cumsum(size)])[order]
    start = np.concatenate([[0], np.cumsum(size[order])]).astype(np.int64)
    shift = np.repeat(first - start[:-1], size[order])
    return label[order].astype(np.float64), start, values[np.arange(len(shift)) + shift].astype(np.int64)
