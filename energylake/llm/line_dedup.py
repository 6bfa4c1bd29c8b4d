"""Substring dedup: repeated sentences and lines, found by the digest of their normalised text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm.common import pick, slices, small_batches, staged

LEAST_CHARS, UNIT_CHARS = 120, 20
FREQUENT = 1_000
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
# ends a unit: a line break, a mark of East Asian sentences, or a full stop and the like before a blank
UNIT_END = re.compile(r"[.!?][ \t]+|[\n。！？]")
BLANKS = re.compile(r"[\t\n\x0B\f\r ]+")


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of each unit; units join up to the whole text.

    Normalising puts letters in lower case, squeezes ASCII white space and drops it and
    sentence marks at the ends.  What is left may be empty.
    """
    at = 0
    for end in [*(m.end() for m in UNIT_END.finditer(text)), len(text)]:
        if end > at:
            yield at, end, BLANKS.sub(" ", text[at:end].lower()).strip(" ").rstrip(".!?。！？ ")
            at = end


def places(rows: DataFrame) -> DataFrame:
    """(row, doc_id, unit, digest) of every unit that isn't blank; a row's units are numbered without blank ones."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found = [[md5(norm.encode()).digest() for _, _, norm in units(t) if norm] if t else []
                         for t in part.column(2).to_pylist()]
                count = np.array([len(f) for f in found])
                owner = pa.array(np.repeat(np.arange(len(found)), count))
                number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(owner), part.column(1).take(owner), pa.array(number, pa.int32()),
                    pa.array([d for f in found for d in f], pa.binary())], ["row", "doc_id", "unit", "digest"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("row", "doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, unit int, digest binary")


def repeated_units(rows: DataFrame) -> DataFrame:
    """(row, units): the numbers of the units of each row that have occurred before.

    ``rows`` has row, doc_id and text.  Of equal units the one with the least doc_id (null
    last), row and place stays.  Digests are grouped with partial results.  Units that make up
    over a thousandth of all repeats, so fewer than a thousand, are looked up in a broadcast;
    the others meet their places in a join in which no key is frequent.
    """
    found = staged(places(rows), "places")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row", "unit")
    first = staged(
        found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("digest", "n", F.col("first.row").alias("r"), F.col("first.unit").alias("u")),
        "first")
    bound = (first.agg(F.sum("n")).first()[0] or 0) / FREQUENT
    found = found.drop("doc_id")
    often = F.broadcast(first.filter(F.col("n") > bound).drop("n"))
    rest = found.join(often, "digest", "left_anti").join(first.filter(F.col("n") <= bound).drop("n"), "digest")
    return (found.join(often, "digest").unionByName(rest).filter("row != r or unit != u")
            .groupBy("row").agg(F.sort_array(F.collect_list("unit")).alias("units")))


def _runs(text: str, repeated: list[int], least_chars: int, unit_chars: int) -> tuple[int, list[dict]]:
    """Number of units in the stretches of repeated units that are long enough, and their spans."""
    spans, removed, at, own = [], 0, 0, [u for u in units(text) if u[2]]
    while at < len(repeated):
        to = at + 1
        while to < len(repeated) and repeated[to] == repeated[to - 1] + 1:
            to += 1
        found = own[repeated[at]:repeated[to - 1] + 1]
        if sum(len(norm) for _, _, norm in found if len(norm) >= unit_chars) >= least_chars:
            spans.append({"start": found[0][0], "end": found[-1][1]})
            removed += len(found)
        at = to
    return removed, spans


def remove_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS, unit_chars: int = UNIT_CHARS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_removed (units), spans (what was removed), text (what is left).

    Units are lines, cut further where a sentence ends, so a passage is found in lines of any
    layout.  Units are equal if their normalised texts are; of equal ones the earliest in order of
    doc_id (null last) and place stays, whole texts considered.  Later ones are removed if
    those that follow each other, blank ones aside, have ``least_chars`` characters together,
    counting units of ``unit_chars`` or more.  A short sentence or common line alone so stays;
    with ``least_chars`` and ``unit_chars`` 1 every repeated unit goes.  Spans are code points of the
    original, the end exclusive, and hold the blanks and line break after their last unit;
    ``text`` is the original without them.  A null text stays null.  Repeated rows count as
    further copies.  An empty table gives no rows.
    """
    rows = staged(pick(docs, doc_id=id_col, text=text_col)
                  .withColumn("row", F.monotonically_increasing_id()), "rows")
    joined = rows.join(repeated_units(rows), "row", "left").select("doc_id", "text", "units")
    schema = T.StructType([joined.schema["doc_id"], T.StructField("n_removed", T.LongType()),
                           T.StructField("spans", T.ArrayType(SPAN)), T.StructField("text", T.StringType())])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def cut(text: str | None, repeated: list[int] | None) -> tuple[int, list[dict], str | None]:
        removed, spans = _runs(text, repeated, least_chars, unit_chars) if repeated else (0, [])
        ends = [0, *(s["end"] for s in spans)]
        starts = [*(s["start"] for s in spans), len(text or "")]
        return removed, spans, "".join(text[a:b] for a, b in zip(ends, starts)) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                made = [cut(*r) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([m[0] for m in made], pa.int64()),
                    pa.array([m[1] for m in made], pa.list_(span)),
                    pa.array([m[2] for m in made], pa.string())], schema.names)

    return joined.mapInArrow(run, schema)
