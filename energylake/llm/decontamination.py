"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the benchmark."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm.common import map_texts, pick, positional, staged

WINDOW = 10
# An automaton takes some 140 bytes of a worker for each byte of benchmark text.
BLOCK_BYTES = 2 << 20
LETTERS = 2
UNKNOWN = "\0" * LETTERS
# Words are runs of ASCII letters and digits and of everything beyond ASCII; in UTF-8 that
# is a question of single bytes.  A-Z becomes a-z, every other ASCII byte a space.
NORMAL = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90
               else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SPAN_ARROW = pa.struct([("start", pa.int32()), ("end", pa.int32())])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
         T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))]


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split() if text else []


@dataclass(frozen=True)
class Benchmark:
    """Items as (item id, text) pairs; equal objects share one automaton in a worker."""

    items: tuple[tuple[str, str], ...]
    window: int = WINDOW


def spelled(n: int, base: int) -> str:
    """A number as ``LETTERS`` letters; each place has its own, so that no other split matches."""
    return "".join(chr(1 + place * base + n // base ** place % base) for place in range(LETTERS))


@lru_cache(maxsize=2)
def automaton(benchmark: Benchmark) -> tuple[dict[bytes, str], ahocorasick.Automaton | None]:
    """Spelling of each benchmark word, and the automaton over the windows in that spelling.

    Words of equal, short spelling make few nodes with few branches, and a match can only
    begin and end with a word.  Each window has its number of words and the items that hold it.
    """
    split = [(item, words(text)) for item, text in benchmark.items]
    known = sorted({w for _, own in split for w in own})
    base = max(math.ceil(len(known) ** (1 / LETTERS)), 2)
    base += base ** LETTERS < len(known)
    code = {w: spelled(n, base) for n, w in enumerate(known)}
    owners: dict[str, set[str]] = {}
    for item, own in split:
        line = "".join([code[w] for w in own])
        size = LETTERS * benchmark.window
        for i in range(0, max(len(line) - size, 0) + 1 if own else 0, LETTERS):
            owners.setdefault(line[i:i + size], set()).add(item)
    if not owners:
        return code, None
    found = ahocorasick.Automaton()
    for key, items in owners.items():
        found.add_word(key, (len(key) // LETTERS, tuple(sorted(items))))
    found.make_automaton()
    return code, found


def scanner(benchmark: Benchmark):
    """Function from texts to the columns of ``ADDED``."""
    code, machine = automaton(benchmark)

    def scan(text: str | None):
        own = words(text)
        if machine is None or not own:
            return len(own), 0, [], []
        line = "".join([code.get(w, UNKNOWN) for w in own])
        found = [(end // LETTERS, *value) for end, value in machine.iter(line)]
        if not found:
            return len(own), 0, [], []
        edge = np.zeros(len(own) + 1, np.int64)
        for last, n, _ in found:
            edge[last + 1 - n] += 1
            edge[last + 1] -= 1
        hit = np.cumsum(edge[:-1]) > 0
        return (len(own), int(hit.sum()), sorted({i for _, _, items in found for i in items}),
                _original(text, hit))

    def run(texts):
        rows = [scan(t) for t in texts]
        return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
                pa.array([r[3] for r in rows], pa.list_(SPAN_ARROW))]

    return run


def _original(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code point spans of the original text."""
    places = [m.span() for m in WORD.finditer(text)]
    starts = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
    ends = np.flatnonzero(hit & ~np.concatenate([hit[1:], [False]]))
    return [{"start": places[a][0], "end": places[b][1]} for a, b in zip(starts, ends)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated.

    ``window`` consecutive words of an item, or all words of a shorter one, are a window;
    document words inside any occurrence are hit.  ``items`` holds the items with an
    occurring window, sorted; ``spans`` the runs of hit words in code points of the original.
    Null and empty texts have no words, and an empty benchmark hits nothing.  Items without
    words are never found; repeated items count once; a null item id is the empty string.
    Repeated documents are searched each for itself.

    Benchmark texts travel to the tasks, so their size is measured first.  Up to
    ``block_bytes`` they make one automaton and texts are scanned once; a larger benchmark
    is dealt out by item into blocks of about half that size, whose results are merged.
    """
    found = _search(pick(docs, doc_id=id_col, text=text_col), "text", benchmark, window,
                    block_bytes, item_col, item_text_col).drop("text")
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _search(rows: DataFrame, text: str, benchmark: DataFrame, window: int, block_bytes: int,
            item_col: str, item_text_col: str) -> DataFrame:
    """The rows, all columns, with those of ``ADDED``."""
    items = pick(benchmark, item=item_col, text=item_text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("item") + F.octet_length("text"))).first()[0] or 0
    if size <= block_bytes:
        return _scan(rows, text, items, window)
    blocks = 2 * (size // block_bytes + 1)
    numbered = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "texts")
    hits = None
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        one = staged(_scan(numbered.select("_row", text), text, part, window)
                     .filter("n_hit > 0").select("_row", "items", "spans"), "hits")
        hits = one if hits is None else hits.unionAll(one)
    merged = hits.groupBy("_row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"),
        F.flatten(F.collect_list("spans")).alias("_parts"))
    return _merge(numbered.join(merged, "_row", "left").drop("_row"), text)


def _scan(rows: DataFrame, text: str, items: DataFrame, window: int) -> DataFrame:
    held = Benchmark(tuple(sorted((r["item"], r["text"]) for r in items.collect())), window)
    return map_texts(rows, text, ADDED, lambda: scanner(held), keep_text=True)


def _merge(joined: DataFrame, text: str) -> DataFrame:
    """Counts and spans of each row from what its blocks have found (``_items``, ``_parts``)."""
    at, width = joined.columns.index(text), len(joined.columns) - 2
    schema = T.StructType([*joined.schema.fields[:width], *ADDED])
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(SPAN_ARROW)]

    def merge(body, items, parts):
        places = [m.span() for m in WORD.finditer(body or "")]
        hit = np.zeros(len(places), bool)
        begins = np.array([p[0] for p in places], np.int64)
        for part in parts or ():
            hit[np.searchsorted(begins, part["start"]):np.searchsorted(begins, part["end"])] = True
        return len(places), int(hit.sum()), items or [], _original(body, hit) if hit.any() else []

    def run(batches):
        for batch in batches:
            made = [merge(*row) for row in zip(*[
                batch.column(k).to_pylist() for k in (at, width, width + 1)])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *[pa.array([m[k] for m in made], kind)
                                           for k, kind in enumerate(kinds)]], schema.names)

    return joined.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    rows, text = positional(docs, text_col)
    found = _search(rows, text, benchmark, window, block_bytes, item_col, item_text_col)
    return found.filter("n_hit = 0").select(rows.columns).toDF(*docs.columns)
