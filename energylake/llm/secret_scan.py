"""Secrets: one deterministic automaton over all rules, in one pass over the bytes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from energylake.llm.automata import Parser, Pattern, compile_dfa
from energylake.llm.common import map_texts, pick


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and a check that a match must also pass.

    ``head`` is what the joint automaton looks for instead of the whole pattern: the shortest
    matches, where a match goes on with a run that may have any length.
    """

    kind: str
    pattern: str
    check: str = ""
    head: str = ""


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
# The patterns of the rules.  Runs whose least length is part of the pattern
# are whole runs all the same, since a match takes all that the run holds.
BASE_RULES = (
    Rule("assign", f"({NAMES})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+",
         r"[^\"'\x20:=]+[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8,}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12,}", "AKIA[A-Z0-9]"),
    Rule("hex", "[0-9a-f]{32,}"),
)
# Runs of free length are left to the automaton of their own rule, by ``head`` and ``check``: in the joint
# one, the counters of the runs would multiply.
MORE_RULES = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]+", "glpat-[A-Za-z0-9_-]{20,}", "glpat-[A-Za-z0-9_-]"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-[A-Za-z0-9-]"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}", "AIza[A-Za-z0-9_-]"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", "[rs]k_live_[A-Za-z0-9]{24,}", "[rs]k_live_[A-Za-z0-9]"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "",
         r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]"),
)
RULES = BASE_RULES + MORE_RULES

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


@lru_cache(maxsize=2)
def compiled(rules: tuple[Rule, ...]):
    heads = [Parser(r.head or r.pattern).parse() for r in rules]
    return compile_dfa(heads, anywhere=True), [Pattern(r.pattern) for r in rules], [
        re.compile(r.check.encode()) if r.check else None for r in rules]


def scanner(rules: tuple[Rule, ...], tables):
    """Function from texts to the span lists of each, by start and then by order of rules."""
    dfa, patterns, checks = tables

    def in_text(data: bytes, ends: np.ndarray, bits: np.ndarray) -> list[dict]:
        found = []
        for i, (rule, pattern, check) in enumerate(zip(rules, patterns, checks)):
            own = ends[(bits >> i) & 1 == 1]
            if len(own):
                found += [(s, i, e) for s, e in pattern.matches(data, own.tolist())
                          if check is None or check.fullmatch(data, s, e)]
        if not found:
            return []
        # code points before each byte offset: continuation bytes begin none
        chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
        return [{"kind": rules[i].kind, "start": int(chars[s]), "end": int(chars[e])}
                for s, i, e in sorted(found)]

    def scan(texts):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
        ends, bits = dfa.scan(np.frombuffer(b"\n".join(raw), np.uint8))
        cut = np.searchsorted(ends, first, side="right")
        spans = [in_text(r, ends[a:b] - at, bits[a:b]) if b > a else []
                 for r, at, a, b in zip(raw, first, cut, cut[1:])]
        return [pa.array(spans, pa.list_(SPAN_ARROW))]

    return scan


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end).

    Whole texts are scanned.  Offsets are code points, the end exclusive; spans of one kind
    do not overlap, those of different kinds may, and they come by start, then by order of
    rules.  Null and empty texts have none.  Repeated rows are scanned each for itself.
    The automata are compiled once and sent to the tasks.
    """
    rules = tuple(rules)
    tables = compiled(rules)
    if not tables[0].resets[10]:
        raise ValueError("no rule may match across lines")
    return map_texts(pick(docs, doc_id=id_col, text=text_col), "text",
                     [T.StructField("spans", T.ArrayType(SPAN))], lambda: scanner(rules, tables))
