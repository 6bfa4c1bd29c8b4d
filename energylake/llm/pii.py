"""Personal data by DataFrame functions alone: patterns, checksums, nearby words."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energylake.llm.common import pick, positional

BLOCK = 64
CONTEXT = 40
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def small_parts(value: Column) -> Column:
    """All dotted parts are at most 255, however many zeros lead."""
    def small(part: Column) -> Column:
        n = F.ltrim(part, F.lit("0"))
        return (F.length(n) <= 3) & (F.concat(F.lit("0"), n).try_cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def luhn(value: Column) -> Column:
    """The Luhn sum of the digits is a multiple of ten."""
    each = F.split(F.reverse(digits(value)), "")

    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    return F.aggregate(F.transform(F.filter(each, lambda d: d != ""), worth),
                       F.lit(0), lambda a, n: a + n) % 10 == 0


def mod97(value: Column) -> Column:
    """The IBAN, its first four characters moved to the end and letters as 10 to 35, is 1 modulo 97.

    Spaces do not count.
    """
    value = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(value, F.lit(5)), F.substring(value, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + c.cast("int")) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97)

    each = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(each, F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """A pattern, a quick test that a text may hold it, the check of a match, and its scores.

    ``score`` holds for a confirmed match and rises by ``lift`` if one of the ``near`` words
    stands in the 40 characters before it.
    """

    name: str
    pattern: str
    hint: str
    check: Callable[[Column], Column] | None
    score: float
    lift: float
    near: str


# Patterns of the kinds.  Possessive repeats and the looks behind only spare
# the engine attempts that cannot match; \G lets a match begin right after the last one.
BASE_KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", None, 0.9, 0.1, "mail|contact|write to|schreib|escrib|écri"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", small_parts, 0.6, 0.3,
         "ip|address|host|server|login|adresse"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
         "", luhn, 0.7, 0.3, "card|visa|credit|pay|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+",
         lambda v: F.length(digits(v)).between(9, 15), 0.6, 0.3, "call|phone|tel|mobile|fax|anruf"),
)
# Characters of an IBAN by country.  The length tells where one with spaces ends,
# so capitals that follow do not count as part of it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def iban_pattern() -> str:
    """An IBAN of its country's length with or without spaces between its characters, or else one
    of 15 to 34 characters, without spaces or in groups of four."""
    known = "|".join(f"(?:{'|'.join(c.split())})[0-9] ?[0-9](?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])"
                     for n, c in IBAN_LENGTHS.items())
    return (rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9])(?:{known}|[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}(?![A-Za-z0-9])"
            r"|(?=(?: ?[A-Z0-9]){11})(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?(?![A-Za-z0-9])))")


MORE_KINDS = (
    Kind("iban", iban_pattern(), "", mod97,
         0.9, 0.1, "iban|bank|account|konto|compte|cuenta"),
)
KINDS = BASE_KINDS + MORE_KINDS


def running_sums(values: Column, sums: Column) -> Column:
    """Sum up to and with each element, given the sums of blocks of 64.

    Sums within a block and sums of whole blocks keep the work well below the square of the
    number of elements.
    """
    def plus(a: Column, b: Column) -> Column:
        return a + b

    def block(_: Column, b: Column) -> Column:
        before = F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), plus)
        own = F.slice(values, b * BLOCK + 1, F.lit(BLOCK))
        once = F.array(F.struct(before.alias("before"), own.alias("own")))
        return F.transform(once, lambda s: F.transform(s["own"], lambda _, i: s["before"] + F.aggregate(
            F.slice(s["own"], F.lit(1), i + 1), F.lit(0), plus)))

    return F.flatten(F.flatten(F.transform(sums, block)))


def block_sums(values: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))
    return F.transform(starts, lambda b: F.aggregate(
        F.slice(values, b, F.lit(BLOCK)), F.lit(0), lambda a, v: a + v))


def add_spans(rows: DataFrame, text: str, kind: Kind) -> DataFrame:
    """The rows with the kind's spans, in a column of its name.

    The text is split at the matches; lengths of gaps and matches, summed up, are where the
    matches begin.  Each step is a column of its own, so that nothing is evaluated twice.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))
    if kind.hint:
        found = F.when(F.contains(t, F.lit(kind.hint)), found).otherwise(none)
    m, gaps, steps = F.col("_found"), F.col("_gaps"), F.col("_steps")
    some = F.size(m) > 0
    rows = rows.withColumn("_found", found)
    rows = rows.withColumn("_gaps", F.when(some, F.split(t, kind.pattern, -1)))
    rows = rows.withColumn("_steps", F.when(some, F.transform(m, lambda _, i: F.length(
        F.get(gaps, i)) + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(0))))
    rows = rows.withColumn("_sums", F.when(some, block_sums(steps)))
    rows = rows.withColumn("_starts", F.when(some, running_sums(steps, F.col("_sums"))))

    def span(start: Column, i: Column) -> Column:
        near = F.lower(F.right(F.get(gaps, i), F.lit(CONTEXT))).rlike(kind.near)
        return F.struct(
            F.lit(kind.name).alias("kind"), start.cast("int").alias("start"),
            (start + F.length(F.get(m, i))).cast("int").alias("end"),
            F.when(near, kind.score + kind.lift).otherwise(kind.score).alias("score"),
            F.get(m, i).alias("value"))

    spans = F.transform(F.col("_starts"), span)
    if kind.check:
        spans = F.filter(spans, lambda s: kind.check(s["value"]))
    spans = F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                  s["end"].alias("end"), s["score"].alias("score")))
    return (rows.withColumn(kind.name, F.coalesce(F.when(some, spans), F.array().cast(SPANS)))
            .drop("_found", "_gaps", "_steps", "_sums", "_starts"))


def all_spans(kinds: tuple[Kind, ...], least_score: float) -> Column:
    """The spans of all kinds; ``least_score`` drops some of those beyond the base kinds."""
    def scored(kind: Kind) -> Column:
        spans = F.col(kind.name)
        return spans if kind in BASE_KINDS or least_score <= 0 else F.filter(spans, lambda s: s["score"] >= least_score)

    return F.concat(*[scored(k) for k in kinds])


def find_pii(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, least_score: float = 0.0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end, score).

    Whole texts are searched.  Matches of a kind are leftmost and do not overlap; those that
    fail its check go.  Spans of the base kinds stay whatever their score; those of other kinds
    go if scored below ``least_score``, by default none.  Spans come by order of
    kinds, then by start, in code points, the end exclusive.  Null and empty texts have none;
    repeated rows are searched each for itself.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    for kind in kinds:
        rows = add_spans(rows, "text", kind)
    spans = all_spans(kinds, least_score)
    return rows.select("doc_id", spans.alias("spans"))


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, least_score: float = 0.0,
           text_col: str = "text") -> DataFrame:
    """The documents, all columns, with each span in the text replaced by its kind in brackets.

    Where spans of different kinds overlap, the one that begins first, or else the longer
    one, names the whole stretch.  ``least_score`` is that of ``find_pii``; spans it drops stay
    in the text.  Other texts, null ones included, stay as they are.
    """
    rows, text = positional(docs, text_col)
    names = rows.columns
    for kind in kinds:
        rows = add_spans(rows, text, kind)
    spans = all_spans(kinds, least_score)
    # an end counts down, so that of spans with one start the longest is first
    rows = rows.withColumn("_order", F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("low"), s["kind"].alias("kind")))))
    spans = F.col("_order")
    clash = F.exists(F.transform(spans, lambda s, i: F.coalesce(
        F.get(spans, i + 1)["start"] < -s["low"], F.lit(False))), lambda x: x)
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:int,low:int,kind:string>>"),
        lambda kept, s: F.when(
            (F.size(kept) > 0) & (s["start"] < -F.element_at(kept, -1)["low"]),
            F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(F.struct(
                F.element_at(kept, -1)["start"].alias("start"),
                F.least(F.element_at(kept, -1)["low"], s["low"]).alias("low"),
                F.element_at(kept, -1)["kind"].alias("kind")))))
        .otherwise(F.concat(kept, F.array(s))))
    rows = rows.withColumn("_spans", F.when(clash, merged).otherwise(spans))
    s = F.col("_spans")
    parts = F.transform(s, lambda x, i: F.concat(
        F.substr(F.col(text), F.coalesce(-F.get(s, i - 1)["low"], F.lit(0)) + 1,
                 x["start"] + F.coalesce(F.get(s, i - 1)["low"], F.lit(0))),
        F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = F.substr(F.col(text), -F.element_at(s, -1)["low"] + 1)
    clean = F.when(F.size(s) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col(text))
    return rows.withColumn(text, clean).select(names).toDF(*docs.columns)
