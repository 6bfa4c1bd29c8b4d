"""SQL of the queries that SQL can express."""

from __future__ import annotations

from energylake.llm.backoff_lm import ADD, PRIOR
from energylake.llm.line_dedup import LEAST_CHARS, UNIT_CHARS
from energylake.llm.secret_scan import NAMES

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
with item_words as (select cast(item_id as varchar) as item, {WORDS} as w from benchmark),
windows as (
  select distinct item, least(len(w), 10) as n, list_slice(w, i + 1, i + least(len(w), 10)) as win
  from (select item, w, unnest(range(greatest(len(w) - 10, 0) + 1)) as i from item_words where len(w) > 0)),
sizes as (select distinct n from windows),
doc_words as (select doc_id, {WORDS} as w from documents),
places as (
  select doc_id, n, i, list_slice(w, i + 1, i + n) as win
  from (select doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) as i from doc_words, sizes)),
found as (select p.doc_id, p.n, p.i, v.item from places p join windows v on p.n = v.n and p.win = v.win),
hits as (select doc_id, count(distinct k) as n_hit
         from (select doc_id, unnest(range(i, i + n)) as k from found) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
          from (select distinct doc_id, item from found) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hits using (doc_id) left join items using (doc_id)
"""

LINES = rf"""
with parts as (
  select doc_id, text, regexp_extract_all(coalesce(text, ''), '\n|(?s:.)+?(?:[.!?][ \t]+|[。！？]|\n|\z)') as l from documents),
units as (
  select doc_id, u.i as i, u.x as x, rtrim(trim(regexp_replace(lower(u.x), '[\t\n\x0B\f\r ]+', ' ', 'g'), ' '), '.!?。！？ ') as norm
  from (select doc_id, unnest([{{'i': i, 'x': l[i]}} for i in range(1, len(l) + 1)]) as u from parts)),
placed as (
  select *, sum(len(x)) over (partition by doc_id order by i) - len(x) as start from units),
numbered as (
  select *, row_number() over (partition by doc_id order by i) as k,
    row_number() over (partition by norm order by doc_id, i) > 1 as again
  from placed where norm <> ''),
stretches as (
  select *, k - row_number() over (partition by doc_id, again order by k) as stretch from numbered),
runs as (
  select doc_id, min(i) as a, max(i) as b, min(start) as s, max(start + len(x)) as e, count(*) as n
  from stretches where again group by doc_id, stretch
  having sum(len(norm)) filter (where len(norm) >= {UNIT_CHARS}) >= {LEAST_CHARS}),
listed as (
  select doc_id, sum(n) as n, string_agg(s || ':' || e, ',' order by s) as removed from runs group by doc_id),
kept as (
  select doc_id, string_agg(x, '' order by i) as text from units u
  where not exists (from runs r where r.doc_id = u.doc_id and u.i between r.a and r.b) group by doc_id)
select p.doc_id, cast(coalesce(n, 0) as bigint) as n_removed, coalesce(removed, '') as removed,
  case when p.text is not null then coalesce(k.text, '') end as text
from parts p left join listed using (doc_id) left join kept k using (doc_id)
"""


def spans(kind: str, order: int, pattern: str, check: str = "true") -> str:
    """Rows (doc_id, k, kind, s, e) of one kind; gaps and matches summed up give the places."""
    pattern = pattern.replace("'", "''")
    return f"""
select doc_id, {order} as k, '{kind}' as kind, s, s + len(m) as e from (
  select doc_id, ms[i] as m, cast(list_sum([len(x) for x in gs[1:i]])
    + coalesce(list_sum([len(x) for x in ms[1:i - 1]]), 0) as bigint) as s
  from (select doc_id, ms, gs, unnest(range(1, len(ms) + 1)) as i from (
    select doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') as ms,
      regexp_split_to_array(coalesce(text, ''), '{pattern}') as gs from documents))) where {check}"""


def report(parts: list[str], base: list[str], order: str) -> str:
    counts = ", ".join(f"cast(count(*) filter (where kind = '{b}') as bigint) as n_{b}" for b in base)
    kept = ", ".join(f"'{b}'" for b in base)
    zero = ", ".join(f"coalesce(n_{b}, 0) as n_{b}" for b in base)
    return f"""
with found as ({' union all '.join(parts)}),
summed as (select doc_id, {counts},
  string_agg(kind || ':' || s || ':' || e, ',' order by {order}) filter (where kind in ({kept})) as base,
  string_agg(kind || ':' || s || ':' || e, ',' order by {order}) as spans from found group by doc_id)
select doc_id, {zero}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join summed using (doc_id)
"""


SECRETS = report([
    spans("assign", 1, f"(?:{NAMES})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+",
          "regexp_full_match(m, '[^\"'' :=]+[\"'']? *[:=] *[\"'']?[A-Za-z0-9+/_.=-]{8,}')"),
    spans("access", 2, "AKIA[A-Z0-9]+", "len(m) >= 16"),
    spans("hex", 3, "[0-9a-f]{32,}"),
    spans("pem", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    spans("github", 5, "gh[pousr]_[A-Za-z0-9]+", "len(m) >= 40"),
    spans("gitlab", 6, "glpat-[A-Za-z0-9_-]+", "len(m) >= 26"),
    spans("slack", 7, "xox[abprs]-[A-Za-z0-9-]+", "len(m) >= 15"),
    spans("google", 8, "AIza[A-Za-z0-9_-]+", "len(m) >= 39"),
    spans("stripe", 9, "[rs]k_live_[A-Za-z0-9]+", "len(m) >= 32"),
    spans("jwt", 10, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
], ["assign", "access", "hex"], "s, k")

DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
TWICE = "2 * cast(substr(reverse({d}), j, 1) as int)".format(d=DIGITS)
LUHN = f"""len({DIGITS}) between 13 and 19 and list_sum([case when j % 2 = 1 then cast(substr(reverse({DIGITS}), j, 1) as int)
  when {TWICE} > 9 then {TWICE} - 9 else {TWICE} end for j in range(1, len({DIGITS}) + 1)]) % 10 = 0"""
LETTERS = """lpad(array_to_string([case when c between '0' and '9' then c else cast(ascii(c) - 55 as varchar) end
  for c in string_split(substr(m, 5) || substr(m, 1, 4), '')], ''), 70, '0')"""
MOD97 = f"""(cast(substr({LETTERS}, 1, 35) as hugeint) % 97 * {10 ** 35 % 97}
  + cast(substr({LETTERS}, 36, 35) as hugeint) % 97) % 97 = 1"""

PII = report([
    spans("email", 1, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    spans("ip", 2, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
          "list_max([cast(x as double) for x in string_split(m, '.')]) <= 255"),
    spans("card", 3, "[0-9](?:[ -]?[0-9])+", LUHN),
    spans("phone", 4, r"\+[0-9][ ().0-9-]+[0-9]", f"len({DIGITS}) between 9 and 15"),
    spans("iban", 5, r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", MOD97),
], ["email", "ip", "card", "phone"], "k, s")

HARD_NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor, b.vec_id as id, a.label = b.label as same,
    cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
positives as (select * from pairs where same
  qualify row_number() over (partition by anchor order by score desc, id) <= 5)
select p.anchor as anchor_id, p.id as positive_id,
  cast(row_number() over (partition by p.anchor, p.id order by n.score desc, n.id) as int) as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on n.anchor = p.anchor and not n.same
  and 100 * n.score between 30 * p.score and 90 * p.score
qualify row_number() over (partition by p.anchor, p.id order by n.score desc, n.id) <= 10
"""

# crc32 of a number as text: each byte is followed by eight shifts of one bit
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(cast(doc_id as varchar), ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1]::bigint[]))),
    lambda a, b: case when b >= 0 then xor(a, b) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end))"""

LANGUAGE_MODEL = rf"""
with texts as (
  select doc_id, coalesce({CRC} % 10 = 0, false) as held, list_concat([' begin'], regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), [' end']) as w from documents),
tokens as (
  select doc_id, held, w[i] as h, w[i + 1] as w
  from (select doc_id, held, w, unnest(range(1, len(w))) as i from texts)),
pairs as (select h, w, count(*) as c from tokens where not held group by all),
ones as (select w, sum(c) as c from pairs group by w),
contexts as (select h, sum(c) as c from pairs group by h),
size as (select cast(sum(c) as bigint) as n, count(*) as v from ones),
scored as (
  select doc_id, held, n, coalesce(o.c, 0) as c1, coalesce(x.c, 0) as ch, coalesce(p.c, 0) as c2,
    (coalesce(o.c, 0) + {ADD}::double) / (n + {ADD}::double * (v + 1)) as base
  from tokens t, size left join ones o on o.w = t.w left join contexts x on x.h = t.h
    left join pairs p on p.h = t.h and p.w = t.w)
select doc_id, held as held_out, count(*) as n_tokens, count(*) filter (where c1 > 0) as n_known,
  n as train_tokens, round(sum(log10(base)), 6) as base_score,
  round(sum(log10((c2 + {PRIOR}::double * base) / (ch + {PRIOR}::double))), 6) as score
from scored group by doc_id, held, n
"""
