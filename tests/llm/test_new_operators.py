"""Periodic runs, hard negatives and language-model scores against plain versions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

import energylake.llm.queries as queries
from energylake.llm import backoff_lm, hard_negatives, periodic_runs
from energylake.llm.registry import REGISTRY
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
WORD = "[^\x20\x09-\x0D]+"


def plain_runs(w, least=12):
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in out.items())


def sequences(seed, number):
    random = np.random.default_rng(seed)
    for _ in range(number):
        yield random.integers(0, random.integers(1, 4), random.integers(0, 90)).tolist()
        x = random.integers(0, 3, random.integers(1, 9)).tolist() * random.integers(1, 12)
        y = random.integers(0, 3, random.integers(1, 30)).tolist() * random.integers(1, 5)
        yield (x + y) * random.integers(1, 4) + random.integers(0, 2, random.integers(0, 9)).tolist()


def test_runs_of_growing_sequences():
    random = np.random.default_rng(4)
    for w in sequences(1, 300):
        at_once, online, i = periodic_runs.Catchers(), periodic_runs.Catchers(), 0
        at_once.append(np.array(w))
        while i < len(w):
            k = int(random.integers(1, 6))
            online.append(np.array(w[i:i + k]))
            i += k
            assert online.runs() == plain_runs(w[:i])
        assert at_once.runs() == online.runs() == plain_runs(w)
    fibonacci, next_ = "a", "ab"
    while len(fibonacci) < 500:
        fibonacci, next_ = next_, next_ + fibonacci
    docs = [[c.encode() for c in fibonacci], [], [b"x"] * 700, [b"x"] * 11, [b"a", b"b"] * 6]
    assert periodic_runs.runs_of(docs) == [plain_runs(d) for d in docs]


def test_names_that_collide_do_not_change_the_runs(monkeypatch):
    good = periodic_runs.mixed
    calls = []

    def bad(left, right):
        calls.append(1)
        return np.zeros_like(left) if len(calls) < 5 else good(left, right)

    monkeypatch.setattr(periodic_runs, "mixed", bad)
    catchers = periodic_runs.Catchers()
    w = [1, 2, 3] * 6 + list(range(4, 40))
    catchers.append(np.array(w))
    assert catchers.runs() == [(0, 18, 3)] and len(calls) > 5


def test_runs_on_odd_rows(spark):
    texts = [None, "", " \n", "a " * 5000, "a\xa0b " * 12, "x y " * 6 + "z", "x y " * 6 + "z"]
    docs = spark.createDataFrame([*((i, t, "r", 1) for i, t in enumerate(texts)), (None, "q " * 12, "r", 1)],
                                 "doc_id long, text string, runs string, KEY int")
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(docs).collect()}
    assert {i: [tuple(x) for x in r["runs"]] for i, r in got.items()} == {
        0: [], 1: [], 2: [], 3: [(0, 5000, 1)], 4: [(0, 12, 1)], 5: [(0, 12, 2)], 6: [(0, 12, 2)], None: [(0, 12, 1)]}
    assert [got[i]["collapsed"] for i in (0, 2, 3, 4, 5)] == ["", "", "a", "a\xa0b", "x y z"]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_runs_query_against_plain_runs(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in REGISTRY["op11_periodic_runs"].run(spark, DATA).collect()}
    checked = 0
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        w = re.findall(WORD, r["text"] or "")
        if len(w) > 2000:
            continue
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = plain_runs(w)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        s, n, p = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert got[r["doc_id"]] == (len(runs), s, n, p, n and 1000 * n // p, *(
            hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))
        checked += bool(runs)
    assert checked > 10


def test_repeated_tail_of_a_null_key():
    assert queries.repeated_tail(None, [b"a"]) == [b"a"] and queries.repeated_tail(3, []) == []


def plain_negatives(rows, asked, positives=5, negatives=10):
    sound = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
             if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(sound):
        if not asked(i):
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w)), j, own) for b, (j, own, w) in enumerate(sound)
                        if b != a and len(w) == len(v))
        for s, j in [(s, j) for s, j, own in others if own == label][:positives]:
            fit = [(t, k) for t, k, own in others if own != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "block_anchors": 3}])
def test_hard_negatives_against_all_pairs(spark, sizes):
    random = np.random.default_rng(3)
    rows = [(i, int(random.integers(0, 4)), random.normal(0, 1, 4).round(1).tolist()) for i in range(200)]
    rows += [(7, 1, [.5, .5, 0., 0.]), (20, 2, [0.] * 4), (20, 2, [0.] * 4), (None, 1, [1.] * 4),
             (400, None, [1.] * 4), (500, 1, None), (501, 1, [1., None, 1., 1.]), (502, 1, [float("nan")] * 4),
             (503, 1, [float("inf")] * 4), (520, 1, [1., 2.]), (521, 1, [1., 2.]), (522, 2, [.5, 1.]),
             (540, 3, [9.] * 3), (560, 1, []), (-20, 1, [1., -1., 1., 1.])]
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows],
                                  "vec_id long, label int, embedding array<double>, row string, VEC_ID int")
    got = hard_negatives.mine(frame, F.col("id") % 20 == 0, **sizes)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 20 == 0)


def test_hard_negatives_of_large_scores_and_no_rows(spark):
    frame = spark.createDataFrame([(0, "a", [1e6] * 2), (1, "a", [1e6] * 2), (2, "b", [5e5] * 2)],
                                  "vec_id long, label string, embedding array<double>")
    score = 2 * 256000000 ** 2
    assert [tuple(r) for r in hard_negatives.mine(frame, F.col("id") % 20 == 0).collect()] == [
        (0, 1, 1, 2, score, score // 2)]
    assert hard_negatives.mine(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def test_keys_sort_by_anchor_score_and_id():
    random = np.random.default_rng(2)
    rows = [tuple(int(x) for x in random.integers(-3, 4, 4)) for _ in range(300)]
    made = [(hard_negatives.keys(a, 5, [s], k % 3, [i])[0], (a, 5, -s, k % 3, i)) for a, s, k, i in rows]
    assert [b for _, b in sorted(made)] == sorted(b for _, b in made)
    assert all(hard_negatives.unpacked(k) == (a, r, -s, kind, i) for k, (a, r, s, kind, i) in made)


def plain_scores(texts, learn, order, prior, add=0.1):
    tokens = [[" b"] + re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [" e"]
              for t in texts]
    count = collections.Counter(tuple(t[i - n + 1:i + 1]) for t, own in zip(tokens, learn) if own
                                for i in range(len(t)) for n in range(1, order + 1) if i - n + 1 >= 0)
    known = {k[0]: c for k, c in count.items() if len(k) == 1 and k[0] != " b"}
    total = sum(known.values())

    def chance(h, w):
        if not h:
            return (known.get(w, 0) + add) / (total + add * (len(known) + 1))
        return (count[h + (w,)] + prior * chance(h[1:], w)) / (count[h] + prior)

    return [(len(t) - 1, sum(w in known for w in t[1:]), total, sum(math.log10(chance((), w)) for w in t[1:]),
             sum(math.log10(chance(tuple(t[max(0, i - order + 1):i]), t[i])) for i in range(1, len(t))))
            for t in tokens]


@pytest.mark.parametrize("order, sizes", [(1, {}), (2, {}), (2, {"block_bytes": 500, "part_bytes": 3000}),
                                          (3, {"block_bytes": 900, "part_bytes": 1000}), (4, {})])
def test_scores_against_plain_counts(spark, order, sizes):
    random = np.random.default_rng(2)
    voc = ["a", "B", "b", "é", "É", "zz", ".", "x" * 50, "end"]
    texts = [None, "", " \n", "a", "a a a a", "a a a a", "b " * 3000] + [
        " ".join(random.choice(voc, random.integers(0, 40))) for _ in range(120)]
    frame = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)],
                                  "doc_id long, text string, block string, LEARN int")
    got = sorted(map(tuple, backoff_lm.score_texts(frame, F.col("id") % 3 != 0, order, prior=8.0, **sizes).collect()))
    want = plain_scores(texts, [i % 3 != 0 for i in range(len(texts))], order, 8.0)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[1:4] == w[:3] and g[4:] == pytest.approx(w[3:], rel=1e-9)


def test_scores_without_rows_to_learn_from(spark):
    frame = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert backoff_lm.score_texts(frame.limit(0), F.lit(True)).count() == 0
    assert {tuple(r)[1:] for r in backoff_lm.score_texts(frame, F.lit(False)).collect()} == {
        (3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)}


def test_probabilities_of_all_next_words_sum_to_one():
    learn, texts = ["a b c a b", "b a", "c c c"], ["a", "a a", "a b", "a c", "a d"]
    grams = backoff_lm.Grams([*learn, *texts], 2)
    counts = grams.counts(np.array([True] * 3 + [False] * 5))
    model = backoff_lm.Automaton(grams, counts, 13, 4, 5.0, 0.1)
    ends = np.cumsum(grams.sizes)[3:]
    paths = [model.walk({n: own[e - size:e if len(t) == 1 else e - 1].tolist() for n, own in grams.at.items()})
             for t, e, size in zip(texts, ends, grams.sizes[3:])]
    a = {n: own[ends[0] - 3:ends[0] - 1].tolist() for n, own in grams.at.items()}
    # after a: the end, a, b, c, and what was never seen
    assert sum(10 ** p for p in paths) == pytest.approx(10 ** model.walk(a))


def test_counts_in_a_byte():
    for counts in ([], [0, 1, 254, 255, 256, 10 ** 12, 3]):
        assert backoff_lm.widened(backoff_lm.narrow(np.array(counts, np.int64)), len(counts)).tolist() == counts
