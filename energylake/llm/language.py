"""Language identification by error-correcting output codes over n-gram classifiers."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm.common import key_remainder, map_texts, pick, slices, staged
from energylake.llm.ngrams import hashes, pieces

SIZE, BITS = 3, 20
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
SHARPNESS = 6.0
BROADCAST_ROWS = 200_000


def codewords(n: int, seed: int = 11, tries: int = 200) -> np.ndarray:
    """An n x bits matrix of +1 and -1, each column with both signs, rows far apart.

    All splits in two for up to five languages, else the best of ``tries`` random codes of
    ten bits per doubling of n.
    """
    if n <= 5:
        half = [(1, *rest) for rest in product((1, -1), repeat=max(n - 1, 0)) if -1 in rest]
        return np.array(half, np.int8).reshape(len(half), n).T
    draw, best, far = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(tries):
        code = draw.choice(np.array([1, -1], np.int8), (n, width))
        code = code[:, np.abs(code.sum(axis=0, dtype=int)) < n]
        same = code.astype(int) @ code.T.astype(int)
        near = int((code.shape[1] - same[~np.eye(n, dtype=bool)]).min()) // 2
        if near > far:
            best, far = code, near
    return best


def gram_counts(texts, slot: np.ndarray | None = None, width: int = 0):
    """(row, n-gram bucket) of every lower-cased trigram, or dense counts of chosen buckets."""
    ready = [t.lower() if t else "" for t in texts]
    rows, grams = [], []
    counts = None if slot is None else np.zeros(len(texts) * (width + 1))
    for points, owner in pieces(ready, SIZE - 1):
        h, row = hashes(points, owner, SIZE)
        h &= np.uint32((1 << BITS) - 1)
        if slot is None:
            rows.append(row)
            grams.append(h)
        elif len(row):
            low = row[0] * (width + 1)
            part = np.bincount((row - row[0]) * (width + 1) + slot[h])
            counts[low:low + len(part)] += part
    if slot is None:
        return (np.concatenate(rows), np.concatenate(grams)) if rows else (
            np.empty(0, np.int64), np.empty(0, np.uint32))
    return counts.reshape(len(texts), width + 1)


@dataclass
class Model:
    """One weight per chosen n-gram and codeword bit, and the trust in each bit."""

    languages: list[str]
    code: np.ndarray
    grams: np.ndarray
    weight: np.ndarray
    trust: np.ndarray

    def margins(self):
        """Function from texts to the mean log-likelihood ratio of each bit."""
        slot = np.zeros(1 << BITS, np.int32)
        slot[self.grams] = np.arange(1, len(self.grams) + 1)
        weight = np.vstack([np.zeros((1, self.code.shape[1])), self.weight])

        def run(texts):
            out = np.zeros((len(texts), self.code.shape[1]))
            for a in range(0, len(texts), 128):  # dense counts of 128 texts at a time
                counts = gram_counts(texts[a:a + 128], slot, len(self.grams))
                out[a:a + 128] = (counts @ weight) / np.maximum(counts.sum(axis=1), 1)[:, None]
            return out

        return run

    def predictor(self, gap: float):
        margins = self.margins()

        def predict(texts):
            known = np.array([bool(t and LETTER.search(t)) for t in texts])
            if not self.languages:
                return [[UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)]
            signed = SHARPNESS * margins(texts)[:, None, :] * self.code[None]
            loss = (self.trust * np.logaddexp(0, -signed)).sum(axis=2)
            best = loss.argmin(axis=1)
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            score = np.where(known, 1 / share.sum(axis=1), 0.0)
            ranked = np.sort(loss, axis=1)
            close = known & (ranked[:, 1] - ranked[:, 0] < gap) if loss.shape[1] > 1 else ~known
            names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            return [names, score, close & known]

        return predict


def first_keys(keyed: DataFrame, most: int) -> DataFrame:
    """The distinct (key, lang) among the ``most`` rows with the smallest hash of the key, per language.

    Rows of a language are counted first, and only hashes below some four times the share wanted
    are ranked, so a common language costs its task no more than others.  Where keys that
    repeat leave too few, the share is raised.
    """
    rows = dict(map(tuple, keyed.groupBy("lang").count().collect()))  # one row per language
    h, share = F.xxhash64(F.col("key").cast("string")), 4 * most
    order = Window.partitionBy("lang").orderBy(h, "key")
    while rows:
        least = {lang: min(int(-2 ** 63 + 2 ** 64 * min(share / n, 1)), 2 ** 63 - 1) for lang, n in rows.items()}
        cut = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        ranked = staged(keyed.filter(h <= F.element_at(cut, F.col("lang")))
                        .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most), "chosen")
        got = dict(map(tuple, ranked.groupBy("lang").count().collect()))
        if all(got.get(lang, 0) >= min(most, n) for lang, n in rows.items()):
            return ranked.select("key", "lang").distinct()
        share *= 16
    return keyed.limit(0)


def train(docs: DataFrame, per_language: int = 2_000, width: int = 20_000, alpha: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn the languages found in ``lang_col`` from ``per_language`` texts of each at most.

    Only keys whose crc32 modulo 3 is not 1 take part; those with the smallest hash are
    taken, and of rows that repeat a key the text with the smallest hash.  The ``width`` most frequent trigrams are features.  For each bit a naive Bayes
    classifier separates the languages with +1 from those with -1; the bit's trust is its
    accuracy above chance on the sample.  Without labelled text no language is known.
    """
    keyed = pick(docs, key=id_col, lang=lang_col).filter(
        F.col("lang").isNotNull() & (key_remainder(F.col("key")) != 1))
    chosen = first_keys(keyed, per_language)
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = pick(docs, key=id_col, text=text_col, lang=lang_col).filter(F.col("text").isNotNull())
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    sample = staged(texts.join(chosen, ["key", "lang"]).groupBy("key", "lang").agg(one)
                    .select("one.text", "lang"), "languages")

    def count(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            lang = np.array(batch.column(1).to_pylist(), object)
            row, gram = gram_counts(batch.column(0).to_pylist())
            names, at = np.unique(lang, return_inverse=True)
            keys, n = np.unique((at[row].astype(np.int64) << BITS) | gram, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[keys >> BITS].tolist(), pa.string()),
                 pa.array(keys & ((1 << BITS) - 1)), pa.array(n)], ["lang", "gram", "n"])

    counted = staged(sample.mapInArrow(count, "lang string, gram long, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())
    code = codewords(len(languages))
    most = counted.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(width)
    got = counted.join(F.broadcast(most), "gram").select("lang", "gram", "n").toArrow()
    grams, at = np.unique(got.column("gram").to_numpy(), return_inverse=True)
    counts = np.zeros((len(languages), len(grams)))
    position = {name: i for i, name in enumerate(languages)}
    counts[[position[x] for x in got.column("lang").to_pylist()], at] = got.column("n").to_numpy()
    # languages weigh alike, however many texts each has
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    scale = counts.sum() / max(len(languages), 1)
    weight = np.zeros((len(grams), code.shape[1] if len(languages) else 0))
    for b in range(weight.shape[1]):
        logs = []
        for sign in (1, -1):
            mass = share[code[:, b] == sign].mean(axis=0) * scale + alpha
            logs.append(np.log(mass / mass.sum()))
        weight[:, b] = logs[0] - logs[1]
    code = code if len(languages) else np.zeros((0, 0), np.int8)
    model = Model(languages, code, grams, weight, np.ones(code.shape[1]))
    model.trust = _trust(sample, model)
    return model


def _trust(sample: DataFrame, model: Model) -> np.ndarray:
    """Accuracy above chance of each bit on the sample, scaled to a mean of one."""
    width = model.code.shape[1]
    if not width:
        return np.ones(width)
    position = {name: i for i, name in enumerate(model.languages)}

    def judge(batches):
        margins = model.margins()
        for batch in (part for whole in batches for part in slices(whole, 0)):
            m = margins(batch.column(0).to_pylist())
            want = model.code[[position[x] for x in batch.column(1).to_pylist()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array((m * want > 0).sum(axis=0)),
                 pa.array(np.full(width, len(m)))], ["bit", "right", "seen"])

    rows = (sample.mapInArrow(judge, "bit long, right long, seen long")
            .groupBy("bit").agg(F.sum("right").alias("right"), F.sum("seen").alias("seen")).collect())
    gain = np.full(width, 1e-3)
    for r in rows:
        gain[r["bit"]] = max(2 * r["right"] / max(r["seen"], 1) - 1, 1e-3)
    return gain / gain.mean()


def predict(docs: DataFrame, model: Model, gap: float = 0.5, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, ambiguous.

    Loss-weighted decoding over the whole text: each bit's logistic loss against a
    codeword's sign, weighted by its trust; the nearest codeword wins, ties to the first
    name, and a runner-up within ``gap`` makes the answer ambiguous.  A null text, one
    without a letter, and any text when nothing was learned is ``und`` with score 0.
    """
    texts = pick(docs, doc_id=id_col, text=text_col)
    return map_texts(texts, "text", [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType())], lambda: model.predictor(gap))
