"""Quality: n-gram indicators scaled by log-count ratios, and a hinge-loss model on them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm import linear
from energylake.llm.common import map_texts, pick
from energylake.llm.ngrams import Grams, labelled_sample

SIZES = (1, 2, 3)


@dataclass
class Model:
    """Margin of a text: its mean-free weights over the length of its row, then a sigmoid."""

    features: np.ndarray
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def scorer(self):
        grams = Grams(SIZES, False, self.features)
        value = self.weight * self.ratio

        def score(texts):
            margin = np.full(len(texts), self.bias)
            for start, block in grams.present(texts):
                norm = np.sqrt(block @ self.ratio ** 2 + 1e-12)
                margin[start:start + len(block)] += (block @ value) / norm
            return [linear.sigmoid(self.slope * margin + self.offset)]

        return score


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 10_000,
          width: int = 4_000, alpha: float = 1.0, least_z: float = 3.0, c: float = 1.0,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``max_rows`` labelled texts (see ``labelled_sample``).

    Indicators of n-grams of one to three characters, case kept, are scaled by their
    log-count ratios; dual coordinate descent fits the hinge loss, and margins become
    probabilities by a fitted sigmoid.  With no labelled text the score is 0.5 everywhere,
    with one class only it is that class's smoothed share.
    """
    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(size) < 2:
        none, share = np.empty(0), float(np.log((size.get(1, 0) + 1) / (size.get(0, 0) + 1)))
        return Model(np.empty(0, np.uint32), none, none, 0.0, 0.0, share)
    features, ratio = linear.ratios(sample, Grams(SIZES, False), width, alpha, least_z)
    rows = linear.gathered(sample, Grams(SIZES, False, features))
    weight, bias = linear.fit_hinge(rows, ratio, c)
    norm = np.sqrt(rows.times(ratio * ratio) + 1e-12)
    margin = rows.times(ratio * weight) / norm + bias
    return Model(features, ratio, weight, bias, *linear.fit_scale(margin, rows.label))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted (1 from ``threshold`` on).

    The whole text counts; a null text counts as empty, and an empty one gets the score of
    a text without features.  Repeated rows are scored each for itself.
    """
    texts = pick(docs, doc_id=id_col, text=text_col)
    scored = map_texts(texts, "text", [T.StructField("score", T.DoubleType())], model.scorer)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
