"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake.llm import linear
from energylake.llm.common import map_texts, pick, positional
from energylake.llm.ngrams import Grams, labelled_sample

SIZES = (4, 5)


@dataclass
class Model:
    """``weight`` of each hashed n-gram in ``features``; without features the score is a constant."""

    features: np.ndarray
    weight: np.ndarray
    bias: float

    def scorer(self):
        grams = Grams(SIZES, True, self.features)

        def score(texts):
            margin = np.full(len(texts), self.bias)
            for start, block in grams.present(texts):
                margin[start:start + len(block)] += block @ self.weight
            return [linear.sigmoid(margin)]

        return score


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 10_000,
          width: int = 4_000, alpha: float = 1.0, least_z: float = 3.0, l2: float = 5e-5,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``max_rows`` labelled texts (see ``labelled_sample``).

    An n-gram of 4 or 5 lower-cased characters counts once a text.  Its log-count ratio
    scales its indicator, and a logistic model is fitted on those.  With no labelled text
    the score is 0 everywhere, with one class only it is that class's smoothed share.
    """
    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(size) < 2:
        ones, zeros = size.get(1, 0), size.get(0, 0)
        bias = float(np.log((ones + 1) / (zeros + 1))) if size else -np.inf
        return Model(np.empty(0, np.uint32), np.empty(0), bias)
    features, ratio = linear.ratios(sample, Grams(SIZES, True), width, alpha, least_z)
    rows = linear.gathered(sample, Grams(SIZES, True, features))
    weight, bias = linear.fit_logistic(rows, ratio, l2)
    return Model(features, weight, bias)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted (1 from ``threshold`` on).

    The whole text counts; a null text counts as empty, and an empty or very short one gets
    the score of a text without features.  Repeated rows are scored each for itself.
    """
    texts = pick(docs, doc_id=id_col, text=text_col)
    scored = map_texts(texts, "text", [T.StructField("score", T.DoubleType())], model.scorer)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7,
               text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose score stays below ``threshold``."""
    rows, text = positional(docs, text_col)
    scored = map_texts(rows, text, [T.StructField("score", T.DoubleType())], model.scorer, keep_text=True)
    return scored.filter(F.col("score") < threshold).drop("score").toDF(*docs.columns)
