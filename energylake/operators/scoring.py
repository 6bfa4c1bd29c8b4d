"""The fitted model and its use on whole tables or streams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import astuple, dataclass

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from energylake.fixed_values import (
    CLASS_BOUNDS, CLASS_COLOUR, CLASS_LABELS, GAP_OVERFIT, PRICE_PER_KWH, R2_MODERATE,
    R2_TOO_HIGH, SCALE_END, UNKNOWN_COLOUR, UNKNOWN_LABEL)
from energylake.functions.columns import band_lower, clamp, col, lookup, safe_ratio
from energylake.operators.rows import join_small

INTERCEPT = "(intercept)"
MODEL_SCHEMA = "feature string, source string, value string, mean double, std double, coef double"


@dataclass(frozen=True)
class Term:
    """One model column; ``value`` is null for a number and the category of a dummy."""

    feature: str
    source: str | None
    value: str | None
    mean: float
    std: float
    coef: float


@dataclass(frozen=True)
class RidgeModel:
    terms: tuple[Term, ...]
    intercept: float

    def rows(self) -> list[tuple]:
        return [*map(astuple, self.terms), (INTERCEPT, None, None, 0.0, 1.0, self.intercept)]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), MODEL_SCHEMA)


def save_model(model: RidgeModel, spark: SparkSession, path: str) -> None:
    """Model as a small Parquet table, one row per term in training order."""
    (spark.createDataFrame([(i, *r) for i, r in enumerate(model.rows())],
                           "position int, " + MODEL_SCHEMA)
     .coalesce(1).write.mode("overwrite").parquet(path))


def load_model(spark: SparkSession, path: str) -> RidgeModel:
    rows = [tuple(r)[1:] for r in spark.read.parquet(path).orderBy("position").collect()]
    terms = [Term(*r) for r in rows if r[0] != INTERCEPT]
    return RidgeModel(tuple(terms), next(r[-1] for r in rows if r[0] == INTERCEPT))


def absent_columns(df: DataFrame, model: RidgeModel) -> list[str]:
    """Trained columns that the frame lacks; they count as 0 when it is scored."""
    return sorted({t.source for t in model.terms} - set(df.columns))


def prediction(model: RidgeModel, unknown: str = UNKNOWN_LABEL,
               columns: Sequence[str] | None = None) -> Column:
    """The model as one column expression.

    Of trained columns only those in ``columns`` are read, if that is given; an absent
    number counts as 0 and an absent category has weight 0.

    Centring goes into the constant and each category column becomes one lookup of
    its weight.  A category not seen in training has weight 0, as have columns the
    model does not know; null where a number is missing.
    """
    constant = model.intercept - sum(t.coef * t.mean / t.std for t in model.terms)
    weights = defaultdict(dict)
    out = F.lit(float(constant))
    for t in model.terms:
        if columns is not None and t.source not in columns:
            continue
        if t.value is None:
            out = out + col(t.source).cast("double") * F.lit(t.coef / t.std)
        else:
            weights[t.source][t.value] = t.coef / t.std
    for source, by_value in weights.items():
        out = out + lookup(F.coalesce(col(source).cast("string"), F.lit(unknown)), by_value, 0.0)
    return out


def score(df: DataFrame, model: RidgeModel, out: str = "conso_predite_m2") -> DataFrame:
    """Adds the predicted consumption per square metre, never below 0."""
    return df.withColumn(out, clamp(prediction(model, columns=df.columns), low=0))


def with_cost(df: DataFrame, conso_m2: str, surface: str,
              price: float = PRICE_PER_KWH) -> DataFrame:
    """Adds the home's yearly consumption and cost."""
    total = col(conso_m2) * col(surface)
    return df.withColumns({"conso_totale_kwh_an": total, "cout_annuel_eur": total * price})


def score_homes(df: DataFrame, model: RidgeModel, surface: str,
                price: float = PRICE_PER_KWH) -> DataFrame:
    """Prediction, yearly consumption and cost, class, its colour and place on the scale."""
    out = with_cost(score(df, model), "conso_predite_m2", surface, price)
    conso = F.col("conso_predite_m2")
    out = out.withColumns({"classe_predite": band_lower(conso, CLASS_BOUNDS, CLASS_LABELS),
                           "position_echelle": clamp(conso, high=SCALE_END)})
    return out.withColumn("couleur", lookup(F.col("classe_predite"), CLASS_COLOUR, UNKNOWN_COLOUR))


def compare_to_class(df: DataFrame, cls: str, pred: str,
                     means: Mapping[str, float] | DataFrame, mean: str = "mean",
                     bound: int | None = None) -> DataFrame:
    """Adds the class's reference mean and the distance of the prediction from it.

    ``means`` is a short mapping, or a table of (class, mean) as ``mean_by`` gives.
    """
    if isinstance(means, DataFrame):
        table = means.select(col(cls), col(mean).alias("moyenne_classe"))
        out = join_small(df, table, cls, bound=bound)
    else:
        out = df.withColumn("moyenne_classe", lookup(col(cls), means))
    return out.withColumn("ecart_moyenne", col(pred) - F.col("moyenne_classe"))


def rank_coefficients(coefs: DataFrame, k: int = 5, feature: str = "feature",
                      coef: str = "coef") -> DataFrame:
    """The k strongest raising and the k strongest lowering features, with bar lengths 0..20."""
    size = F.abs(col(coef))
    strongest = coefs.agg(F.max(size)).scalar()
    order = Window.partitionBy("direction").orderBy(size.desc(), col(feature))
    return (coefs.filter(col(coef) != 0)
            .withColumn("direction", F.when(col(coef) > 0, "up").otherwise("down"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(col(feature), col(coef), "direction", "rank",
                    F.floor(safe_ratio(size * 20, strongest)).cast("int").alias("bar")))


def diagnose(metrics: DataFrame) -> DataFrame:
    """Adds the gap between train and test R2 and a verdict on the model."""
    gap, test = col("r2_train") - col("r2_test"), col("r2_test")
    return metrics.withColumns({
        "gap": gap,
        "diagnosis": F.when(test > R2_TOO_HIGH, "too_high").when(gap > GAP_OVERFIT, "overfit")
        .when(test < R2_MODERATE, "moderate").otherwise("healthy")})
