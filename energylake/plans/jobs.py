"""The stages: bronze to silver, silver to gold, training, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake import fixed_values as fv
from energylake.functions.columns import band_closed, col, finite, safe_ratio
from energylake.operators import cleaning as cl
from energylake.operators.features import dummies, training_target, vocabulary
from energylake.operators.gains import class_gains
from energylake.operators.metrics import class_distribution, regression_metrics
from energylake.operators.quantiles import (
    from_sketches, kept_sketches, numeric_columns, place_among_values)
from energylake.operators.ridge import Factors, Moments, best_alpha, cross_validate, fold_moments
from energylake.operators.rows import (
    Bucket, fold_by_key, fold_exactly, hash_bucket, split_by_key, split_exactly)
from energylake.operators.scoring import (
    RidgeModel, Term, diagnose, load_model, prediction, save_model, score_homes)
from energylake.sources.layers import (
    parse_bronze, read_bronze, read_json_table, read_layer, replace_partitions, with_others,
    write_json_table, write_layer)


@dataclass(frozen=True)
class CleaningSpec:
    """Which columns each cleaning rule is for."""

    dropped: Sequence[str] = ()
    labels: Sequence[str] = ()
    insulation: Sequence[str] = ()
    critical: Sequence[str] = ()
    zero: Sequence[str] = ()
    boolean: Sequence[str] = ()
    median: Sequence[str] = ()
    clipped: Sequence[str] = ()
    logged: Sequence[str] = ()
    rel_err: float = fv.QUANTILE_ERROR


DWELLINGS = CleaningSpec(
    dropped=[*fv.META_COLUMNS, *fv.DATE_COLUMNS, *fv.TEXT_COLUMNS], labels=fv.LABEL_COLUMNS,
    insulation=fv.INSULATION_COLUMNS, critical=fv.CRITICAL_COLUMNS, zero=fv.ZERO_COLUMNS,
    boolean=fv.BOOLEAN_COLUMNS, median=fv.MEDIAN_COLUMNS, clipped=fv.CLIPPED_COLUMNS,
    logged=fv.LOG_COLUMNS)


def select_rows(df: DataFrame, spec: CleaningSpec = DWELLINGS) -> DataFrame:
    """The columns and rows worth cleaning."""
    return cl.drop_incomplete(cl.drop_columns(df, spec.dropped), spec.critical)


def encode(df: DataFrame, spec: CleaningSpec = DWELLINGS) -> DataFrame:
    """Codes and constants of selected rows: all of ``repair`` that needs no statistics."""
    df = cl.encode_ordinal(df, spec.labels, fv.CLASS_RANK)
    df = cl.encode_ordinal(df, cl.present(df, spec.insulation), fv.INSULATION_RANK, 0, lower=True)
    return cl.encode_boolean(cl.fill_zero(df, spec.zero), spec.boolean)


def repair(df: DataFrame, spec: CleaningSpec = DWELLINGS) -> DataFrame:
    """Codes, gap filling, clipping and scaling of selected rows.

    Two jobs read the needed columns before the result is planned: one for all
    medians, one for all quartiles of the filled columns.
    """
    df = cl.impute_median(encode(df, spec), spec.median, spec.rel_err)
    df = cl.clip_iqr(df, spec.clipped, fv.IQR_FACTOR, spec.rel_err)
    return cl.log_transform(df, spec.logged)


def clean(df: DataFrame, spec: CleaningSpec = DWELLINGS) -> DataFrame:
    """Bronze rows to silver rows."""
    return repair(select_rows(df, spec), spec)


def _bronze_rows(spark: SparkSession, bronze: str, spec: CleaningSpec, schema, dataset: str | None,
                 discover: bool) -> DataFrame:
    rows = parse_bronze(spark, bronze, schema, spec.dropped) if discover else read_bronze(spark, bronze, schema)
    return rows if dataset is None else rows.filter(col("dataset") == dataset)


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, staging: str,
                     spec: CleaningSpec = DWELLINGS, schema=None,
                     dataset: str | None = None, discover: bool = False) -> DataFrame:
    """Clean a bronze directory into a silver table and report on it.

    With ``dataset`` only that partition is read; ``bronze`` is then the root that ingest
    writes, whose log tells committed files from left-over ones.  With ``discover`` every field
    beyond the schema (by default that of the dwellings) becomes a text column, and those of
    other datasets don't.

    The JSON text is read and parsed once, into a columnar staging table in shared storage;
    the field names, the quantile jobs and the final write read that.  Rows are counted on the way.
    """
    read, kept = Observation("read"), Observation("kept")
    rows = _bronze_rows(spark, bronze, spec, schema, dataset, discover)
    rows = rows.observe(read, F.count(F.lit(1)).alias("rows"))
    rows = select_rows(rows, spec).observe(kept, F.count(F.lit(1)).alias("rows"))
    write_layer(rows, staging)
    staged = read_layer(spark, staging)
    result = repair(with_others(staged) if discover else staged, spec)
    write_layer(result, silver)
    rows_in, rows_out = read.get["rows"], kept.get["rows"]
    return (class_distribution(read_layer(spark, silver), spec.critical[0])
            .withColumns({"rows_in": F.lit(rows_in), "rows_dropped": F.lit(rows_in - rows_out),
                          "rows_out": F.lit(rows_out), "columns_out": F.lit(len(result.columns))}))


DAY = "date"


@dataclass(frozen=True)
class History:
    """What the kept sketches of all days say: fill values and bounds per column."""

    medians: dict[str, float]
    fences: dict[str, tuple[float, float]]


def history(sketches: DataFrame, spec: CleaningSpec = DWELLINGS) -> History:
    """Medians of the values, and bounds from the quartiles of the filled columns, over all days.

    Only the sketches are read, a row per day and column.  A day's sketch holds its values
    and the number of its gaps, not what filled them; so when later days move the median,
    the quartiles of the filled column still follow.
    """
    found = {c: f for c, f in from_sketches(sketches, [0.5], spec.rel_err).items() if f[1]}
    places = {c: [place_among_values(p, rows if c in spec.median else n, n) for p in (0.25, 0.75)]
              for c, (rows, n, _) in found.items() if c in spec.clipped}
    marks = from_sketches(sketches, [p for ps in places.values() for p in ps], spec.rel_err) if places else {}
    return History({c: found[c][2][0.5] for c in spec.median if c in found},
                   {c: cl.fences(*[marks[c][2][p] for p in ps], fv.IQR_FACTOR) for c, ps in places.items()})


def clean_day(spark: SparkSession, bronze: str, silver: str, staging: str, sketches: str, day: str,
              spec: CleaningSpec = DWELLINGS, schema=None, dataset: str | None = None,
              discover: bool = False) -> History:
    """Clean one day of bronze into its partition of silver, with statistics of all days so far.

    Only that day's files are read: once from bronze, then from ``staging``.  Its sketches
    replace that day's in the table ``sketches``, where those of other days stay, and the medians and
    quartiles come from all of them, to ``spec.rel_err`` as in a clean of everything.  A day that is
    cleaned again replaces its own sketches and rows.  Silver rows of other days stay as they were
    cleaned.  A day without rows changes nothing.
    """
    rows = _bronze_rows(spark, bronze, spec, schema, dataset, discover).filter(col(DAY) == F.lit(day).cast("date"))
    write_layer(select_rows(rows, spec), staging)
    staged = read_layer(spark, staging)
    encoded = encode(with_others(staged) if discover else staged, spec)
    names = numeric_columns(encoded, dict.fromkeys([*spec.median, *spec.clipped]))
    filled = encoded.withColumns({c: col(c).cast("float") for c in names if c in spec.median})
    replace_partitions(kept_sketches(filled, names, spec.rel_err, [DAY]), sketches, [DAY])
    known = history(read_layer(spark, sketches), spec)
    result = cl.clip_between(cl.fill_gaps(encoded, {c: m for c, m in known.medians.items() if c in names}),
                             {c: f for c, f in known.fences.items() if c in names})
    result = cl.log_transform(result, spec.logged)
    if isinstance(result.schema[DAY].dataType, T.DateType):  # a constant day is written without a sort of the rows, which spills
        result = result.withColumn(DAY, F.lit(day).cast("date"))
    replace_partitions(result, silver, [DAY])
    return known


def prepare_gold(df: DataFrame, year: str = "annee_construction",
                 conso: str = "conso_5_usages_ef", surface: str = "surface_habitable_logement",
                 bands=tuple(fv.PERIOD_BANDS), last: str = fv.PERIOD_LAST) -> DataFrame:
    """All columns plus the construction period and the consumption per square metre."""
    return df.withColumns({"periode_construction": band_closed(col(year), bands, last),
                           "conso_calculee_par_m2": safe_ratio(col(conso), col(surface))})


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> DataFrame:
    write_layer(prepare_gold(read_layer(spark, silver)), gold)
    return read_layer(spark, gold)


def publish_gains(gold: DataFrame, path: str, price: float = fv.PRICE_PER_KWH) -> None:
    """Gains per class transition as one JSON document."""
    write_json_table(class_gains(gold, "etiquette_dpe", "conso_5_usages_par_m2_ef",
                                 "surface_habitable_logement", fv.CLASS_RANK, price), path)


@dataclass(frozen=True)
class TrainingSpec:
    """Columns and settings of the regression."""

    categories: Sequence[str] = tuple(fv.CATEGORY_FEATURES)
    numbers: Sequence[str] = tuple(fv.NUMBER_FEATURES)
    conso: str = "conso_5_usages_ef"
    surface: str = "surface_habitable_logement"
    target_range: tuple[float, float] = fv.TARGET_RANGE
    key: Sequence[str] = ()
    alphas: Sequence[float] = tuple(fv.ALPHAS)
    folds: int = fv.FOLDS
    test: float = fv.TEST_SHARE
    seed: int = fv.SEED
    bucket: Bucket = hash_bucket
    exact: bool = False
    scale_on: str = "all"
    max_values: int | None = None
    collinear: bool = False


TARGET = "target_conso_m2"
HELD_OUT = -1


def training_rows(df: DataFrame, spec: TrainingSpec) -> DataFrame:
    """Target, filled features, split and fold of every usable row, and no other column.

    The hashed key defaults to the columns used, so rows that are equal in all of
    them fall on the same side.  With ``exact`` the split and the folds have their exact sizes,
    for a few more scans of the rows.
    """
    categories, numbers = cl.present(df, spec.categories), cl.present(df, spec.numbers)
    used = [*dict.fromkeys([spec.conso, spec.surface, *categories, *numbers, *spec.key])]
    rows = training_target(df.select([col(c) for c in used]), spec.conso, spec.surface,
                           *spec.target_range, out=TARGET)
    rows = cl.fill_label(rows, categories, fv.UNKNOWN_LABEL)
    rows = rows.withColumns({c: finite(col(c).try_cast("double")) for c in numbers})
    rows = cl.impute_median(rows, numbers, exact=True)
    key = spec.key or used
    if spec.exact:
        rows = split_exactly(rows, key, spec.test, spec.seed)
        folds = fold_exactly(rows.filter("split = 'train'"), key, spec.folds, spec.seed)
        return folds.unionByName(rows.filter("split = 'test'").withColumn("fold", F.lit(HELD_OUT)))
    rows = split_by_key(rows, key, spec.test, spec.seed, spec.bucket)
    return fold_by_key(rows, key, spec.folds, spec.seed, spec.bucket).withColumn(
        "fold", F.when(F.col("split") == "test", HELD_OUT).otherwise(F.col("fold")))


def train(df: DataFrame, spec: TrainingSpec = TrainingSpec()) -> tuple[RidgeModel, DataFrame, DataFrame]:
    """Model, its one metrics row with diagnosis, and the score per penalty.

    ``scale_on="all"`` takes means and deviations from all rows, ``"train"`` from the
    training rows only.  ``collinear`` is for columns that nearly follow from others.
    """
    spark, rows = df.sparkSession, training_rows(df, spec)
    categories, numbers = cl.present(df, spec.categories), cl.present(df, spec.numbers)
    vocab = vocabulary(rows, categories, spec.max_values)
    columns = dummies(vocab, numbers)
    features = [*numbers, *columns]
    moments = fold_moments(rows, numbers, TARGET, "fold", vocab, Factors if spec.collinear else Moments)
    training = {k: m for k, m in moments.items() if k != HELD_OUT}
    basis = reduce(add, (moments if spec.scale_on == "all" else training).values())
    mean, std = basis.mean[:-1], basis.deviations()[:-1]
    scaled = {k: m.scaled(mean, std) for k, m in training.items()}
    scores = cross_validate(scaled, spec.alphas)
    alpha = best_alpha(scores)
    coef, intercept = reduce(add, scaled.values()).ridge(alpha)
    model = RidgeModel(tuple(
        Term(f, *columns.get(f, (f, None)), float(m), float(s), float(c))
        for f, m, s, c in zip(features, mean, std, coef)), intercept)
    return model, evaluate(rows, model, alpha), spark.createDataFrame(
        [(*s, s[0] == alpha) for s in scores],
        "alpha double, r2_mean double, r2_std double, chosen boolean")


def evaluate(rows: DataFrame, model: RidgeModel, alpha: float) -> DataFrame:
    """One row of alpha, test errors, R2 on both splits, their gap and the diagnosis."""
    per = regression_metrics(rows.withColumn("_pred", prediction(model)), TARGET, "_pred", ["split"])

    def pick(name: str, split: str):
        return F.max(F.when(F.col("split") == split, F.col(name)))

    return diagnose(per.agg(
        F.lit(float(alpha)).alias("alpha"), pick("mae", "test").alias("mae"),
        pick("rmse", "test").alias("rmse"), pick("r2", "train").alias("r2_train"),
        pick("r2", "test").alias("r2_test")))


def publish_model(df: DataFrame, model_path: str, metrics_path: str,
                  spec: TrainingSpec = TrainingSpec()) -> DataFrame:
    """Train, keep the model as a table and its metrics as a JSON document."""
    model, metrics, _ = train(df, spec)
    save_model(model, df.sparkSession, model_path)
    write_json_table(metrics, metrics_path)
    return read_json_table(df.sparkSession, metrics_path)


def score_layer(spark: SparkSession, homes: str, model: str, out: str,
                surface: str = "surface_habitable_logement") -> DataFrame:
    """Score a whole table of homes and write the result."""
    write_layer(score_homes(read_layer(spark, homes), load_model(spark, model), surface), out)
    return read_layer(spark, out)
