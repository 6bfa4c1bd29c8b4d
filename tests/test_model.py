"""Regression against numpy and Spark ML; scoring; the whole training job."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from energylake.fixed_values import ALPHAS
from energylake.operators import features as f
from energylake.operators import ridge, scoring
from energylake.operators.metrics import regression_metrics
from energylake.plans.jobs import TARGET, TrainingSpec, train, training_rows
from energylake.session import scratch_path

N = 600


def arrays(shift=0.0):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(N, 3)) * [1, 5, 0.1] + [shift, 3, -1]
    y = x @ [2.0, -1.0, 7.0] + 50 + rng.normal(size=N)
    return x, y, np.arange(N) % 5


def frame(spark, x, y, folds, parts=6):
    rows = [(*map(float, a), float(b), int(k)) for a, b, k in zip(x, y, folds)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(parts)


def solve(x, y, alpha):
    mean, centred = x.mean(axis=0), x - x.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    return w, y.mean() - w @ mean


def r2(x, y, w, b):
    return 1 - ((y - x @ w - b) ** 2).sum() / ((y - y.mean()) ** 2).sum()


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_fit_matches_numpy(spark, shift):
    x, y, folds = arrays(shift)
    got = {r["feature"]: r["coef"] for r in ridge.fit_ridge(
        frame(spark, x, y, folds), ["a", "b", "c"], "y", 10.0).collect()}
    w, b = solve(x, y, 10.0)
    assert [got["a"], got["b"], got["c"]] == pytest.approx(w, rel=1e-9)
    assert got["(intercept)"] == pytest.approx(b, rel=1e-9)


def test_fit_matches_spark_ml(spark):
    x, y, folds = arrays()
    df, alpha = frame(spark, x, y, folds), 10.0
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    ml = LinearRegression(featuresCol="v", labelCol="y", elasticNetParam=0.0, standardization=False,
                          solver="normal", regParam=alpha * float(np.std(y)) / N).fit(vectors)
    got = {r["feature"]: r["coef"] for r in ridge.fit_ridge(df, ["a", "b", "c"], "y", alpha).collect()}
    assert [got[k] for k in "abc"] == pytest.approx(list(ml.coefficients), rel=1e-6)


def test_moments_far_from_zero_and_in_any_order(spark):
    """A first part of the rows that lies far off does no harm, nor does their order."""
    x, y, folds = arrays()
    x[:50] += 1e6
    near = ridge.fold_moments(frame(spark, x, y, folds), ["a", "b", "c"], "y", "fold")
    back = ridge.fold_moments(frame(spark, x[::-1], y[::-1], folds[::-1], 1), ["a", "b", "c"], "y", "fold")
    for k in range(5):
        rows = np.column_stack([x, y])[folds == k]
        centred = rows - rows.mean(axis=0)
        for found in (near[k], back[k]):
            assert found.n == len(rows)
            np.testing.assert_allclose(found.mean, rows.mean(axis=0), rtol=1e-12)
            np.testing.assert_allclose(found.scatter, centred.T @ centred, rtol=1e-7, atol=1e-3)


def test_factors_agree_with_products(spark):
    x, y, folds = arrays()
    df = frame(spark, x, y, folds, 7)
    products, factors = (ridge.fold_moments(df, ["a", "b", "c"], "y", "fold", kind=k)
                         for k in (ridge.Moments, ridge.Factors))
    for k, m in products.items():
        f = factors[k]
        np.testing.assert_allclose(f.root.T @ f.root, m.scatter, rtol=1e-9, atol=1e-9 * np.abs(m.scatter).max())
        np.testing.assert_allclose(f.deviations(), m.deviations(), rtol=1e-9)
        np.testing.assert_allclose(f.ridge(2.0)[0], m.ridge(2.0)[0], rtol=1e-8)
        assert f.r2(*f.ridge(2.0)) == pytest.approx(m.r2(*m.ridge(2.0)), abs=1e-9)
    np.testing.assert_allclose(ridge.cross_validate(factors, [0.1, 10]), ridge.cross_validate(products, [0.1, 10]))


def test_factors_keep_the_digits_of_nearly_collinear_columns(spark):
    random = np.random.default_rng(8)
    a, b = random.normal(size=(2, 3000))
    x, y = np.column_stack([a, a + 1e-6 * b, random.normal(size=3000)]), 2 * a + 3 * b + random.normal(size=3000)
    df = frame(spark, x, y, np.zeros(3000, int), 6)
    want = np.linalg.lstsq(np.column_stack([x - x.mean(axis=0)]), y - y.mean(), rcond=None)[0]
    off = {k: np.abs(ridge.fold_moments(df, ["a", "b", "c"], "y", kind=k)[0].ridge(0)[0] / want - 1).max()
           for k in (ridge.Factors, ridge.Moments)}
    assert off[ridge.Factors] < 1e-8 < off[ridge.Moments]


def test_factors_of_few_rows_and_a_constant_target(spark):
    few = ridge.Factors.of(np.array([[1.0], [5.0]])) + ridge.Factors.of(np.array([[3.0, 2.0], [5.0, 5.0]]))
    assert few.n == 3 and few.mean.tolist() == [2.0, 5.0] and few.root.shape == (2, 2)
    assert few.r2(np.array([0.0]), 5.0) == 1.0 and few.r2(np.array([1.0]), 4.0) == 0.0


def test_the_driver_gets_one_row_per_fold(spark):
    x, y, folds = arrays()
    df = frame(spark, x, y, folds, 16)
    sent = []
    collect = type(df).collect

    def counted(self):
        rows = collect(self)
        sent.append(len(rows))
        return rows

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(df), "collect", counted)
        ridge.fold_moments(df, ["a", "b", "c"], "y", "fold")
    assert sent == [5]


def test_constant_targets_and_nan_scores():
    flat = ridge.Moments(4, np.array([1.0, 5.0]), np.array([[2.0, 0.0], [0.0, 0.0]]))
    assert flat.r2(np.array([0.0]), 5.0) == 1.0 and flat.r2(np.array([1.0]), 4.0) == 0.0
    assert ridge.best_alpha([(0.1, float("nan"), 0), (1.0, -2.0, 0)]) == 1.0


def test_dummies_of_clashing_names(spark):
    df = spark.createDataFrame([("a", "a", 9.0), ("y_z", "a", 9.0), ("a", "z", 9.0)],
                               "x string, x_y string, X_Y_Z_2 double")
    out = f.one_hot(df, ["x", "x_y"])
    assert out.columns == ["X_Y_Z_2", "x_y_z", "x_y_z_3"]
    assert [tuple(r) for r in out.collect()] == [(9, 0, 0), (9, 1, 0), (9, 0, 1)]


def test_nulls_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, y double")
    with pytest.raises(ValueError, match="null"):
        ridge.fit_ridge(df, ["a"], "y", 1.0)


def test_cross_validation_matches_brute_force(spark):
    x, y, folds = arrays()
    got = ridge.select_alpha(frame(spark, x, y, folds), ["a", "b", "c"], "y", ALPHAS, "fold").collect()
    best = None
    for row, alpha in zip(got, ALPHAS):
        scores = [r2(x[folds == k], y[folds == k], *solve(x[folds != k], y[folds != k], alpha))
                  for k in range(5)]
        assert row["alpha"] == alpha
        assert row["r2_mean"] == pytest.approx(np.mean(scores), abs=1e-10)
        assert row["r2_std"] == pytest.approx(np.std(scores), abs=1e-10)
        if best is None or np.mean(scores) > best[0]:
            best = np.mean(scores), alpha
    assert [r["alpha"] for r in got if r["chosen"]] == [best[1]]


def test_first_alpha_wins_a_tie():
    assert ridge.best_alpha([(0.1, 0.5, 0), (1.0, 0.7, 0), (10.0, 0.7, 0)]) == 1.0


def test_one_hot_and_scaler(spark):
    df = spark.createDataFrame([("b", 1.0, 4.0), ("a", 3.0, 4.0), ("c", 5.0, 4.0), ("b", 7.0, 4.0)],
                               "k string, x double, flat double")
    out = f.one_hot(df, ["k"])
    assert out.columns == ["x", "flat", "k_b", "k_c"]
    assert [tuple(r) for r in out.select("k_b", "k_c").collect()] == [(1, 0), (0, 0), (0, 1), (1, 0)]
    scaler = f.fit_scaler(out, ["x", "flat"])
    assert scaler == {"x": (4.0, pytest.approx(5 ** 0.5)), "flat": (4.0, 1.0)}
    assert [r["flat"] for r in f.apply_scaler(out, scaler).collect()] == [0.0] * 4


def test_too_many_categories_are_refused(spark, monkeypatch):
    monkeypatch.setattr(f, "MAX_VALUES", 5)
    with pytest.raises(ValueError, match="category values"):
        f.vocabulary(spark.range(10).select(F.col("id").cast("string").alias("k")), ["k"])
    assert len(f.vocabulary(spark.range(10), ["id"], most=10)["id"]) == 10


HOMES = TrainingSpec(categories=("type", "zone", "absent"), numbers=("height",), conso="conso",
                     surface="surface")


@pytest.fixture(scope="module")
def homes(spark):
    rng = np.random.default_rng(5)
    n = 3000
    kind, zone = rng.choice(["Maison", "Appartement", None], n), rng.choice(["H1", "H2", "H3"], n)
    height = np.where(rng.uniform(size=n) < 0.1, None, rng.normal(2.5, 0.3, n).round(2))
    per_m2 = 200 + 60 * (kind == "Maison") - 40 * (zone == "H3") + rng.normal(0, 20, n)
    surface = rng.integers(0, 120, n).astype(float)
    rows = [(k, z, None if h is None else float(h), float(p * s), float(s))
            for k, z, h, p, s in zip(kind, zone, height, per_m2, surface)]
    return spark.createDataFrame(
        rows, "type string, zone string, height double, conso double, surface double").repartition(4)


@pytest.fixture(scope="module")
def trained(homes):
    return train(homes, HOMES)


@pytest.mark.parametrize("scale_on", ["all", "train"])
def test_training_matches_numpy_end_to_end(homes, scale_on):
    spec = TrainingSpec(**{**HOMES.__dict__, "scale_on": scale_on})
    model, metrics, scores = train(homes, spec)
    rows = training_rows(homes, spec).toPandas()
    assert rows["height"].notna().all() and (rows[TARGET] > 10).all()
    names = ["height", "type_Inconnu", "type_Maison", "zone_H2", "zone_H3"]
    assert [t.feature for t in model.terms] == names
    x = np.column_stack([rows["height"], rows["type"] == "Inconnu", rows["type"] == "Maison",
                         rows["zone"] == "H2", rows["zone"] == "H3"]).astype(float)
    y, is_train, folds = rows[TARGET].to_numpy(), (rows["split"] == "train").to_numpy(), rows["fold"].to_numpy()
    basis = x if scale_on == "all" else x[is_train]
    z = (x - basis.mean(axis=0)) / basis.std(axis=0)
    results = []
    for alpha in ALPHAS:
        results.append(np.mean([
            r2(z[folds == k], y[folds == k],
               *solve(z[is_train & (folds != k)], y[is_train & (folds != k)], alpha))
            for k in range(5)]))
    assert [r["r2_mean"] for r in scores.collect()] == pytest.approx(results, abs=1e-9)
    alpha = ALPHAS[int(np.argmax(results))]
    w, b = solve(z[is_train], y[is_train], alpha)
    assert [t.coef for t in model.terms] == pytest.approx(w, rel=1e-8)
    assert model.intercept == pytest.approx(b, rel=1e-10)
    row = metrics.first()
    error = y - z @ w - b
    assert row["alpha"] == alpha
    assert row["mae"] == pytest.approx(np.abs(error[~is_train]).mean(), rel=1e-9)
    assert row["rmse"] == pytest.approx(np.sqrt((error[~is_train] ** 2).mean()), rel=1e-9)
    assert row["r2_train"] == pytest.approx(r2(z[is_train], y[is_train], w, b), abs=1e-9)
    assert row["r2_test"] == pytest.approx(r2(z[~is_train], y[~is_train], w, b), abs=1e-9)
    assert row["diagnosis"] == "healthy" and row["gap"] == row["r2_train"] - row["r2_test"]


def test_training_does_not_depend_on_partitions(homes, trained):
    again, _, _ = train(homes.repartition(1), HOMES)
    assert [t.coef for t in again.terms] == pytest.approx([t.coef for t in trained[0].terms], rel=1e-9)


def test_score_uses_categories_as_trained(spark, trained):
    model = trained[0]
    by_name = {t.feature: t for t in model.terms}

    def by_hand(height, *on):
        return model.intercept + sum(
            t.coef * ((height if n == "height" else float(n in on)) - t.mean) / t.std
            for n, t in by_name.items())

    homes = spark.createDataFrame(
        [(0, "Maison", "H3", 2.5, 100.0), (1, "Appartement", "H1", 2.5, 100.0),
         (2, "Chateau", "H9", 2.5, 100.0), (3, None, "H2", 2.5, 10.0), (4, "Maison", "H3", None, 1.0)],
        "i int, type string, zone string, height double, surface double")
    got = [r["conso_predite_m2"] for r in scoring.score(homes, model).orderBy("i").collect()]
    assert got[:4] == pytest.approx([
        by_hand(2.5, "type_Maison", "zone_H3"), by_hand(2.5), by_hand(2.5),
        by_hand(2.5, "type_Inconnu", "zone_H2")], rel=1e-12)
    assert got[4] is None
    out = scoring.score_homes(homes, model, "surface", price=0.5).orderBy("i").first()
    assert out["conso_totale_kwh_an"] == pytest.approx(out["conso_predite_m2"] * 100)
    assert out["cout_annuel_eur"] == pytest.approx(out["conso_predite_m2"] * 50)
    assert out["classe_predite"] in "DE" and out["couleur"] in ("#FFCC00", "#FF9900")


def test_categories_that_are_numbers_and_infinite_inputs(spark):
    rows = [(i % 3, float("inf") if i % 10 == 0 else float(i % 7), (100.0 + 20 * (i % 3)) * 50, 50.0)
            for i in range(300)]
    df = spark.createDataFrame(rows, "zone int, height double, conso double, surface double")
    model, metrics, _ = train(df, HOMES)
    assert [t.feature for t in model.terms] == ["height", "zone_1", "zone_2"]
    assert metrics.first()["r2_test"] > 0.99
    got = scoring.score(df.limit(3), model).collect()
    assert [r["conso_predite_m2"] for r in got[1:]] == pytest.approx([120, 140], abs=1)


def test_score_is_floored_and_capped(spark):
    model = scoring.RidgeModel((scoring.Term("x", "x", None, 0.0, 1.0, 1.0),), 0.0)
    df = spark.createDataFrame([(-5.0, 1.0), (70.0, 1.0), (900.0, 2.0)], "x double, s double")
    out = scoring.score_homes(df, model, "s").collect()
    assert [r["conso_predite_m2"] for r in out] == [0.0, 70.0, 900.0]
    assert [r["classe_predite"] for r in out] == ["A", "B", "G"]
    assert [r["position_echelle"] for r in out] == [0.0, 70.0, 500.0]


def test_model_survives_saving(spark, trained):
    path = scratch_path(spark, "model")
    scoring.save_model(trained[0], spark, path)
    assert scoring.load_model(spark, path) == trained[0]


def test_compare_to_class_means_given_as_mapping_or_table(spark):
    df = spark.createDataFrame([("B", 80.0), ("A", 10.0)], "c string, p double")
    got = {r["c"]: r["ecart_moyenne"] for r in scoring.compare_to_class(df, "c", "p", {"B": 75.0}).collect()}
    assert got == {"B": 5.0, "A": None}
    means = spark.createDataFrame([("B", 75.0)], "c string, mean double")
    assert {r["c"]: r["ecart_moyenne"] for r in scoring.compare_to_class(df, "c", "p", means).collect()} == got


def test_ranked_coefficients(spark):
    coefs = spark.createDataFrame(
        [("a", 10.0), ("b", -20.0), ("c", 1.0), ("d", 0.0), ("e", 4.9), ("f", -0.5)],
        "feature string, coef double")
    got = [tuple(r) for r in scoring.rank_coefficients(coefs, k=2).orderBy("direction", "rank").collect()]
    assert got == [("b", -20.0, "down", 1, 20), ("f", -0.5, "down", 2, 0),
                   ("a", 10.0, "up", 1, 10), ("e", 4.9, "up", 2, 4)]


def test_diagnosis_order(spark):
    rows = [(0.99, 0.96), (0.9, 0.7), (0.6, 0.45), (0.5, 0.49), (0.7, 0.6)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, r2_train double, r2_test double")
    assert [r["diagnosis"] for r in scoring.diagnose(df).orderBy("i").collect()] == [
        "too_high", "overfit", "overfit" if 0.6 - 0.45 > 0.15 else "moderate", "moderate", "healthy"]


def test_metrics_frame(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"]) == (
        pytest.approx(2 / 3), pytest.approx((2 / 3) ** 0.5), pytest.approx(0.75))
