"""Aggregates on hand-made rows, nulls included."""

import pytest
from pyspark.sql import functions as F

from energylake.operators import gains as g
from energylake.operators import metrics as m
from energylake.plans.dashboard import OverviewSpec, overview, selected_homes


@pytest.fixture(scope="module")
def homes(spark):
    return spark.createDataFrame(
        [("B", 1.0, "x"), ("A", 2.0, "x"), ("B", 4.0, "y"), (None, 8.0, "y"), ("C", None, None)],
        "c string, v double, area string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_distribution_with_and_without_null(homes):
    assert rows(m.class_distribution(homes, "c")) == [(None, 1), ("A", 1), ("B", 2), ("C", 1)]
    assert rows(m.class_distribution(homes, "c", skip_null=True)) == [("A", 1), ("B", 2), ("C", 1)]


def test_mean_by_skips_null_keys_and_follows_an_order(homes):
    assert rows(m.mean_by(homes, "c", "v")) == [("A", 2.0), ("B", 2.5), ("C", None)]
    assert rows(m.mean_by(homes, "c", "v", order=["B", "Z", "A"])) == [("B", 2.5), ("A", 2.0)]


def test_kpis_and_bounds(spark, homes):
    assert rows(m.kpis(homes, {"mean": "v"})) == [(5, 3.75)]
    df = spark.createDataFrame([(-2.7,), (9.9,), (None,)], "v double")
    assert rows(m.bounds(df, "v")) == [(-2, 9)]


def test_share(homes):
    assert rows(m.share_by(homes, "c")) == [("B", 2, 50.0), ("A", 1, 25.0), ("C", 1, 25.0)]


def test_profile(homes):
    found = {(r["feature"], r["rank"]): (r["value"], r["count"], r["distinct_values"])
             for r in m.profile_categories(homes, ["c", "area"], k=2).collect()}
    assert found == {("c", 1): ("B", 2, 3), ("c", 2): ("A", 1, 3),
                     ("area", 1): ("x", 2, 2), ("area", 2): ("y", 2, 2)}


def test_profile_ranks_below_the_shuffle(homes):
    plan = m.profile_categories(homes, ["c", "area"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_frequent_values_as_in_the_full_profile(spark, homes):
    for df, cols in ((homes, ["c", "area"]), (homes.limit(0), ["c"]),
                     (spark.range(60_000).selectExpr("id % 5 as a", "id as b", "null as n"), ["a", "b", "n"])):
        full, found = (sorted(map(tuple, f(df, cols).select(
            "feature", "value", "count", "rank", "distinct_values").collect()))
            for f in (m.profile_categories, m.profile_frequent))
        assert found == full


def test_frequent_values_among_many_rare_ones(spark, monkeypatch):
    def full(*_):
        raise AssertionError("not needed")

    monkeypatch.setattr(m, "profile_categories", full)
    df = spark.range(200_000).selectExpr(
        "case when id % 10 < 4 then 'x' when id % 10 = 4 then 'y' when id % 20 = 5 then 'z' else cast(id as string) end as v")
    found = sorted(map(tuple, m.profile_frequent(df, ["v"]).select("rank", "value", "count").collect()))
    assert found == [(1, "x", 80_000), (2, "y", 20_000), (3, "z", 10_000)]
    distinct = m.profile_frequent(df, ["v"]).first()["distinct_values"]
    assert abs(distinct / 90_003 - 1) < 0.05


def test_report(homes):
    assert rows(m.cleaning_report(homes, ["c", "v"], "c")) == [
        ("A", 1, 5, 2, 3), ("B", 2, 5, 2, 3)]


def test_dominant_class_breaks_ties_by_label(homes):
    found = {r["area"]: (r["dominant"], r["rows"], r["good_percent"])
             for r in m.dominant_by_area(homes, "area", "c").collect()}
    assert found == {"x": ("A", 2, 50.0), "y": ("B", 1, 100.0)}


def test_regression_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0, "a"), (1.0, 1.0, "a"), (1.0, 2.0, "b"), (1.0, 1.0, "b")],
                               "y double, p double, s string")
    found = {r["s"]: r["r2"] for r in m.regression_metrics(df, "y", "p", ["s"]).collect()}
    assert found == {"a": 1.0, "b": 0.0}


def test_target_summary(homes):
    assert rows(m.target_summary(homes, "v")) == [(4, 3.0, 1.0, 8.0)]
    assert rows(m.target_summary(homes, "v", rel_err=0.01)) == [(4, 2.0, 1.0, 8.0)]


def test_overview_reads_the_table_once_and_skips_missing_labels(spark):
    df = spark.createDataFrame(
        [("A", "Maison", "p", 10.0, 50.0, 1.0), ("B", None, "p", None, 70.0, 3.0),
         ("A", "Maison", "q", 30.0, 60.0, None), (None, "Studio", "q", 50.0, 20.0, 2.0)],
        "c string, t string, p string, conso double, surface double, cost double")
    spec = OverviewSpec("c", "t", "p", "conso", "surface", "cost")
    out = overview(df, spec)
    assert out._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    found = {(r["panel"], r["label"]): tuple(r)[2:] for r in out.collect()}
    assert found[("all", None)] == (4, 100.0, 30.0, 50.0, 2.0)
    assert found[("class", "A")][:3] == (2, pytest.approx(200 / 3), 20.0)
    assert found[("class", "B")][2] is None
    assert set(found) == {("all", None), ("class", "A"), ("class", "B"), ("type", "Maison"),
                          ("type", "Studio"), ("period", "p"), ("period", "q")}
    assert overview(selected_homes(df, spec, ["A"], (55, 100)), spec).where("panel = 'all'").first()["homes"] == 1


GOLDEN = [("F->E", 380, 290, 90, 6480, 1620), ("E->D", 290, 210, 80, 5760, 1440),
          ("D->C", 210, 130, 80, 5760, 1440), ("C->B", 130, 75, 55, 3960, 990),
          ("F->B", 380, 75, 305, 21960, 5490)]
RANK = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}


@pytest.fixture(scope="module")
def gains(spark):
    means = {"B": 75, "C": 130, "D": 210, "E": 290, "F": 380}
    homes = [(c, float(v + d), 72.0) for c, v in means.items() for d in (-10, 10)] + [
        ("?", 1.0, 1.0), (None, 1.0, 1.0)]
    return g.class_gains(spark.createDataFrame(homes, "c string, v double, s double").repartition(5),
                         "c", "v", "s", RANK, price=0.25)


def test_golden_gains(gains):
    found = {r["transition"]: r for r in gains.collect()}
    assert len(found) == 10
    for label, before, after, per_m2, per_home, euros in GOLDEN:
        r = found[label]
        assert (r["classe_depart"], r["classe_arrivee"]) == tuple(label.split("->"))
        assert [r["conso_moyenne_depart_kwh_m2"], r["conso_moyenne_arrivee_kwh_m2"],
                r["gain_moyen_kwh_m2_an"], r["gain_moyen_kwh_an"], r["gain_moyen_eur_an"],
                r["surface_moyenne_m2"], r["nb_logements"]] == pytest.approx(
                    [before, after, per_m2, per_home, euros, 72, 2])


def test_gains_read_the_table_once(gains):
    plan = gains._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1 and "Join" not in plan.toString()


def test_adjacent_and_table(gains):
    steps = g.adjacent_gains(gains)
    assert {r[0] for r in steps.collect()} == {"F->E", "E->D", "D->C", "C->B"}
    shown = {r["Transition"]: tuple(r)[1:] for r in g.gains_table(gains).collect()}
    assert shown["F->B"] == (305.0, "21,960", "5,490 €")


@pytest.mark.parametrize("bound", [None, 21])
def test_savings(spark, gains, bound):
    homes = spark.createDataFrame([(1, "F", 100.0), (2, "B", 50.0), (3, "A", 10.0), (4, None, 10.0)],
                                  "id int, c string, s double")
    out = {r["id"]: r for r in g.estimate_savings(homes, gains, "c", "s", "B", 0.2, bound).collect()}
    assert out[1]["gain_kwh_an"] == 30500.0 and out[1]["economie_eur_an"] == pytest.approx(6100.0)
    assert (out[1]["conso_actuelle_kwh_an"], out[1]["conso_apres_kwh_an"]) == (38000.0, 7500.0)
    assert [out[i]["gain_kwh_an"] for i in (2, 3, 4)] == [None] * 3
    own = g.estimate_savings(homes.withColumn("goal", F.lit("C")), gains, "c", "s", F.col("goal"))
    assert own.where("id = 1").first()["gain_kwh_an"] == 25000.0
