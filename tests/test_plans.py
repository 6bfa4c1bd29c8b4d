"""Plans that must hold at any size, for every registered query."""

import pytest

from __spark_entry__ import queries
from energylake.__main__ import parser
from energylake.session import scratch_path

DATA = "/root/testdata/sf0.001"
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
        "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", list(queries()))
def test_no_pairwise_join_and_no_python_rows(spark, name):
    plan = queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in SLOW if step in plan]
    assert "SinglePartition" not in plan or "partial_" in plan or "Subquery" in plan


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = queries()["filtered_kpis"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for pushed in ("In(l_returnflag, [A,R])", "GreaterThanOrEqual(l_quantity,5.0)",
                   "LessThanOrEqual(l_quantity,40.0)", "EqualTo(l_linestatus,O)"):
        assert pushed in plan
    assert "l_orderkey" not in plan.split("ReadSchema")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_command_line_stages_work_together(spark, tmp_path, capsys):
    import json
    import random

    random.seed(1)
    bronze = tmp_path / "bronze" / "date=2026-03-05"
    bronze.mkdir(parents=True)
    classes = {"B": 75, "C": 130, "D": 210, "E": 290, "F": 380}
    with open(bronze / "a.json", "w", encoding="utf-8") as out:
        for i in range(400):
            label = random.choice("BCDEF")
            surface = random.randint(20, 150)
            conso = classes[label] + random.gauss(0, 10)
            out.write(json.dumps({
                "etiquette_dpe": label, "conso_5_usages_par_m2_ef": conso,
                "conso_5_usages_ef": conso * surface, "surface_habitable_logement": surface,
                "cout_total_5_usages": conso * surface * 0.2, "annee_construction": 1950 + i % 70,
                "type_batiment": random.choice(["Maison", "Appartement"]),
                "type_energie_principale_chauffage": "Gaz" if label in "EF" else "Bois",
                "hauteur_sous_plafond": 2.5 + i % 3 / 10, "nombre_niveau_logement": 1 + i % 4}) + "\n")

    place = {n: scratch_path(spark, n) for n in
             ("silver", "staging", "gold", "gains", "model", "metrics", "scored", "export")}

    def run(*argv):
        args = parser().parse_args(argv)
        args.run(spark, args)

    run("clean", "--bronze", str(tmp_path / "bronze"), "--silver", place["silver"],
        "--staging", place["staging"])
    run("gold", "--silver", place["silver"], "--gold", place["gold"], "--gains", place["gains"])
    run("train", "--gold", place["gold"], "--model", place["model"], "--metrics", place["metrics"])
    run("score", "--homes", place["gold"], "--model", place["model"], "--out", place["scored"])
    run("export", "--gold", place["gold"], "--out", place["export"])
    run("show", "--gold", place["gold"], "--classes", "B", "C", "--surface", "20", "60")
    shown = capsys.readouterr().out
    assert "|class |B " in shown and "|class |F " not in shown
    run("show", "--gold", place["gold"], "--classes", "A")
    assert "no home passes" in capsys.readouterr().out
    gains = spark.read.option("multiLine", True).json(place["gains"])
    assert gains.count() == 10 and gains.where("gain_moyen_kwh_m2_an > 0").count() == 10
    metrics = spark.read.option("multiLine", True).json(place["metrics"]).first()
    assert metrics["r2_test"] > 0.5 and metrics["alpha"] in (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
    scored = spark.read.parquet(place["scored"])
    assert scored.count() == 400 and scored.where("conso_predite_m2 is null").isEmpty()
    assert spark.read.parquet(place["export"]).where("periode_construction = ''").isEmpty()
