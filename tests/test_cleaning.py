"""Cleaning rules on hand-made rows, and the whole bronze to silver to gold path."""

import json
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from energylake import fixed_values as fv
from energylake.operators import cleaning as cl
from energylake.plans import jobs
from energylake.session import scratch_path
from energylake.sources.layers import dwelling_schema, read_bronze, read_layer


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def numbered(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)


def test_labels(spark):
    df = numbered(spark, [("A",), ("G",), ("a",), (" B",), (None,), ("H",)], "c string")
    out = cl.encode_ordinal(df, "c", fv.CLASS_RANK)
    assert column(out, "c_num") == [1, 7, None, None, None, None]
    assert dict(out.dtypes)["c_num"] == "int" and column(out, "c")[2] == "a"


def test_insulation_words(spark):
    words = ["Insuffisante", "moyenne", "BONNE", "très bonne", "TRÈS BONNE", "tres bonne", "?", None]
    df = numbered(spark, [(w,) for w in words], "c string")
    out = cl.encode_ordinal(df, ["c"], fv.INSULATION_RANK, 0, lower=True)
    assert column(out, "c_num") == [1, 2, 3, 4, 4, 4, 0, 0]


def test_fill_zero_rounds_to_single(spark):
    df = numbered(spark, [(0.1, "2.5"), (None, "abc"), (3.0, None)], "a double, b string")
    out = cl.fill_zero(df, ["a", "b", "absent"])
    assert column(out, "a") == [0.10000000149011612, 0.0, 3.0]
    assert column(out, "b") == [2.5, 0.0, 0.0]


def test_impute_leaves_text_and_empty_columns(spark):
    df = numbered(spark, [(1.0, "x", None, 4), (None, None, None, None), (0.1, "y", None, 8),
                          (9.0, "z", None, 8)], "a double, b string, c double, d bigint")
    out = cl.impute_median(df, ["a", "b", "c", "d", "absent"], rel_err=0)
    assert column(out, "a") == [1.0, 1.0, 0.10000000149011612, 9.0]
    assert column(out, "b") == ["x", None, "y", "z"] and column(out, "c") == [None] * 4
    assert column(out, "d") == [4.0, 8.0, 8.0, 8.0]


def test_impute_exact_reads_text(spark):
    df = numbered(spark, [("1", 2.0), ("bad", 3.0), (None, 4.0), ("4", 5.0)], "a string, b double")
    out = cl.impute_median(df, ["a", "b"], exact=True)
    assert column(out, "a") == [1.0, 2.5, 2.5, 4.0] and column(out, "b") == [2.0, 3.0, 4.0, 5.0]


def test_clip(spark):
    df = numbered(spark, [(v, None) for v in [1.0, 2.0, 3.0, 4.0, 100.0, -50.0, None]],
                  "a double, none double")
    out = cl.clip_iqr(df, ["a", "none", "absent"], rel_err=0)
    # quartiles 1 and 4 of six values: bounds -3.5 and 8.5
    assert column(out, "a") == [1.0, 2.0, 3.0, 4.0, 8.5, -3.5, None]
    assert dict(out.dtypes)["a"] == "float"


def test_log(spark):
    df = numbered(spark, [(0.0,), (-2.0,), (-1.0,), (None,), (9.0,)], "a double")
    assert column(cl.log_transform(df, ["a"]), "a") == [0.0, None, None, None, math.log(10)]


def test_drop_columns_and_incomplete(spark):
    df = numbered(spark, [(1.0, "A"), (float("nan"), "B"), (2.0, None)], "a double, b string")
    assert column(cl.drop_incomplete(df, ["a", "b"]), "i") == [0]
    assert cl.drop_columns(df, ["a", "nothing"]).columns == ["i", "b"]
    with pytest.raises(AnalysisException):
        cl.drop_incomplete(df, ["absent"])


RECORDS = [
    dict(numero_dpe="x1", etiquette_dpe="D", etiquette_ges="E", conso_5_usages_ef=9000.0,
         surface_habitable_logement=90.0, cout_total_5_usages=1500.0, annee_construction=1974,
         qualite_isolation_murs="Très bonne", logement_traversant=True,
         conso_ecs_ef_energie_n2=99.0, hauteur_sous_plafond=2.5, type_batiment="Maison"),
    dict(etiquette_dpe="G", etiquette_ges="a", conso_5_usages_ef=20000.0,
         surface_habitable_logement=0.0, cout_total_5_usages=4000.0, annee_construction=1989.5,
         qualite_isolation_murs="inconnue", logement_traversant=None, hauteur_sous_plafond=None),
    dict(etiquette_dpe="B", conso_5_usages_ef=5000.0, surface_habitable_logement=50.0,
         cout_total_5_usages=700.0, annee_construction=2013, hauteur_sous_plafond=2.7),
    dict(etiquette_dpe=None, conso_5_usages_ef=1.0, surface_habitable_logement=1.0,
         cout_total_5_usages=1.0),
    dict(etiquette_dpe="C", conso_5_usages_ef=None, surface_habitable_logement=1.0,
         cout_total_5_usages=1.0),
]


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    for day, records in (("2026-03-05", RECORDS[:3]), ("2026-03-06", RECORDS[3:])):
        folder = root / f"date={day}"
        folder.mkdir()
        lines = [json.dumps(r, ensure_ascii=False) for r in records]
        (folder / "a.json").write_text("\n".join([*lines, "{broken"]), "utf-8")
    return str(root)


def test_bronze_schema_and_corrupt_lines(spark, bronze):
    df = read_bronze(spark, bronze, dwelling_schema(), keep_corrupt=True)
    assert dict(df.dtypes)["date"] == "date"
    assert df.count() == 7
    assert {r["_corrupt_record"] for r in df.collect()} == {None, "{broken"}
    inferred = read_bronze(spark, bronze)
    assert "numero_dpe" in inferred.columns and inferred.count() == 7


@pytest.mark.parametrize("declared", [True, False])
def test_bronze_to_gold(spark, bronze, declared):
    silver, gold, staging = (scratch_path(spark, n) for n in ("silver", "gold", "staging"))
    report = jobs.bronze_to_silver(spark, bronze, silver, staging,
                                   schema=dwelling_schema() if declared else None)
    assert [(r["etiquette_dpe"], r["count"], r["rows_in"], r["rows_dropped"], r["rows_out"])
            for r in report.collect()] == [("B", 1, 7, 4, 3), ("D", 1, 7, 4, 3), ("G", 1, 7, 4, 3)]
    assert {r["columns_out"] for r in report.collect()} == {
        len(read_layer(spark, silver).columns)}
    out = {r["etiquette_dpe"]: r for r in jobs.silver_to_gold(spark, silver, gold).collect()}
    assert [out[k]["etiquette_dpe_num"] for k in "BDG"] == [2, 4, 7]
    assert [out[k]["etiquette_ges_num"] for k in "BDG"] == [None, 5, None]
    assert [out[k]["qualite_isolation_murs_num"] for k in "BDG"] == [0, 4, 0]
    assert [out[k]["logement_traversant"] for k in "BDG"] == [0, 1, 0]
    assert out["D"]["conso_ecs_ef_energie_n2"] == math.log1p(99.0)
    assert out["G"]["conso_ecs_ef_energie_n2"] == 0.0
    assert out["G"]["hauteur_sous_plafond"] == 2.5
    assert [out[k]["periode_construction"] for k in "BDG"] == [
        "Après 2012 (RT2012)", "Avant 1975", "Après 2012 (RT2012)"]
    assert out["G"]["conso_calculee_par_m2"] is None
    assert out["D"]["conso_calculee_par_m2"] == pytest.approx(100.0)
    assert str(out["D"]["date"]) == "2026-03-05"
    assert "numero_dpe" not in read_layer(spark, silver).columns


def test_clean_is_the_same_as_the_staged_job(spark, bronze):
    rows = read_bronze(spark, bronze, dwelling_schema())
    silver = scratch_path(spark, "silver")
    jobs.bronze_to_silver(spark, bronze, silver, scratch_path(spark, "staging"),
                          schema=dwelling_schema())
    direct, staged = jobs.clean(rows), read_layer(spark, silver)
    assert sorted(direct.columns) == sorted(staged.columns)
    assert direct.select(sorted(direct.columns)).exceptAll(
        staged.select(sorted(direct.columns))).isEmpty()


def test_cleaning_reads_the_rows_twice_before_the_write(spark, bronze):
    """All medians are one pass and all quartiles one pass, however many columns.

    A pass shows as three jobs, its scan stage and the two merges of the sketches.
    """
    rows = read_bronze(spark, bronze, dwelling_schema())
    group = "count-jobs"
    spark.sparkContext.setJobGroup(group, group)
    jobs.clean(rows)
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(found) <= 6, found


def test_gold_replaces_the_source_periods(spark):
    df = spark.createDataFrame([(1980.0, "1978-1982", 10.0, 2.0)],
                               "annee_construction double, periode_construction string, "
                               "conso_5_usages_ef double, surface_habitable_logement double")
    row = jobs.prepare_gold(df).first()
    assert row["periode_construction"] == "1975-1989" and row["conso_calculee_par_m2"] == 5.0


def test_present(spark):
    df = spark.range(1).withColumn("b", F.lit(1))
    assert cl.present(df, ["b", "c", "id"]) == ["b", "id"]
