"""Gains per class transition."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake.operators import gains as g
from energylake.queries.registry import query, table
from energylake.session import scratch_path
from energylake.sources.layers import read_json_table, write_json_table

RANK = {"A": 1, "N": 2, "R": 3}

GAINS_SQL = """with means as (
    select l_returnflag as cls, avg(l_extendedprice / l_quantity) as conso,
           avg(l_quantity) as surface, count(*) as n,
           case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as rank
    from lineitem group by 1),
gains as (
    select a.cls || '->' || b.cls as transition, a.cls as classe_depart,
           b.cls as classe_arrivee, a.conso as conso_moyenne_depart_kwh_m2,
           b.conso as conso_moyenne_arrivee_kwh_m2, a.conso - b.conso as gain_moyen_kwh_m2_an,
           (a.conso - b.conso) * a.surface as gain_moyen_kwh_an,
           (a.conso - b.conso) * a.surface * 0.2516::double as gain_moyen_eur_an,
           a.surface as surface_moyenne_m2, a.n as nb_logements
    from means a join means b on a.rank > b.rank)
"""


def _homes(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("conso"))


def _gains(spark, sf):
    return g.class_gains(_homes(spark, sf), "l_returnflag", "conso", "l_quantity", RANK)


def _rounded(df, digits=4):
    return df.select([F.round(n, digits).alias(n) if kind == "double" else n
                      for n, kind in df.dtypes])


ROUNDED_SQL = """select transition, classe_depart, classe_arrivee,
    round(conso_moyenne_depart_kwh_m2, 4) as conso_moyenne_depart_kwh_m2,
    round(conso_moyenne_arrivee_kwh_m2, 4) as conso_moyenne_arrivee_kwh_m2,
    round(gain_moyen_kwh_m2_an, 4) as gain_moyen_kwh_m2_an,
    round(gain_moyen_kwh_an, 4) as gain_moyen_kwh_an,
    round(gain_moyen_eur_an, 4) as gain_moyen_eur_an,
    round(surface_moyenne_m2, 4) as surface_moyenne_m2, nb_logements from gains"""


@query(GAINS_SQL + ROUNDED_SQL)
def class_gains(spark, sf):
    return _rounded(_gains(spark, sf))


@query(GAINS_SQL + ROUNDED_SQL)
def gains_document(spark, sf):
    """Written as the JSON document readers load, and loaded."""
    path = scratch_path(spark, "gains")
    write_json_table(_gains(spark, sf), path)
    return _rounded(read_json_table(spark, path))


@query(GAINS_SQL + ROUNDED_SQL + " where transition in ('R->N', 'N->A')")
def adjacent_gains(spark, sf):
    return _rounded(g.adjacent_gains(_gains(spark, sf), ["R->N", "N->A"]))


@query(GAINS_SQL + """select transition as Transition,
    round(gain_moyen_kwh_m2_an, 4) as "kWh/m²/an",
    format('{:,.0f}', gain_moyen_kwh_an) as "kWh/an",
    format('{:,.0f}', gain_moyen_eur_an) || ' €' as "€/an" from gains""")
def gains_table(spark, sf):
    return _rounded(g.gains_table(_gains(spark, sf)))


@query(GAINS_SQL + """select l_orderkey, l_linenumber, l_returnflag, l_quantity,
    l_returnflag || '->A' as transition,
    round(conso_moyenne_depart_kwh_m2 * l_quantity, 4) as conso_actuelle_kwh_an,
    round(conso_moyenne_arrivee_kwh_m2 * l_quantity, 4) as conso_apres_kwh_an,
    round(gain_moyen_kwh_m2_an * l_quantity, 4) as gain_kwh_an,
    round(gain_moyen_kwh_m2_an * l_quantity * 0.2516::double, 4) as economie_eur_an
    from lineitem left join gains on l_returnflag || '->A' = transition""")
def estimate_savings(spark, sf):
    homes = _homes(spark, sf).drop("conso")
    return _rounded(g.estimate_savings(
        homes, _gains(spark, sf), "l_returnflag", "l_quantity", "A",
        bound=len(RANK) * (len(RANK) - 1) // 2))
