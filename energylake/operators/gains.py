"""Gains of moving a home from one class to a better one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energylake.fixed_values import ADJACENT_TRANSITIONS, PRICE_PER_KWH
from energylake.functions.columns import col, format_amount, transition_label
from energylake.operators.rows import filter_rows, join_small


def class_gains(df: DataFrame, cls: str, conso: str, surface: str, rank: Mapping[str, int],
                price: float = PRICE_PER_KWH) -> DataFrame:
    """One row per transition to a better class that both classes have homes for.

    ``conso`` is per square metre.  The table is read once, for the class means.
    These are at most ``len(rank)`` rows, so they meet in a single row, from which
    each class takes the means of its better classes; there is no join.
    """
    means = df.filter(col(cls).isin(list(rank))).groupBy(col(cls).alias("cls")).agg(
        F.avg(col(conso)).alias("conso"), F.avg(col(surface)).alias("surface"),
        F.count(F.lit(1)).alias("homes"))
    better = F.create_map(*[
        part for start in rank for part in (
            F.lit(start),
            F.array(*[F.lit(end) for end in rank if rank[end] < rank[start]]).cast("array<string>"))])
    met = means.agg(F.collect_list(F.struct("cls", "conso", "surface", "homes")).alias("starts"),
                    F.map_from_entries(F.collect_list(F.struct("cls", "conso"))).alias("conso_of"))
    pairs = (met.select("conso_of", F.explode("starts").alias("start"))
             .select("conso_of", "start.*", F.explode(F.element_at(better, F.col("start.cls"))).alias("end"))
             .filter(F.map_contains_key("conso_of", F.col("end")))
             .withColumn("after", F.element_at("conso_of", F.col("end"))))
    per_m2 = F.col("conso") - F.col("after")
    per_home = per_m2 * F.col("surface")
    return pairs.select(
        transition_label(F.col("cls"), F.col("end")).alias("transition"),
        F.col("cls").alias("classe_depart"), F.col("end").alias("classe_arrivee"),
        F.col("conso").alias("conso_moyenne_depart_kwh_m2"),
        F.col("after").alias("conso_moyenne_arrivee_kwh_m2"),
        per_m2.alias("gain_moyen_kwh_m2_an"), per_home.alias("gain_moyen_kwh_an"),
        (per_home * price).alias("gain_moyen_eur_an"),
        F.col("surface").alias("surface_moyenne_m2"), F.col("homes").alias("nb_logements"))


def adjacent_gains(gains: DataFrame,
                   transitions: Sequence[str] = ADJACENT_TRANSITIONS) -> DataFrame:
    """The steps to the next better class."""
    return filter_rows(gains, isin={"transition": transitions})


def gains_table(gains: DataFrame) -> DataFrame:
    """Gains as shown to readers."""
    return gains.select(
        F.col("transition").alias("Transition"),
        F.col("gain_moyen_kwh_m2_an").alias("kWh/m²/an"),
        format_amount(F.col("gain_moyen_kwh_an")).alias("kWh/an"),
        format_amount(F.col("gain_moyen_eur_an"), suffix=" €").alias("€/an"))


def estimate_savings(homes: DataFrame, gains: DataFrame, cls: str, surface: str,
                     target: str | Column, price: float = PRICE_PER_KWH,
                     bound: int | None = None) -> DataFrame:
    """Consumption before and after reaching ``target`` and the yearly saving, per home.

    Null where the home is in the target class already or the transition is not
    known.  ``bound`` is the largest possible number of gains rows, if known.
    """
    goal = F.lit(target) if isinstance(target, str) else target
    per_m2 = gains.select(
        "transition", F.col("conso_moyenne_depart_kwh_m2").alias("_before"),
        F.col("conso_moyenne_arrivee_kwh_m2").alias("_after"),
        F.col("gain_moyen_kwh_m2_an").alias("_gain"))
    out = join_small(homes.withColumn("transition", transition_label(col(cls), goal)),
                     per_m2, "transition", bound=bound)
    m2 = col(surface)
    return out.select(
        *homes.columns, "transition", (F.col("_before") * m2).alias("conso_actuelle_kwh_an"),
        (F.col("_after") * m2).alias("conso_apres_kwh_an"),
        (F.col("_gain") * m2).alias("gain_kwh_an"),
        (F.col("_gain") * m2 * price).alias("economie_eur_an"))
