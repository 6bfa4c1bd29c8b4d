"""All figures of the overview page from one scan.

The filtered homes are first summed per (class, building type, period).  That is a
table of at most a few hundred rows, from which counts, shares and means by each of
the three, and in all, are taken together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from energylake.functions.columns import col
from energylake.operators.rows import filter_rows


@dataclass(frozen=True)
class OverviewSpec:
    """Columns of the homes table."""

    cls: str = "etiquette_dpe"
    kind: str = "type_batiment"
    period: str = "periode_construction"
    conso: str = "conso_5_usages_par_m2_ef"
    surface: str = "surface_habitable_logement"
    cost: str = "cout_total_5_usages"


PANELS = ["class", "type", "period"]
MEASURES = ["conso", "surface", "cost"]


def selected_homes(df: DataFrame, spec: OverviewSpec = OverviewSpec(),
                   classes: Sequence[str] | None = None,
                   surfaces: tuple[float, float] | None = None,
                   kinds: Sequence[str] | None = None) -> DataFrame:
    """Homes that pass the page's three filters; an absent filter keeps all."""
    isin = {c: v for c, v in ((spec.cls, classes), (spec.kind, kinds)) if v is not None}
    return filter_rows(df, isin, {} if surfaces is None else {spec.surface: surfaces})


def overview(homes: DataFrame, spec: OverviewSpec = OverviewSpec()) -> DataFrame:
    """Rows (panel, label) with the number of homes, its percentage and three means.

    Panel ``all`` has one row; a home without a label is in ``all`` only, and
    percentages are of the homes that have one.
    """
    keys = dict(zip(PANELS, (spec.cls, spec.kind, spec.period)))
    measures = dict(zip(MEASURES, (spec.conso, spec.surface, spec.cost)))
    cells = homes.groupBy(*[col(c).cast("string").alias(k) for k, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("homes"),
        *[f(col(c)).alias(f"{name}_{m}") for m, c in measures.items()
          for name, f in (("sum", F.sum), ("n", F.count))])
    sums = cells.groupingSets([[F.col(k)] for k in PANELS] + [[]], *map(F.col, PANELS)).agg(
        F.sum("homes").alias("homes"),
        *[(F.sum(f"sum_{m}") / F.nullif(F.sum(f"n_{m}"), F.lit(0))).alias(f"mean_{m}")
          for m in MEASURES],
        *[F.grouping(k).alias(f"off_{k}") for k in PANELS])
    panel = F.lit("all")
    for k in PANELS:
        panel = F.when(F.col(f"off_{k}") == 0, k).otherwise(panel)
    label = F.coalesce(*map(F.col, PANELS))
    rows = sums.select(panel.alias("panel"), label.alias("label"), "homes",
                       *[f"mean_{m}" for m in MEASURES])
    rows = rows.filter("panel = 'all' or label is not null")
    of = F.sum("homes").over(Window.partitionBy("panel"))
    return rows.select(
        "panel", "label", "homes", (F.col("homes") * 100.0 / of).alias("percent"),
        *[f"mean_{m}" for m in MEASURES])
