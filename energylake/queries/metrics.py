"""Counts, means, shares, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake.functions.columns import band_closed
from energylake.operators import metrics as m
from energylake.operators import rows as r
from energylake.operators.quantiles import quantiles as find_quantiles
from energylake.plans.dashboard import OverviewSpec
from energylake.plans.dashboard import overview as make_overview
from energylake.plans.dashboard import selected_homes
from energylake.queries.registry import query, table

YEAR_BANDS = [(None, 1997, "avant 1997"), (1997, 1998, "1997-1998"), (1999, 2000, "1999-2000")]


@query("select o_orderpriority, count(*) as n from orders group by 1")
def class_distribution(spark, sf):
    return m.class_distribution(table(spark, sf, "orders"), "o_orderpriority", out="n")


@query("""select l_returnflag, round(avg(l_extendedprice), 4) as mean_price
          from lineitem group by 1""")
def mean_by_class(spark, sf):
    return (m.mean_by(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
            .select("l_returnflag", F.round("mean", 4).alias("mean_price")))


@query("""with banded as (
            select case when year(o_orderdate) < 1997 then 'avant 1997'
                        when year(o_orderdate) between 1997 and 1998 then '1997-1998'
                        when year(o_orderdate) between 1999 and 2000 then '1999-2000'
                        else 'après 2000' end as period, o_totalprice from orders)
          select period, round(avg(o_totalprice), 4) as mean_price from banded
          where period in ('avant 1997', '1997-1998', '1999-2000') group by 1""")
def mean_by_period(spark, sf):
    banded = table(spark, sf, "orders").withColumn(
        "period", band_closed(F.year("o_orderdate"), YEAR_BANDS, "après 2000"))
    order = [label for _, _, label in YEAR_BANDS]
    return (m.mean_by(banded, "period", "o_totalprice", order)
            .select("period", F.round("mean", 4).alias("mean_price")))


@query("""select count(*) as homes, round(avg(l_extendedprice), 4) as mean_price,
                 round(avg(l_quantity), 6) as mean_quantity, round(avg(l_tax), 8) as mean_tax
          from lineitem where l_returnflag in ('A', 'R') and l_quantity between 5 and 40
                          and l_linestatus in ('O')""")
def filtered_kpis(spark, sf):
    kept = r.filter_rows(table(spark, sf, "lineitem"),
                         isin={"l_returnflag": ["A", "R"], "l_linestatus": ["O"]},
                         between={"l_quantity": (5, 40)})
    found = m.kpis(kept, {"mean_price": "l_extendedprice", "mean_quantity": "l_quantity",
                          "mean_tax": "l_tax"}, count="homes")
    return found.select("homes", F.round("mean_price", 4).alias("mean_price"),
                        F.round("mean_quantity", 6).alias("mean_quantity"),
                        F.round("mean_tax", 8).alias("mean_tax"))


@query("""select p_type, count(*) as n,
                 round(count(*) * 100.0::double / sum(count(*)) over (), 6) as percent
          from part group by 1""")
def share_by_type(spark, sf):
    return (m.share_by(table(spark, sf, "part"), "p_type", count="n")
            .withColumn("percent", F.round("percent", 6)))


@query("select distinct p_type from part")
def filter_domain(spark, sf):
    return m.domain(table(spark, sf, "part"), "p_type")


@query("""select trunc(min(l_extendedprice))::bigint as low,
                 trunc(max(l_extendedprice))::bigint as high from lineitem""")
def filter_bounds(spark, sf):
    return m.bounds(table(spark, sf, "lineitem"), "l_extendedprice")


@query("""select 'p_brand' as feature, p_brand as value, n as "count", rank, distinct_values from (
            select p_brand, n, row_number() over (order by n desc, p_brand) as rank,
                   count(*) over () as distinct_values
            from (select p_brand, count(*) as n from part group by 1)) where rank <= 3
          union all
          select 'p_type', p_type, n, rank, distinct_values from (
            select p_type, n, row_number() over (order by n desc, p_type) as rank,
                   count(*) over () as distinct_values
            from (select p_type, count(*) as n from part group by 1)) where rank <= 3""")
def profile_categories(spark, sf):
    return m.profile_categories(table(spark, sf, "part"), ["p_brand", "p_type"])


FREQUENT = ["l_returnflag", "l_linenumber", "l_suppkey"]


@query(" union all ".join(
    f"""select '{c}' as feature, value, n as "count", rank, distinct_values from (
          select value, n, row_number() over (order by n desc, value) as rank, count(*) over () as distinct_values
          from (select {c}::varchar as value, count(*) as n from lineitem where {c} is not null group by 1))
        where rank <= 3""" for c in FREQUENT))
def profile_frequent(spark, sf):
    return m.profile_frequent(table(spark, sf, "lineitem"), FREQUENT)


@query("""select unnest([0.25, 0.5, 0.75])::double as prob,
                 unnest((select quantile_disc(l_extendedprice, [0.25, 0.5, 0.75]) from lineitem))
                   as value""")
def quantiles(spark, sf):
    probs = [0.25, 0.5, 0.75]
    found = find_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], probs, 0)
    return spark.createDataFrame(list(zip(probs, found["l_extendedprice"])),
                                 "prob double, value double")


@query("""select 'l_extendedprice' as "column", unnest([0.25, 0.5, 0.75])::double as prob,
                 count(l_extendedprice) as "rows", true as within from lineitem
          union all
          select 'l_quantity', unnest([0.25, 0.5, 0.75])::double, count(l_quantity), true
            from lineitem""")
def quantiles_in_bound(spark, sf):
    """The default error holds: each sketched value's true ranks come within 0.01 of the wanted one."""
    lines, probs, err = table(spark, sf, "lineitem"), [0.25, 0.5, 0.75], 0.01
    found = find_quantiles(lines, ["l_extendedprice", "l_quantity"], probs)
    checks = []
    for name, values in found.items():
        for p, v in zip(probs, values):
            below, upto = F.avg((F.col(name) < v).cast("int")), F.avg((F.col(name) <= v).cast("int"))
            checks.append(F.struct(
                F.lit(name).alias("column"), F.lit(p).alias("prob"), F.count(name).alias("rows"),
                ((below <= p + err) & (upto >= p - err)).alias("within")))
    return lines.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@query("""select count(l_extendedprice) as "rows", median(l_extendedprice) as median,
                 min(l_extendedprice) as min, max(l_extendedprice) as max from lineitem""")
def target_summary(spark, sf):
    return m.target_summary(table(spark, sf, "lineitem"), "l_extendedprice")


@query("""with gaps as (
            select l_returnflag, nullif(l_linenumber, 7) as a, nullif(l_quantity, 50) as b
            from lineitem)
          select l_returnflag, count(*) filter (a is not null and b is not null) as "count",
                 (select count(*) from gaps) as rows_in,
                 (select count(*) from gaps where a is null or b is null) as rows_dropped,
                 (select count(*) from gaps where a is not null and b is not null) as rows_out
          from gaps group by 1""")
def cleaning_report(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        "l_returnflag", F.nullif("l_linenumber", F.lit(7)).alias("a"),
        F.nullif("l_quantity", F.lit(50.0)).alias("b"))
    return m.cleaning_report(gaps, ["a", "b"], "l_returnflag")


@query("""with per as (
            select n_name as area, c_mktsegment, count(*) as n
            from customer join nation on c_nationkey = n_nationkey group by 1, 2),
          best as (
            select area, c_mktsegment,
                   row_number() over (partition by area order by n desc, c_mktsegment) as k from per)
          select per.area, any_value(best.c_mktsegment) as dominant, sum(n)::bigint as "rows",
                 round(sum(case when per.c_mktsegment in ('BUILDING', 'MACHINERY') then n else 0 end)
                       * 100.0::double / sum(n), 1) as good_percent
          from per join best on per.area = best.area and k = 1 group by 1""")
def area_dominant(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                               F.col("n_name").alias("area"))
    homes = r.join_small(table(spark, sf, "customer"), nation, "c_nationkey", "inner")
    return m.dominant_by_area(homes, "area", "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("""with p as (
            select l_returnflag, l_extendedprice as y, 500 + 2000 * l_quantity as pred
            from lineitem)
          select l_returnflag, count(*) as "rows", round(avg(abs(y - pred)), 4) as mae,
                 round(sqrt(avg((y - pred) * (y - pred))), 4) as rmse,
                 round(1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)), 8) as r2
          from p group by 1""")
def regression_metrics(spark, sf):
    scored = table(spark, sf, "lineitem").withColumn("pred", 500 + 2000 * F.col("l_quantity"))
    found = m.regression_metrics(scored, "l_extendedprice", "pred", ["l_returnflag"])
    return found.select("l_returnflag", "rows", F.round("mae", 4).alias("mae"),
                        F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"))


@query("""with homes as (
            select l_returnflag, l_linestatus, year(l_shipdate)::varchar as year, l_quantity,
                   case when l_linenumber <> 7 then l_extendedprice end as price, l_tax
            from lineitem
            where l_returnflag in ('A', 'N') and l_quantity between 5 and 45
                  and l_linestatus in ('F', 'O')),
          panels as (
            select 'class' as panel, l_returnflag as label, * from homes
            union all select 'type', l_linestatus, * from homes
            union all select 'period', year, * from homes
            union all select 'all', null, * from homes)
          select panel, label, count(*) as homes,
                 round(count(*) * 100.0::double / sum(count(*)) over (partition by panel), 6) as percent,
                 round(avg(price), 4) as mean_conso, round(avg(l_quantity), 6) as mean_surface,
                 round(avg(l_tax), 8) as mean_cost
          from panels group by panel, label""")
def overview(spark, sf):
    homes = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"), "l_quantity",
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("price"), "l_tax")
    spec = OverviewSpec("l_returnflag", "l_linestatus", "year", "price", "l_quantity", "l_tax")
    chosen = selected_homes(homes, spec, ["A", "N"], (5, 45), ["F", "O"])
    return make_overview(chosen, spec).select(
        "panel", "label", "homes", F.round("percent", 6).alias("percent"),
        F.round("mean_conso", 4).alias("mean_conso"),
        F.round("mean_surface", 6).alias("mean_surface"), F.round("mean_cost", 8).alias("mean_cost"))
