"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake import fixed_values as fv
from energylake.functions import columns as c
from energylake.operators.features import training_target as make_target
from energylake.plans.jobs import prepare_gold
from energylake.queries.registry import query, table
from energylake.sources.layers import bi_export as export
from energylake.sources.messages import as_messages
from energylake.streaming.ingest import with_ingest_date

CLASS_SQL = """case when v {op} 70 then 'A' when v {op} 110 then 'B' when v {op} 180 then 'C'
                    when v {op} 250 then 'D' when v {op} 330 then 'E' when v {op} 420 then 'F'
                    else 'G' end"""


@query("""with y as (
            select o_orderkey, case when o_orderstatus = 'P' then null
                                    when o_orderpriority = '1-URGENT' then year(o_orderdate) - 7.5
                                    else year(o_orderdate) - 8 end::double as year from orders)
          select o_orderkey, year,
                 case when year < 1975 then 'Avant 1975'
                      when year between 1975 and 1989 then '1975-1989'
                      when year between 1990 and 2005 then '1990-2005'
                      when year between 2006 and 2012 then '2006-2012 (RT2005)'
                      else 'Après 2012 (RT2012)' end as period from y""")
def period_band(spark, sf):
    year = F.when(F.col("o_orderstatus") == "P", None).when(
        F.col("o_orderpriority") == "1-URGENT", F.year("o_orderdate") - 7.5).otherwise(
        F.year("o_orderdate") - 8).cast("double")
    return table(spark, sf, "orders").select("o_orderkey", year.alias("year")).withColumn(
        "period", c.band_closed(F.col("year"), fv.PERIOD_BANDS, fv.PERIOD_LAST))


@query("""select l_orderkey, l_linenumber,
                 case when l_quantity - 1 > 0 then l_extendedprice / (l_quantity - 1) end as ratio
          from lineitem""")
def safe_ratio(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        c.safe_ratio(F.col("l_extendedprice"), F.col("l_quantity") - 1).alias("ratio"))


@query("""select l_orderkey, l_linenumber, l_extendedprice, area,
                 l_extendedprice / nullif(area, 0) as target
          from (select *, l_quantity - 1 as area from lineitem)
          where l_extendedprice / nullif(area, 0) > 10 and l_extendedprice / nullif(area, 0) < 2000""")
def training_target(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") - 1).alias("area"))
    return make_target(rows, "l_extendedprice", "area", *fv.TARGET_RANGE, out="target")


@query(f"""select event_id, v, {CLASS_SQL.format(op='<=')} as class
           from (select event_id, floor(value) as v from events)""")
def band_upper(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.floor("value").cast("double").alias("v")).withColumn(
        "class", c.band_upper(F.col("v"), fv.CLASS_BOUNDS, fv.CLASS_LABELS))


@query(f"""select event_id, v, case when v < 0 then 'G' else {CLASS_SQL.format(op='<')} end as class
           from (select event_id, floor(value) - 1 as v from events)""")
def band_lower(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", (F.floor("value") - 1).cast("double").alias("v")).withColumn(
        "class", c.band_lower(F.col("v"), fv.CLASS_BOUNDS, fv.CLASS_LABELS))


@query("""select l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                 year(l_shipdate) - 10 as annee_construction,
                 case when year(l_shipdate) - 10 < 1975 then 'Avant 1975'
                      when year(l_shipdate) - 10 between 1975 and 1989 then '1975-1989'
                      when year(l_shipdate) - 10 between 1990 and 2005 then '1990-2005'
                      when year(l_shipdate) - 10 between 2006 and 2012 then '2006-2012 (RT2005)'
                      else 'Après 2012 (RT2012)' end as periode_construction,
                 l_extendedprice / l_quantity as conso_calculee_par_m2
          from lineitem""")
def gold_details(spark, sf):
    silver = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        (F.year("l_shipdate") - 10).cast("bigint").alias("annee_construction"),
        F.lit("replaced").alias("periode_construction"))
    return prepare_gold(silver, conso="l_extendedprice", surface="l_quantity")


@query("""select c_custkey, case c_mktsegment when 'BUILDING' then 0.5 when 'MACHINERY' then 1.5
                                 when 'HOUSEHOLD' then 2.5 else -1.0 end::double as score
          from customer""")
def class_score(spark, sf):
    scores = {"BUILDING": 0.5, "MACHINERY": 1.5, "HOUSEHOLD": 2.5}
    return table(spark, sf, "customer").select(
        "c_custkey", c.lookup(F.col("c_mktsegment"), scores, -1.0).alias("score"))


@query("""select o_orderkey, format('{:,.2f}', o_totalprice) || ' €' as cost,
                 format('{:,.0f}', o_totalprice) as conso from orders""")
def format_amount(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", c.format_amount(price, 2, " €").alias("cost"),
        c.format_amount(price).alias("conso"))


@query("""select event_id, json_extract(props, '$.k')::bigint as k from events""")
def decode_json(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", c.decode_json(F.col("props"), "k bigint").getField("k").alias("k"))


@query("""select '{"event_id":' || event_id || ',"event_type":'
                 || case when event_type = 'error' then 'null' else '"' || event_type || '"' end
                 || ',"user_id":' || user_id || '}' as value from events""")
def to_json(spark, sf):
    return as_messages(table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "user_id"))


@query("""select event_id, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H%M%S') as heure
          from events""")
def ingest_date(spark, sf):
    dated = with_ingest_date(table(spark, sf, "events").select("event_id", "ts"), "ts")
    return dated.select("event_id", F.col("date").cast("string").alias("date"), "heure")


@query("""select event_id, coalesce(nullif(event_type, 'error'), '') as event_type,
                 case when event_type <> 'view' then value end as value,
                 case when event_type = 'click' then '' else strftime(ts, '%Y-%m-%d') end as day
          from events""")
def bi_export(spark, sf):
    return export(table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.to_date("ts")).alias("day")))
