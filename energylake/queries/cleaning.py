"""Cleaning steps, exact quantiles so that SQL can follow."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from energylake import fixed_values as fv
from energylake.operators import cleaning as cl
from energylake.plans.jobs import CleaningSpec, bronze_to_silver, clean, clean_day, select_rows
from energylake.queries.registry import query, table
from energylake.session import scratch_path
from energylake.sources.layers import read_layer, write_bronze


@query("select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders")
def drop_columns(spark, sf):
    return cl.drop_columns(table(spark, sf, "orders"), ["o_totalprice", "o_orderdate", "absent"])


@query("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice from (
            select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus,
                   case when o_orderpriority <> '5-LOW' then o_totalprice end as o_totalprice
            from orders)
          where o_orderstatus is not null and o_totalprice is not null""")
def drop_incomplete(spark, sf):
    gaps = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"))
    return cl.drop_incomplete(gaps, ["o_orderstatus", "o_totalprice"])


@query("""select o_orderkey, o_orderstatus,
                 case o_orderstatus when 'F' then 1 when 'O' then 2 end::double as o_orderstatus_num
          from orders""")
def encode_ordinal(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    coded = cl.encode_ordinal(orders, "o_orderstatus", {"F": 1, "O": 2})
    return coded.withColumn("o_orderstatus_num", F.col("o_orderstatus_num").cast("double"))


@query("""select p_partkey, p_type,
                 case lower(p_type) when 'economy' then 1 when 'standard' then 2
                      when 'promo' then 3 when 'large' then 4 else 0 end as p_type_num from part""")
def encode_ordinal_ci(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    return cl.encode_ordinal(part, "p_type", {"economy": 1, "standard": 2, "promo": 3, "large": 4},
                             default=0, lower=True)


@query("""select l_orderkey, l_linenumber,
                 coalesce((case when l_linenumber <> 7 then l_discount end)::float::double, 0.0)
                   ::double as l_discount from lineitem""")
def fill_zero(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("l_discount"))
    return cl.fill_zero(gaps, ["l_discount", "absent"])


@query("""select l_orderkey, l_linenumber,
                 case when l_linenumber <> 7 and l_tax > 0.04 then 1 else 0 end as high_tax
          from lineitem""")
def encode_boolean(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_tax") > 0.04).alias("high_tax"))
    return cl.encode_boolean(gaps, ["high_tax"])


def _price_gaps(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("price"))


@query("""with gaps as (
            select l_orderkey, l_linenumber,
                   case when l_linenumber <> 7 then l_extendedprice end as price from lineitem)
          select l_orderkey, l_linenumber,
                 coalesce(price::float::double, (select quantile_disc(price, 0.5) from gaps)) as price
          from gaps""")
def impute_median(spark, sf):
    return cl.impute_median(_price_gaps(spark, sf), ["price"], rel_err=0)


@query("""with gaps as (
            select l_orderkey, l_linenumber,
                   case when l_linenumber <> 7 then l_extendedprice end as price from lineitem)
          select l_orderkey, l_linenumber, coalesce(price, (select median(price) from gaps)) as price
          from gaps""")
def impute_exact(spark, sf):
    return cl.impute_median(_price_gaps(spark, sf), ["price"], exact=True)


@query("""with x as (select o_orderkey, o_totalprice * o_totalprice / 1000000 as v from orders),
          q as (select quantile_disc(v, 0.25) as q1, quantile_disc(v, 0.75) as q3 from x)
          select o_orderkey,
                 (case when v < q1 - 1.5 * (q3 - q1) then q1 - 1.5 * (q3 - q1)
                       when v > q3 + 1.5 * (q3 - q1) then q3 + 1.5 * (q3 - q1)
                       else v end)::float::double as v from x, q""")
def clip_iqr(spark, sf):
    x = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") * F.col("o_totalprice") / 1000000).alias("v"))
    return cl.clip_iqr(x, ["v"], rel_err=0).withColumn("v", F.col("v").cast("double"))


@query("""select l_orderkey, l_linenumber, round(ln(1 + l_extendedprice::float::double), 6) as v
          from lineitem""")
def log_transform(spark, sf):
    logged = cl.log_transform(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
        ["l_extendedprice"])
    return logged.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 6).alias("v"))


@query("""select o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'Inconnu') as label
          from orders""")
def fill_label(spark, sf):
    gaps = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("label"))
    return cl.fill_label(gaps, ["label"], "Inconnu")


LINE_RULES = CleaningSpec(
    dropped=["l_shipdate", "l_suppkey", "absent"], labels=["l_returnflag"],
    insulation=["l_linestatus"], critical=["l_quantity"], zero=["l_discount"],
    boolean=["high_tax"], median=["price"], clipped=["price", "size"], logged=["l_discount"],
    rel_err=0)


CLEAN_SQL = """with rows as (
            select l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity,
                   case when l_linenumber <> 7 then l_discount end as l_discount,
                   case when l_linenumber <> 6 then l_tax > 0.04 end as high_tax,
                   case when l_linenumber <> 5 then l_extendedprice end as price,
                   1000 / l_quantity as size
            from lineitem where l_quantity <> 50),
          middle as (select quantile_disc(price, 0.5) as m from rows),
          filled as (select rows.* replace (coalesce(price::float::double, m) as price)
                     from rows, middle),
          q as (select quantile_disc(price, 0.25) as p1, quantile_disc(price, 0.75) as p3,
                       quantile_disc(size, 0.25) as s1, quantile_disc(size, 0.75) as s3 from filled)
          select l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity,
                 round(ln(1 + coalesce(l_discount::float, 0)::double), 6) as l_discount,
                 case when high_tax then 1 else 0 end as high_tax,
                 (case when price < p1 - 1.5 * (p3 - p1) then p1 - 1.5 * (p3 - p1)
                       when price > p3 + 1.5 * (p3 - p1) then p3 + 1.5 * (p3 - p1)
                       else price end)::float::double as price,
                 (case when size < s1 - 1.5 * (s3 - s1) then s1 - 1.5 * (s3 - s1)
                       when size > s3 + 1.5 * (s3 - s1) then s3 + 1.5 * (s3 - s1)
                       else size end)::float::double as size,
                 case l_returnflag when 'A' then 1 end::double as l_returnflag_num,
                 0 as l_linestatus_num
          from filled, q"""


def _line_rows(spark, sf, **more):
    return table(spark, sf, "lineitem").select(
        *[c.alias(n) for n, c in more.items()],
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"), "l_suppkey",
        F.nullif("l_quantity", F.lit(50.0)).alias("l_quantity"),
        F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") != 6, F.col("l_tax") > 0.04).alias("high_tax"),
        F.when(F.col("l_linenumber") != 5, F.col("l_extendedprice")).alias("price"),
        (1000 / F.col("l_quantity")).alias("size"))


def _comparable(silver):
    return silver.withColumns({
        "l_discount": F.round("l_discount", 6), "price": F.col("price").cast("double"),
        "size": F.col("size").cast("double"),
        "l_returnflag_num": F.col("l_returnflag_num").cast("double")})


@query(CLEAN_SQL)
def clean_lines(spark, sf):
    return _comparable(clean(_line_rows(spark, sf), LINE_RULES))


@query(CLEAN_SQL)
def silver_from_bronze(spark, sf):
    """The same rules as a job over JSON files, staged and written."""
    rows = _line_rows(spark, sf)
    bronze, staging, silver = (scratch_path(spark, n) for n in ("lines", "staging", "silver"))
    write_bronze(rows, bronze)
    bronze_to_silver(spark, bronze, silver, staging, LINE_RULES, rows.schema)
    return _comparable(read_layer(spark, silver))


@query(CLEAN_SQL.replace("l_linestatus, l_quantity,", """l_linestatus, l_quantity, l_partkey,
                   case when l_linenumber % 2 = 1 then l_returnflag end as note,"""))
def silver_with_new_fields(spark, sf):
    """Fields the schema doesn't name become columns, from one scan; those of another dataset don't."""
    more = {"l_partkey": F.col("l_partkey"),
            "note": F.when(F.col("l_linenumber") % 2 == 1, F.col("l_returnflag"))}
    rows = _line_rows(spark, sf, **more)
    known = rows.drop(*more, "l_shipdate", "l_suppkey").schema
    bronze, staging, silver = (scratch_path(spark, n) for n in ("fields", "staging", "silver"))
    for name, records in (("a", rows), ("b", table(spark, sf, "part").select("p_partkey", "p_name"))):
        write_bronze(records, f"{bronze}/dataset={name}")
    bronze_to_silver(spark, bronze, silver, staging, LINE_RULES, known, "a", discover=True)
    return _comparable(read_layer(spark, silver)).drop("dataset").withColumn("l_partkey", F.col("l_partkey").cast("long"))


DAY_RULES = replace(LINE_RULES, rel_err=0.01)
DAYS = ("2026-03-05", "2026-03-06")


def _write_days(rows, path):
    """Bronze of each day by a write of its own: one write by ``date`` would first sort the rows of each task, which spills."""
    for one in DAYS:
        write_bronze(rows.filter(F.col("date") == one).drop("date"), f"{path}/date={one}")


def _clean_days(spark, sf):
    """Lines cleaned day by day; the second day is cleaned twice, at first with half of its lines.

    The lines with the statistics of both days, and the paths of silver and of the sketches.
    """
    day = F.when(F.col("l_shipdate") < "1996-01-01", DAYS[0]).otherwise(DAYS[1])
    rows = _line_rows(spark, sf).withColumn("date", day)
    bronze, half, staging, silver, sketches = (
        scratch_path(spark, n) for n in ("days", "half", "staging", "silver", "sketches"))
    _write_days(rows, bronze)
    _write_days(rows.filter("l_orderkey % 2 = 0"), half)
    known = rows.drop("date").schema
    for source, one in ((bronze, DAYS[0]), (half, DAYS[1]), (bronze, DAYS[1])):
        found = clean_day(spark, source, silver, staging, sketches, one, DAY_RULES, known)
    return rows, found, silver, sketches


@query("""select l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity,
                 round(ln(1 + coalesce(case when l_linenumber <> 7 then l_discount end::float, 0)::double), 6) as l_discount,
                 coalesce(case when l_linenumber <> 6 then l_tax > 0.04 end, false)::int as high_tax,
                 case when l_shipdate < timestamp '1996-01-01' then '2026-03-05' else '2026-03-06' end as date,
                 true as filled
          from lineitem where l_quantity <> 50""")
def silver_by_day(spark, sf):
    """A silver table that grew by two days, the second replaced once."""
    _, _, silver, _ = _clean_days(spark, sf)
    return read_layer(spark, silver).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity",
        F.round("l_discount", 6).alias("l_discount"), "high_tax", F.col("date").cast("string").alias("date"),
        F.col("price").isNotNull().alias("filled"))


@query("""select "column", prob::double as prob, within from (values ('price', 0.25, true), ('price', 0.5, true), ('price', 0.75, true),
                                ('size', 0.25, true), ('size', 0.75, true)) as t("column", prob, within)""")
def quantiles_by_day(spark, sf):
    """Statistics from the sketches of both days hold their error: true ranks within 0.01 of the wanted one.

    Quartiles are those of the column whose gaps hold the median of all days.
    """
    rows, found, _, _ = _clean_days(spark, sf)
    rows, err = select_rows(rows, DAY_RULES), DAY_RULES.rel_err
    rows = cl.fill_gaps(rows, found.medians)
    wanted = [("price", 0.5, found.medians["price"])]
    for name, (low, high) in found.fences.items():
        step = (high - low) / (1 + 2 * fv.IQR_FACTOR)
        wanted += [(name, 0.25, low + fv.IQR_FACTOR * step), (name, 0.75, high - fv.IQR_FACTOR * step)]
    checks = []
    for name, p, v in wanted:
        slack = abs(v) * 1e-6  # values are held in single precision
        below, upto = F.avg((F.col(name) < v - slack).cast("int")), F.avg((F.col(name) <= v + slack).cast("int"))
        checks.append(F.struct(F.lit(name).alias("column"), F.lit(p).alias("prob"),
                               ((below <= p + err) & (upto >= p - err)).alias("within")))
    return rows.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
