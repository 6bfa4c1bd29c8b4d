"""Filters, slices, unions, splits, paged pull."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake.operators import rows as r
from energylake.queries.registry import query, table
from energylake.sources.layers import read_layer


@query("""select 'customer' as name, count(*) as "rows" from customer
          union all select 'supplier', count(*) from supplier
          union all select 'lineitem', count(*) from lineitem""")
def row_counts(spark, sf):
    return r.union_layers(*[
        r.count_rows(table(spark, sf, t)).withColumn("name", F.lit(t))
        for t in ("customer", "supplier", "lineitem")])


@query("""select c_name as name, c_nationkey as nationkey, c_acctbal as acctbal,
                 c_mktsegment as segment from customer
          union all select s_name, s_nationkey, s_acctbal, null from supplier""")
def union_layers(spark, sf):
    customer = r.rename(table(spark, sf, "customer").drop("c_custkey"),
                        {"c_name": "name", "c_nationkey": "nationkey",
                         "c_acctbal": "acctbal", "c_mktsegment": "segment"})
    supplier = r.rename(table(spark, sf, "supplier").drop("s_suppkey"),
                        {"s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return r.union_layers(customer, supplier)


@query("select l_returnflag as label from lineitem union select l_linestatus from lineitem")
def class_domain(spark, sf):
    return r.union_domain(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "label")


@query("""select o_orderkey, o_custkey, o_totalprice from orders
          order by o_orderkey limit 500 offset 1000""")
def slice_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return r.slice_rows(orders, "o_orderkey", limit=500, offset=1000)


@query("""select o_orderkey, o_custkey, o_totalprice from orders
          order by o_orderkey offset 1000""")
def slice_rows_resume(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return r.slice_rows(orders, "o_orderkey", offset=1000)


@query("""select c_custkey, c_name, c_acctbal from customer order by c_name, c_custkey offset 700""")
def slice_by_text(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return r.slice_rows(customer, "c_name", offset=700)


@query("""select o_orderkey + 1152921504606846976 as k, o_custkey from orders
          order by k limit 120000 offset 7000""")
def slice_by_large_numbers(spark, sf):
    """Keys that a double cannot tell apart."""
    orders = table(spark, sf, "orders").select((F.col("o_orderkey") + 2**60).alias("k"), "o_custkey")
    return r.slice_rows(orders, "k", limit=120_000, offset=7_000)


@query("select l_quantity, l_linenumber from lineitem order by l_quantity, l_linenumber offset 31000")
def slice_repeated_keys(spark, sf):
    """Pages of a key that occurs on many rows: all but the first 31,000 rows."""
    keys = table(spark, sf, "lineitem").select(
        F.struct("l_quantity", "l_linenumber").alias("k"))
    return r.slice_rows(keys, "k", offset=31_000).select("k.*")


@query("""select case when ('0x' || substr(md5('42|' || l_orderkey), 1, 8))::bigint % 10000 < 2000
                      then 'test' else 'train' end as split,
                 ('0x' || substr(md5('43|' || l_orderkey), 1, 8))::bigint % 5 as fold,
                 count(*) as n, sum(l_linenumber)::bigint as lines
          from lineitem group by 1, 2""")
def split_counts(spark, sf):
    rows = r.split_by_key(table(spark, sf, "lineitem"), ["l_orderkey"], bucket=r.portable_bucket)
    rows = r.fold_by_key(rows, ["l_orderkey"], bucket=r.portable_bucket)
    return rows.groupBy("split", F.col("fold").cast("bigint").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query("""with n as (select count(*) as n from lineitem),
            t as (select n, ceil(0.2 * n)::bigint as test from n)
          select 'test' as split, -1 as fold, test as n from t
          union all select 'train', f.k, (n - test) // 5 + (case when f.k < (n - test) % 5 then 1 else 0 end)
          from t, (select unnest(range(5))::int as k) f""")
def exact_split_sizes(spark, sf):
    """A fifth of the rows held out and five folds of the rest, each of its exact size."""
    rows = r.split_exactly(table(spark, sf, "lineitem"), ["l_orderkey"])
    folds = r.fold_exactly(rows.filter("split = 'train'"), ["l_orderkey"])
    test = rows.filter("split = 'test'").withColumn("fold", F.lit(-1))
    return folds.unionByName(test).groupBy("split", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey, c_name, c_mktsegment from customer")
def shuffle_rows(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return r.shuffle_rows(customer, ["c_custkey"])


@query("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders""")
def paged_source_read(spark, sf):
    """The columns that a pull of this table would send, read as a layer."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return read_layer(spark, f"{sf}/orders.parquet", columns)
