"""Slices, splits, unions, joins."""

import pytest
from pyspark.sql import functions as F

from energylake.operators import rows as r


@pytest.fixture(scope="module")
def thousand(spark):
    return spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("k"))


def keys(df):
    return [row["k"] for row in df.collect()]


@pytest.mark.parametrize("limit, offset", [(10, 0), (10, 995), (None, 990), (None, 0), (5000, 3),
                                           (0, 5), (None, 1000), (20, 2000)])
@pytest.mark.parametrize("top", [100_000, 5])
def test_slice_matches_a_list(thousand, monkeypatch, limit, offset, top):
    """With a tiny top-k limit every slice takes the range-filter way."""
    monkeypatch.setattr(r, "TOP_ROWS", top)
    want = [3 * i for i in range(1000)][offset:None if limit is None else offset + limit]
    assert keys(r.slice_rows(thousand, "k", limit, offset)) == want


def test_long_slice_is_a_filter_not_a_single_task(thousand):
    plan = r.slice_rows(thousand, "k", None, 500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset" not in plan and "Limit" not in plan and "Filter" in plan


@pytest.mark.parametrize("top", [100_000, 0])
def test_slices_by_any_key(spark, monkeypatch, top):
    """Text, null, repeated and very large keys, the short way and the long way."""
    monkeypatch.setattr(r, "TOP_ROWS", top)
    rows = [(2**60 + i // 3, None if i < 4 else f"s{i % 40:02}", i, "x") for i in range(120)]
    df = spark.createDataFrame(rows, "k bigint, s string, i int, _place string").repartition(5)
    for key, want in (("k", sorted(x[0] for x in rows)),
                      ("s", [None] * 4 + sorted(x[1] for x in rows[4:]))):
        pages = [r.slice_rows(df, key, 25, start).collect() for start in range(0, 150, 25)]
        assert [x[key] for page in pages for x in page] == want
        assert sorted(x["i"] for page in pages for x in page) == list(range(120))
        assert pages[0][0].asDict().keys() == {"k", "s", "i", "_place"}
        rest = r.slice_rows(df, key, None, 100).collect()
        assert rest == pages[4]


def test_equal_rows_are_sliced_by_number(spark):
    same = spark.range(100).select(F.lit("a").alias("k")).repartition(7)
    assert r.slice_rows(same, "k", None, 33).count() == 67
    assert r.slice_rows(same.limit(0), "k", None, 33).count() == 0


@pytest.mark.parametrize("bucket", [r.hash_bucket, r.portable_bucket])
def test_split_is_stable_and_near_its_share(spark, bucket):
    df = spark.range(20_000)
    one, many = (
        r.fold_by_key(r.split_by_key(df.repartition(n), ["id"], 0.2, bucket=bucket), ["id"],
                      bucket=bucket) for n in (1, 17))
    assert one.exceptAll(many).isEmpty()
    sizes = {(x["split"], x["fold"]): x["count"] for x in one.groupBy("split", "fold").count().collect()}
    assert len(sizes) == 10
    test = [n for (split, _), n in sizes.items() if split == "test"]
    assert abs(sum(test) - 4000) < 250 and max(test) - min(test) < 200
    other = r.split_by_key(df, ["id"], 0.2, seed=7, bucket=bucket)
    assert not one.select("id", "split").exceptAll(other).isEmpty()


def test_shuffle_keeps_rows_and_changes_order(thousand):
    once, again = (keys(r.shuffle_rows(thousand.repartition(n), ["k"])) for n in (2, 9))
    assert once == again and sorted(once) == keys(thousand.orderBy("k")) and once != sorted(once)


def test_order_with_own_partitions(thousand):
    wide = r.slice_rows(thousand, "k", None, 10, partitions=13)
    assert wide.rdd.getNumPartitions() == 13 and keys(wide) == [3 * i for i in range(10, 1000)]


def test_filters(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 5.0), (None, 3.0), ("C", 5.1)], "c string, x double")
    kept = r.filter_rows(df, isin={"c": ["A", "B"]}, between={"x": (1, 5)})
    assert [tuple(x) for x in kept.collect()] == [("A", 1.0), ("B", 5.0)]
    assert [x["x"] for x in r.filter_open(df, "x", 1, 5.1).collect()] == [5.0, 3.0]
    assert r.is_empty(r.filter_rows(df, isin={"c": ["Z"]})) and not r.is_empty(df)


def test_union_fills_what_one_side_lacks(spark):
    old = spark.createDataFrame([("a", 1)], "name string, n int")
    new = spark.createDataFrame([("b",)], "name string")
    assert [tuple(x) for x in r.union_layers(old, new).collect()] == [("a", 1), ("b", None)]
    assert r.count_rows(r.union_layers(old, old)).first()[0] == 2


def test_join_is_broadcast_only_when_known_to_be_small(spark):
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(20).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = r.join_small(big, small, "k", bound=20)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        wide = r.join_small(big, small, "k")
        assert "BroadcastHashJoin" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
