"""Layers, documents, messages, paged pull."""

import io
import json
import pathlib
import sys
import urllib.error
import urllib.parse

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from energylake.queries import cleaning
from energylake.session import scratch_path
from energylake.sources import layers as s
from energylake.sources.messages import as_messages, publish, publish_stream
from energylake.sources.paged import HttpPages, page_runs, paged_source
from paged_trial import ParquetPages


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bronze_is_written_small_and_in_files_of_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(s, "FILE_ROWS", 300)
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.lit("é\n")).alias("t"),
                                  F.concat(F.lit("2026-03-0"), F.col("id") % 2 + 1).alias("date")).coalesce(1)
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    df.write.partitionBy("date").json(plain)
    s.write_bronze(df, small, ["date"])
    size = {p: sum(f.stat().st_size for f in pathlib.Path(p).rglob("part-*")) for p in (plain, small)}
    assert size[small] < size[plain] / 3
    back = s.read_bronze(spark, small, spark.createDataFrame([], "id long, t string").schema)
    assert sorted(map(str, rows(back))) == sorted(map(str, rows(s.read_bronze(spark, plain, back.drop("date").schema))))
    assert back.count() == 2000
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 300


@pytest.mark.parametrize("query", ["silver_by_day", "quantiles_by_day", "silver_from_bronze", "silver_with_new_fields"])
def test_lines_are_compressed_in_bronze(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(cleaning, "scratch_path", lambda spark, label: str(tmp_path / label))
    getattr(cleaning, query)(spark, "/root/testdata/sf0.001")
    assert list(tmp_path.rglob("part-*.json.gz")) and not list(tmp_path.rglob("part-*.json"))


def test_a_layer_without_files_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        s.read_layer(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        s.read_layer(spark, str(tmp_path / "empty"))


def test_layer_overwrite_partitions_and_pruning(spark):
    path = scratch_path(spark, "layer")
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 1.5)], "k string, n int, v double")
    s.write_layer(df, path)
    s.write_layer(df, path, ["k"])
    only = s.read_layer(spark, path).where("k = 'b' and v > 1").select("n")
    assert rows(only) == [(2,)]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan and "GreaterThan(v,1.0)" in plan
    assert "ReadSchema: struct<n:int,v:double>" in plan


def test_layers_of_several_paths_are_one_table(spark):
    paths = [scratch_path(spark, n) for n in ("old", "new")]
    for i, path in enumerate(paths):
        s.write_layer(spark.createDataFrame([(i,)], "n int"), path)
    assert rows(s.read_layer(spark, paths)) == [(0,), (1,)]


def test_documents(spark, tmp_path):
    (tmp_path / "gains.json").write_text(json.dumps([{"t": "F->E", "n": 1}, {"t": "E->D", "n": 2}], indent=1))
    (tmp_path / "metrics.json").write_text('{"mae": 42.5,\n "r2_test": 0.465}')
    assert rows(s.read_json_table(spark, str(tmp_path / "gains.json")).select("t", "n")) == [
        ("E->D", 2), ("F->E", 1)]
    assert s.read_json_table(spark, str(tmp_path / "metrics.json")).first()["mae"] == 42.5
    path = scratch_path(spark, "document")
    s.write_json_table(spark.createDataFrame([(1, None), (2, "é")], "n int, t string"), path)
    assert rows(s.read_json_table(spark, path).select("n")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="rows"):
        s.write_json_table(spark.range(11), path, bound=10)


def test_bi_export_types(spark):
    df = spark.sql("""select * from values
        (1, 1.5D, 'a', date'2026-03-05', true, 2.50BD, array(1)),
        (null, null, null, null, null, null, null) as t(i, d, s, day, b, m, a)""")
    out = s.bi_export(df)
    assert dict(out.dtypes) == {"i": "int", "d": "double", "s": "string", "day": "string",
                                "b": "boolean", "m": "string", "a": "string"}
    assert [tuple(r) for r in out.collect()] == [
        (1, 1.5, "a", "2026-03-05", True, "2.50", "[1]"), (None, None, "", "", None, "", "")]


def test_publish_writes_one_message_per_row(spark):
    path = scratch_path(spark, "topic")
    df = spark.createDataFrame([("é", None), ("b", 2)], "t string, n int")
    publish(df, "open-data-existant", {"path": path}, fmt="text")
    assert rows(spark.read.text(path)) == [('{"t":"b","n":2}',), ('{"t":"é","n":null}',)]
    assert as_messages(df).columns == ["value"]


@pytest.fixture(scope="module")
def parquet_file(spark, tmp_path_factory):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = str(tmp_path_factory.mktemp("pages") / "t.parquet")
    names = [f"r{i}" for i in range(1000)]
    pq.write_table(pa.table({"n": list(range(1000)), "t": names, "value": names}), path,
                   row_group_size=333)
    return path


@pytest.mark.parametrize("options, want", [
    ({}, range(1000)), ({"offset": 950}, range(950, 1000)), ({"limit": 7}, range(7)),
    ({"offset": 33, "limit": 120, "page_size": 50, "pages_per_task": 1}, range(33, 153)),
    ({"offset": 2000}, range(0)), ({"limit": 5000, "offset": 990}, range(990, 1000))])
def test_paged_read(spark, parquet_file, options, want):
    spark.dataSource.register(paged_source(ParquetPages(parquet_file, ["n", "t"]), "n bigint, t string", "trial"))
    got = spark.read.format("trial").options(**options).load()
    assert rows(got) == [(i, f"r{i}") for i in want]


def test_pages_by_uri(parquet_file):
    pages = ParquetPages("file://" + parquet_file, ["n"])
    assert pages.total() == 1000
    assert sum((b.column(0).to_pylist() for b in pages.page(330, 10)), []) == list(range(330, 340))


def test_page_runs_cover_every_row_once():
    runs = page_runs(33, 1033, 100, 3)
    assert [(r.start, r.stop) for r in runs] == [(33, 333), (333, 633), (633, 933), (933, 1033)]


def test_paged_stream_resumes(spark, parquet_file):
    """The checkpoint knows the row reached: a second run reads only what is new."""
    checkpoint, out = scratch_path(spark, "checkpoint"), scratch_path(spark, "out")

    def pull(limit):
        spark.dataSource.register(paged_source(
            ParquetPages(parquet_file, ["value"]), "value string", "resumed"))
        stream = (spark.readStream.format("resumed").option("limit", limit)
                  .option("pages_per_task", 2).load())
        publish_stream(stream, "t", {"path": out}, checkpoint, fmt="text").awaitTermination(120)
        return spark.read.text(out).count()

    assert pull(400) == 400
    assert pull(400) == 400
    assert pull(700) == 700
    assert spark.read.text(out).distinct().count() == 700


class FakeService:
    """Answers like the service, failing the first ``broken`` requests of each task."""

    def __init__(self, total, broken=0):
        self.total, self.broken, self.asked = total, broken, []

    def __call__(self, address, timeout):
        if self.broken:
            self.broken -= 1
            raise urllib.error.URLError("slow")
        asked = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(address).query).items()}
        self.asked.append(asked)
        start = int(asked.get("from", 0))
        found = range(start, min(start + int(asked["size"]), self.total))
        return io.StringIO(json.dumps({"total": self.total, "results": [{"n": i, "t": "é"} for i in found]}))


def test_http_pages(spark):
    service = FakeService(250, broken=2)
    spark.dataSource.register(paged_source(HttpPages("http://x/lines", wait=0, opener=service)))
    df = spark.read.format("paged").option("offset", 33).option("page_size", 20).load()
    assert sorted(json.loads(r["value"])["n"] for r in df.collect()) == list(range(33, 250))
    assert df.select(F.get_json_object("value", "$.t")).first()[0] == "é"


def test_http_gives_up_loudly_after_its_retries():
    pages = HttpPages("http://x/lines", retries=2, wait=0, opener=FakeService(5, broken=3))
    with pytest.raises(urllib.error.URLError):
        pages.total()
    assert [json.loads(v)["n"] for v, in pages.page(3, 10)] == [3, 4]


def test_http_asks_for_exact_rows_on_the_last_short_page():
    from energylake.sources.paged import PageRun, _pull

    service = FakeService(1000)
    got = list(_pull(HttpPages("http://x", opener=service), PageRun(900, 957, 25)))
    assert len(got) == 57
    assert [(int(a["from"]), int(a["size"])) for a in service.asked] == [(900, 25), (925, 25), (950, 7)]
