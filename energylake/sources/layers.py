"""Bronze, silver and gold tables, and small JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energylake import fixed_values as fv
from energylake.functions.columns import col

CORRUPT = "_corrupt_record"
RECORD, OTHERS = "_record", "_others"
FILE_ROWS = 100_000


def dwelling_schema() -> T.StructType:
    """Declared schema of the records, so that reading bronze needs no inference scan.

    The never-analysed columns are left out: the reader skips them while parsing.
    """
    texts = [*fv.LABEL_COLUMNS, *fv.INSULATION_COLUMNS, *fv.CATEGORY_FEATURES]
    numbers = [c for c in dict.fromkeys([
        *fv.CRITICAL_COLUMNS, *fv.ZERO_COLUMNS, *fv.MEDIAN_COLUMNS, *fv.CLIPPED_COLUMNS,
        *fv.LOG_COLUMNS, *fv.NUMBER_FEATURES]) if c not in texts]
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in texts]
        + [T.StructField(c, T.DoubleType()) for c in numbers]
        + [T.StructField(c, T.BooleanType()) for c in fv.BOOLEAN_COLUMNS])


def parse_bronze(spark: SparkSession, path: str | Sequence[str], known: T.StructType | None = None,
                 skipped: Sequence[str] = ()) -> DataFrame:
    """JSON lines read once: the known fields, all others as text in a map, the partition columns.

    No scan for field names comes before.  The map holds the JSON text of each other field but
    the skipped ones and those named like a partition; ``with_others`` makes columns of it once
    the rows are staged.  A line that is no JSON object has no field at all; blank lines are no rows.
    """
    known = known or dwelling_schema()
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parts = [c for c in lines.columns if c != "value"]
    fields = T.StructType([f for f in known.fields if f.name not in parts])
    left = {*fields.names, *skipped, *parts}
    others = F.map_filter(F.from_json("value", "map<string,string>"),
                          lambda name, value: ~name.isin(*left) & value.isNotNull())
    return (lines.withColumns({RECORD: F.from_json("value", fields), OTHERS: others})
            .select(*[F.col(RECORD)[n].alias(n) for n in fields.names], OTHERS, *[col(c) for c in parts]))


def with_others(rows: DataFrame) -> DataFrame:
    """The rows of ``parse_bronze`` with a text column for each name in their map, in order of name.

    The names are collected from the staged map column alone; they are bounded by what the
    source sends.
    """
    names = sorted(r[0] for r in rows.select(F.explode(F.map_keys(OTHERS))).distinct().collect())
    return rows.select(*[col(c) for c in rows.columns if c != OTHERS],
                       *[F.try_element_at(OTHERS, F.lit(n)).alias(n) for n in names])


def read_bronze(spark: SparkSession, path: str | Sequence[str],
                schema: T.StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines directory with its partition columns.

    Without a schema the types are inferred over all files, which reads the data
    once more.  ``keep_corrupt`` keeps the text of unreadable lines.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    return reader.json(path)


def write_bronze(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """JSON lines as gzip at its fastest level, so that a fraction of the text's bytes is written.

    A reader can't split such a file, so none holds more than ``FILE_ROWS`` rows.
    """
    (df.write.options(compression="gzip", maxRecordsPerFile=FILE_ROWS).option("zlib.compress.level", "BEST_SPEED")
     .partitionBy(*partition_by).json(path))


def read_layer(spark: SparkSession, path: str | Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table under a prefix; fails when there is none."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select([col(c) for c in columns]) if columns else df


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that the rows fall into; all others keep their files.

    Spark writes beside the table and swaps each partition directory when the whole job has
    ended, so a failed job changes nothing.  A reader that lists the table during the swaps may see
    some partitions new and some old.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_json_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON documents that hold one object or one array of objects each."""
    return spark.read.option("multiLine", True).json(path)


def write_json_table(df: DataFrame, path: str, bound: int = 10_000) -> None:
    """Small table as one JSON array document; refuses more than ``bound`` rows.

    The table is run once, and no more than ``bound`` rows and one come to the driver.
    """
    record = F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    records = [r[0] for r in df.select(record).limit(bound + 1).collect()]
    if len(records) > bound:
        raise ValueError(f"more than {bound} rows are a table, not a document")
    (df.sparkSession.createDataFrame([("[" + ",".join(records) + "]",)], "value string")
     .coalesce(1).write.mode("overwrite").text(path))


def bi_export(df: DataFrame) -> DataFrame:
    """All columns in types any reporting tool takes.

    Numbers, booleans and timestamps stay; everything else becomes text, with
    ``""`` for null.
    """
    plain = (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType)

    def exported(field: T.StructField):
        if isinstance(field.dataType, plain) and not isinstance(field.dataType, T.DecimalType):
            return col(field.name)
        return F.coalesce(col(field.name).cast("string"), F.lit("")).alias(field.name)

    return df.select([exported(f) for f in df.schema.fields])
