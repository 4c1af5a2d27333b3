"""Stored tables: schema-checked reads and batch-partitioned appends."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, in its order and types."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def write_batch(df: DataFrame, root: str, table: str, schema: T.StructType, batch_id: str) -> None:
    """Append one batch. Written as its own partition, so writing it again replaces it."""
    conform(df, schema).write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")


def append(df: DataFrame, root: str, table: str, schema: T.StructType, batch_id: str) -> None:
    """Append rows beside the ones a batch already has."""
    conform(df, schema).write.mode("append").parquet(f"{root}/{table}/batch_id={batch_id}")


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folders(spark: SparkSession, path: str, part: str = "batch_id") -> list[str]:
    """Values of the partition folders ``part=value`` right below a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not exists(spark, path):
        return []
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return sorted(n.removeprefix(f"{part}=") for n in names if n.startswith(f"{part}="))


def newest_file(spark: SparkSession, path: str) -> int | None:
    """Time of the newest file at any depth below a path, in microseconds; None without files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    newest = None
    while files.hasNext():
        newest = max(newest or 0, files.next().getModificationTime() * 1000)
    return newest


def read_parts(spark: SparkSession, root: str, table: str, schema: T.StructType, part: str, values: list[str]) -> DataFrame:
    """The batches in the folders ``part=value`` of a table alone; other folders aren't even listed."""
    with_batch = T.StructType([*schema.fields, T.StructField(part, T.StringType()), T.StructField("batch_id", T.StringType())])
    paths = [p for p in (f"{root}/{table}/{part}={value}" for value in sorted(values)) if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).option("basePath", f"{root}/{table}").parquet(*paths)


def read_batches(spark: SparkSession, root: str, table: str, schema: T.StructType, attempts: list[str]) -> DataFrame:
    """The named folders of a table alone, as they were listed: one that is added meanwhile isn't read."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    if not attempts:
        return spark.createDataFrame([], with_batch)
    paths = [f"{root}/{table}/batch_id={a}" for a in attempts]
    return spark.read.schema(with_batch).option("basePath", f"{root}/{table}").parquet(*paths)


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """All batches of a table with their ``batch_id``; empty before the first one."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    try:
        return spark.read.schema(with_batch).parquet(f"{root}/{table}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_batch)
