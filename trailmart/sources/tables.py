"""Typed CSV readers, parquet in and out, models, and the table profile."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import safe_long

# Numbers that may be unparsable are read as text, so cleaning can count them; ids may be written ``257597.0``.
EVENT_SCHEMA = "timestamp string, visitorid string, event string, itemid string, transactionid string"
PROPERTY_SCHEMA = "timestamp string, itemid string, property string, value string"
CATEGORY_SCHEMA = "categoryid string, parentid string"


def read_events(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    return _whole_ids(spark.read.schema(schema).csv(path, header=True), "visitorid", "itemid", "transactionid")


def _whole_ids(df: DataFrame, *ids: str) -> DataFrame:
    return df.withColumns({c: safe_long(c) for c in ids if c in df.columns})


def read_properties(spark: SparkSession, paths: list[str], schema: str = PROPERTY_SCHEMA) -> DataFrame:
    """All part files as one table."""
    return _whole_ids(spark.read.schema(schema).csv(list(paths), header=True), "itemid")


def read_categories(spark: SparkSession, path: str, schema: str = CATEGORY_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def metrics_table(one_row: DataFrame) -> DataFrame:
    """A one-row report as (metric, value) rows."""
    values = one_row.select([F.col(c).cast("double").alias(c) for c in one_row.columns])
    return values.unpivot([], values.columns, "metric", "value")


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each named table."""
    profiles = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def table_bytes(spark: SparkSession, path: str) -> int | None:
    """Stored size of a path, None when it does not exist."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength() if fs.exists(target) else None


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, paths: list[str]) -> PipelineModel:
    """The first model that exists, in the given order."""
    for path in paths:
        if table_bytes(spark, path) is not None:
            return PipelineModel.load(path)
    raise FileNotFoundError(f"no model at any of {paths}")
