"""What the operators share: tables, shipping of this package, written intermediate tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Python workers live on between tasks: freed arrays go back to the system.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": "4194304",
    "MALLOC_TRIM_THRESHOLD_": "16777216",
}
#: Rows per Arrow batch: documents may be long, and a batch is held on both sides.
BATCH_ROWS = 300


def ship(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, unless it is installed or sent.

    Arrow batches are kept to ``BATCH_ROWS`` rows where the session has Spark's default of 10,000.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        if name not in os.environ:
            env.setdefault(name, value)
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a lost executor loses none of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
