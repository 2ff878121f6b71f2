"""Tables stored by item, so that windows and joins by item read them where they lie.

A bucketed table has its rows dealt by a hash of the key and sorted inside each bucket. Windows and joins by that key
need no shuffle, whatever the session's number of shuffle partitions. The tables are in the session's catalog: on a
cluster they live in the warehouse that all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Enough for some 100 TB of events: an item-day table of 2 TB has buckets of 500 MB. Readers may share buckets.
BUCKETS = 4096


def write_bucketed(df: DataFrame, table: str, key: str, order: list[str], buckets: int = BUCKETS, path: str | None = None) -> str:
    """``df`` as a bucketed, sorted table. Each bucket is written by one task: one file per bucket.

    With a ``path`` the files lie there and outlive the catalog entry.
    """
    writer = df.repartition(buckets, F.col(key)).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
