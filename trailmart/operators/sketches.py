"""Distinct counts and quantiles of any range of days, from one small row per day.

A day's row has two HyperLogLog sketches (visitors, items) and a KLL sketch (events per visitor of the day). Rows of a
range are merged; a new day adds a row and reads that day only. Sketches have a fixed size, whatever the day's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HyperLogLog: 2 to this power buckets, a standard error of 1.04 / 64. KLL: a rank error of 1.65 % at 99 %.
LG_K = 12
KLL_K = 200
DISTINCT_ERROR = 3 * 1.04 / 64
RANK_ERROR = 0.0165


def daily_sketches(ev: DataFrame) -> DataFrame:
    """(date, events, visitors, items, lengths): one row per day, sketches folded in each task before the shuffle."""
    dated = ev.where(F.col("visitorid").isNotNull()).withColumn("date", F.to_date("timestamp"))
    counts = dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("events"),
        F.hll_sketch_agg("visitorid", LG_K).alias("visitors"),
        F.hll_sketch_agg("itemid", LG_K).alias("items"),
    )
    lengths = dated.groupBy("date", "visitorid").agg(F.count(F.lit(1)).alias("_n"))
    lengths = lengths.groupBy("date").agg(F.kll_sketch_agg_bigint("_n", KLL_K).alias("lengths"))
    return counts.join(lengths, "date")


def write_days(sketches: DataFrame, path: str) -> str:
    """Store days; a day that is there already is replaced, the others stay."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    return path


def merged(days: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """One row: events, visitors, items, visitor_days and quantiles ``q50`` ... of events per visitor and day."""
    one = days.agg(
        F.sum("events").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors"),
        F.hll_sketch_estimate(F.hll_union_agg("items")).alias("items"),
        F.kll_merge_agg_bigint("lengths").alias("_kll"),
    )
    values = [F.kll_sketch_get_quantile_bigint("_kll", F.lit(q)).alias(f"q{round(q * 100)}") for q in quantiles]
    return one.select("events", "visitors", "items", F.kll_sketch_get_n_bigint("_kll").alias("visitor_days"), *values)
