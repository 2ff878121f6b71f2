"""Running totals inside groups of any size: no group is ever one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import fresh, written

#: Copies of one row handed out at a time.
RUN = 4096


def offsets(rows: DataFrame, group: str, order: list[str], weight: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the weights of the group's rows that come before, by ``order`` (nulls first).

    One range sort over group and order deals the rows to tasks of even size, however large a group is, and is
    written once. A row adds up the rows before it in its own sort partition; the partitions before add one
    number each. Rows equal in group and order share a sort partition, so fold such copies to one row with a
    count before. ``group`` has no nulls.
    """
    part, before, at = (fresh(rows, n) for n in ("_part", "_before", "_at"))
    by = [F.asc_nulls_first(c) for c in order]
    kept = rows.withColumn(at, weight.cast("bigint")).sort(F.asc(group), *by)
    kept = written(kept.withColumn(part, F.spark_partition_id()), "sorted")
    sums = kept.groupBy(group, part).agg(F.sum(at).alias(before))
    # One row per sort partition the group reaches into.
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(group, part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(at).over(inside), F.lit(0))
    return kept.join(sums, [group, part]).withColumn(name, own + F.col(before)).select(*rows.columns, name)


def copies(rows: DataFrame, number: str, at: str) -> DataFrame:
    """Each row ``number`` times, ``at`` going up by one, in runs so that no array is long."""
    zero, run = F.lit(0).cast("bigint"), F.lit(RUN).cast("bigint")
    rows = rows.select("*", F.explode(F.sequence(zero, F.col(number) - 1, run)).alias("_run"))
    inside = F.sequence(zero, F.least(run, F.col(number) - F.col("_run")) - 1)
    return rows.select("*", F.explode(inside).alias("_in")).withColumn(at, F.col(at) + F.col("_run") + F.col("_in")).drop("_run", "_in")
