"""Histogram tables with NumPy's edge rules (last bin closed on both sides)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import edges_between
from .scalars import bin_by_edges


def equal_width_hist(df: DataFrame, value: str, bins: int, weight: str | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins included."""
    spread = df.agg(
        F.min(F.col(value).cast("double")).alias("lo"), F.max(F.col(value).cast("double")).alias("hi")
    )
    limits = spread.select(F.struct("lo", "hi")).scalar()
    tagged = df.where(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("_v"),
        _weight(weight).alias("_w"),
        limits["lo"].alias("_lo"),
        limits["hi"].alias("_hi"),
    )
    return binned(tagged, bins)


def frequency_hist(freq: DataFrame, value: str, weight: str, bins: int) -> DataFrame:
    """Same bins over a (value, count) table.

    For whole-number values with counts: there are at most sqrt(2N) distinct
    sizes among N things, so the unpartitioned window stays small.
    """
    everything = Window.partitionBy()
    v = F.col(value).cast("double")
    tagged = freq.select(
        v.alias("_v"),
        F.col(weight).alias("_w"),
        F.min(v).over(everything).alias("_lo"),
        F.max(v).over(everything).alias("_hi"),
    )
    return binned(tagged, bins)


def binned(tagged: DataFrame, bins: int) -> DataFrame:
    """Counts per bin for rows (_v, _w, _lo, _hi); a single value gets NumPy's +-0.5 range."""
    flat = F.col("_lo") == F.col("_hi")
    lo = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi = F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    rows = tagged.select("_v", "_w", lo.alias("_lo"), hi.alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    guess = F.least(F.floor((F.col("_v") - F.col("_lo")) / step), F.lit(bins - 1))
    # Move values that rounding put on the wrong side of their bin's own edge.
    rows = rows.withColumn("_g", guess).withColumn(
        "_bin",
        F.when(F.col("_v") < F.col("_lo") + F.col("_g") * step, F.col("_g") - 1)
        .when(
            (F.col("_v") >= F.col("_lo") + (F.col("_g") + 1) * step) & (F.col("_g") < bins - 1),
            F.col("_g") + 1,
        )
        .otherwise(F.col("_g")),
    )
    counts = rows.groupBy(F.col("_bin").cast("int").alias("bin")).agg(
        F.sum("_w").alias("n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    return _with_empty_bins(counts, bins, edges_between(F.col("_lo"), F.col("_hi"), bins))


def fixed_hist(df: DataFrame, value: str, edges: list[float], weight: str | None = None) -> DataFrame:
    """Counts between given edges; values outside them are left out."""
    v = F.col(value).cast("double")
    bins = len(edges) - 1
    counts = (
        df.where((v >= edges[0]) & (v <= edges[-1]))
        .select(F.least(bin_by_edges(v, edges), F.lit(bins - 1)).alias("bin"), _weight(weight).alias("_w"))
        .groupBy("bin")
        .agg(F.sum("_w").alias("n"))
    )
    return _with_empty_bins(counts, bins, F.array(*[F.lit(float(e)) for e in edges]))


def _with_empty_bins(counts: DataFrame, bins: int, edges) -> DataFrame:
    """All bins with their edges; ``counts`` has at most ``bins`` rows."""
    extra = [F.max(c).alias(c) for c in counts.columns if c not in ("bin", "n")]
    packed = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts"), *extra
    )
    return (
        packed.withColumn("_edges", edges)
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            F.col("bin").cast("long").alias("bin"),
            F.col("_edges")[F.col("bin")].alias("lower"),
            F.col("_edges")[F.col("bin") + 1].alias("upper"),
            F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0)).cast("long").alias("n"),
        )
    )


def _weight(weight: str | None):
    return F.lit(1).cast("long") if weight is None else F.col(weight)
