"""Exact positions, fills and quantiles without one-task windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Fixed value: monotonically_increasing_id keeps the partition number above this many bits.
_ROW_BITS = 33
# Bins per look of exact_quantiles.
_BINS = 2048


def with_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """Dense 1-based position in the given total order.

    Spark's range sort splits on the whole sort key and is written once; a row
    then only needs the number of rows in the sorted partitions before its own.
    """
    numbered = df.sort(*order).select("*", F.monotonically_increasing_id().alias("_row"))
    rows = materialise(numbered).withColumn("_part", F.shiftright("_row", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, so this window and broadcast are bounded by
    # spark.sql.shuffle.partitions.
    starts = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    offset = F.col("_row") - F.shiftleft("_part", _ROW_BITS)
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + offset + 1)
        .drop("_part", "_row", "_start")
    )


def exact_quantiles(
    df: DataFrame, col: str, probs: list[float], weight: str | None = None, keep: bool = True
) -> list[float | None]:
    """Linear-interpolation quantiles of ``col`` as plain numbers, without a sort or shuffle.

    Counts values in even bins, then looks again only into the bins that hold a
    wanted rank, from their smallest to their largest value, until a bin is one
    value or few rows. Each look is one scan with counts folded in every task;
    the driver sees at most ``_BINS`` rows per wanted rank. A value that fills a
    third of the table becomes a bin of its own. ``keep=False`` when ``df`` is
    persisted or cheap to read again.
    """
    return exact_quantiles_of(df, {col: probs}, weight, keep)[col]


def exact_quantiles_of(
    df: DataFrame, wanted: dict[str, list[float]], weight: str | None = None, keep: bool = True
) -> dict[str, list[float | None]]:
    """``exact_quantiles`` of several columns, all in the same scans of one kept projection of ``df``."""
    size = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    # NaN counts as missing.
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in wanted]
    kept = df.select(*numbers, size.alias("_w"))
    if keep:
        kept.persist()
    try:
        cells = [F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(wanted)]
        values = kept.select(F.explode(F.array(*cells)).alias("_e"), "_w").select("_e.c", "_e.v", F.col("_w").alias("w"))
        found = _quantiles(values.where("v is not null"), list(wanted.values()))
    finally:
        if keep:
            kept.unpersist()
    return dict(zip(wanted, found))


def _quantiles(values: DataFrame, wanted: list[list[float]]) -> list[list[float | None]]:
    """Quantiles of the values ``v`` of each column number ``c``."""
    # Infinities are counted, not binned: they come before and after all finite values.
    endless = F.abs("v") == float("inf")
    stats = values.groupBy("c").agg(
        F.sum("w").alias("n"),
        F.coalesce(F.sum(F.when(endless & (F.col("v") < 0), F.col("w"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(endless & (F.col("v") > 0), F.col("w"))), F.lit(0)).alias("above"),
        F.min(F.when(~endless, F.col("v"))).alias("lo"),
        F.max(F.when(~endless, F.col("v"))).alias("hi"),
    )
    whole = {r.c: r for r in stats.collect()}  # one row per column
    found: list[dict[int, float]] = [{} for _ in wanted]
    # Open ranges of values: (column, lowest, highest, rows before, rows inside) -> ranks wanted there.
    open_ranges: dict = {}
    for c, probs in enumerate(wanted):
        if c not in whole or not whole[c].n:
            continue
        r = whole[c]
        last = r.n - 1
        ranks = sorted({k for p in probs for k in (math.floor(p * last), min(math.floor(p * last) + 1, last))})
        found[c].update({k: -math.inf for k in ranks if k < r.below})
        found[c].update({k: math.inf for k in ranks if k >= r.n - r.above})
        inside = [k for k in ranks if k not in found[c]]
        if inside:
            open_ranges[c, r.lo, r.hi, r.below, r.n - r.below - r.above] = inside
    while open_ranges:
        # A range of one value needs no look.
        for (c, lo, hi, _, _), ranks in open_ranges.items():
            if lo == hi:
                found[c].update(dict.fromkeys(ranks, lo))
        open_ranges = {r: ranks for r, ranks in open_ranges.items() if r[1] < r[2]}
        if open_ranges:
            open_ranges = _look_closer(values, open_ranges)
    return [
        [_between(found[c], p, whole[c].n - 1) for p in probs] if c in whole and whole[c].n else [None] * len(probs)
        for c, probs in enumerate(wanted)
    ]


def _between(found: dict[int, float], p: float, last: int) -> float:
    low = math.floor(p * last)
    a, b, t = found[low], found[min(low + 1, last)], p * last - low
    if a == b or t == 0:
        return a
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)


def _look_closer(values: DataFrame, open_ranges: dict) -> dict:
    """The bins of the open ranges that hold the wanted ranks, as new ranges; one scan for all columns."""
    spans = list(open_ranges)
    v, which, bin_no = F.col("v"), F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for number, (c, lo, hi, _, _) in enumerate(spans):
        inside = (F.col("c") == c) & (v >= lo) & (v <= hi)
        which = F.when(inside, F.lit(number)).otherwise(which)
        # Halves keep the width of a very long range finite.
        spot = F.floor((v / 2 - F.lit(lo / 2)) / F.lit(max(hi / 2 - lo / 2, 5e-324)) * _BINS)
        bin_no = F.when(inside, spot).otherwise(bin_no)
    bins = (
        values.select("v", "w", which.alias("span"), bin_no.alias("bin"))
        .where(F.col("span").isNotNull())
        .groupBy("span", "bin")
        .agg(F.sum("w").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()  # at most _BINS + 1 rows per open range
    )
    closer: dict = {}
    for number, span in enumerate(spans):
        ranks, before = open_ranges[span], span[3]
        for b in sorted((b for b in bins if b.span == number), key=lambda b: b.lo):
            here = [r for r in ranks if before <= r < before + b.n]
            if here:
                closer[(span[0], b.lo, b.hi, before, b.n)] = here
            before += b.n
    return closer


def carry_forward_by_id(df: DataFrame, key: str, value: str) -> DataFrame:
    """Fill null ``value`` with the last one at a smaller ``key``.

    The rows are range-sorted and written once; a row then looks back inside its own sort partition, and from
    there to the last value of the partitions before. Rows of a null key come first.
    """
    sorted_rows = df.sort(F.asc_nulls_first(key)).select("*", F.spark_partition_id().alias("_part"))
    rows = materialise(sorted_rows)
    so_far = Window.partitionBy("_part").orderBy(F.asc_nulls_first(key)).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    place = F.when(F.col(value).isNotNull(), F.struct(F.col(key).isNotNull(), F.col(key)))
    # One row per sort partition, as in with_position.
    lasts = rows.groupBy("_part").agg(F.max_by(value, place).alias("_last"))
    lasts = lasts.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_prior"))
    own = F.last(value, ignorenulls=True).over(so_far)
    return (
        rows.withColumn("_own", own)
        .join(F.broadcast(lasts), "_part")
        .withColumn(value, F.coalesce("_own", "_prior"))
        .drop("_part", "_own", "_prior")
    )


def carry_forward(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Fill null ``values`` with the key's last value before, by ``order``; each column by itself.

    One range sort over key and order deals the rows evenly, so a key with most of the rows is cut by time over many
    tasks. A row looks back inside its own sort partition; a key that began in an earlier partition gets the last value
    from there (one row per partition). Rows of a null key get nothing.
    """
    by = [F.asc_nulls_first(c) for c in (key, *order)]
    rows = materialise(df.sort(*by).select("*", F.spark_partition_id().alias("_part")))
    so_far = Window.partitionBy("_part", key).orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # The last value of a sort partition is the one at its largest (key, order): it can only matter to that key.
    place = [F.struct(F.col(key).alias("key"), *order, F.col(v).alias("value")) for v in values]
    lasts = rows.groupBy("_part").agg(
        *[F.max(F.when(F.col(v).isNotNull(), p)).alias(f"_last{i}") for i, (v, p) in enumerate(zip(values, place))]
    )
    lasts = lasts.select("_part", *[F.last(f"_last{i}", ignorenulls=True).over(earlier).alias(f"_prior{i}") for i in range(len(values))])
    own = [F.last(v, ignorenulls=True).over(so_far).alias(f"_own{i}") for i, v in enumerate(values)]
    rows = rows.select("*", *own).join(F.broadcast(lasts), "_part")
    known = F.col(key).isNotNull()
    return rows.withColumns(
        {
            v: F.when(known, F.coalesce(f"_own{i}", F.when(F.col(f"_prior{i}.key") == F.col(key), F.col(f"_prior{i}.value"))))
            for i, v in enumerate(values)
        }
    ).select(*df.columns)


def edges_between(low: Column, high: Column, bins: int) -> Column:
    """``bins + 1`` evenly spaced edges, the last one exactly ``high``."""
    step = (high - low) / F.lit(float(bins))
    inner = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: low + i.cast("double") * step
    )
    return F.concat(inner, F.array(high))
