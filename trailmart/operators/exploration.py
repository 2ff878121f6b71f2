"""Volumes, sessions, funnel, popularity, visitor lengths and gaps."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.histograms import fixed_hist, frequency_hist
from ..functions.ordering import edges_between, exact_quantiles, with_position
from ..functions.scalars import time_block
from ..params import Params
from ..session import materialise

DEFAULTS = Params()
# Gap histogram edges in seconds.
GAP_EDGES = [0, 60, 300, 600, 900, 1200, 1800]


def missing_pct(df: DataFrame) -> DataFrame:
    shares = df.agg(
        *[F.bround(F.avg(F.col(c).isNull().cast("double")) * 100, 1).alias(c) for c in df.columns]
    )
    return shares.unpivot([], shares.columns, "column", "missing_pct")


def missing_pct_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column, missing_pct) of every column of the named tables."""
    parts = [missing_pct(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def event_type_counts(ev: DataFrame) -> DataFrame:
    return ev.groupBy("event").agg(F.count(F.lit(1)).alias("n"))


def daily_volume(ev: DataFrame, dense: bool = False) -> DataFrame:
    """Events per day; ``dense`` adds the calendar days without any."""
    daily = (
        ev.where(F.col("timestamp").isNotNull())
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if not dense:
        return daily
    # Work from the daily counts alone: one row per day, so one small list.
    span = daily.agg(
        F.sequence(F.min("date"), F.max("date")).alias("_days"),
        F.map_from_entries(F.collect_list(F.struct("date", "n"))).alias("_n"),
    )
    return span.select(F.explode("_days").alias("date"), "_n").select(
        "date", F.coalesce(F.try_element_at("_n", F.col("date")), F.lit(0)).cast("bigint").alias("n")
    )


def hourly_volume(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def hour_weekday_heatmap(ev: DataFrame) -> DataFrame:
    """Events by hour (rows) and weekday (columns ``wday_0`` = Monday to ``wday_6``)."""
    day = F.weekday("timestamp")
    cells = [
        F.count_if((day == i) & F.col("visitorid").isNotNull()).cast("double").alias(f"wday_{i}")
        for i in range(7)
    ]
    return ev.where(F.col("timestamp").isNotNull()).groupBy(F.hour("timestamp").alias("hour")).agg(*cells)


# sessions -------------------------------------------------------------------


def session_blocks(
    ev: DataFrame,
    gap_minutes: int = DEFAULTS.session_gap_minutes,
    events: tuple[str, ...] = DEFAULTS.allowed_events,
) -> DataFrame:
    """One row per visitor and time block with its session number and event counts.

    A block is as wide as the gap, so no session can break inside one: the
    events of a block fold into one row before the shuffle, and the numbering
    window sees at most one row per visitor and block of the calendar.
    """
    gap = gap_minutes * 60
    counts = [F.count_if(F.col("event") == e).alias(e) for e in events]
    blocks = (
        ev.where(F.col("timestamp").isNotNull())
        .groupBy("visitorid", time_block("timestamp", gap).alias("_block"))
        .agg(
            F.min(F.unix_micros("timestamp")).alias("_from"),
            F.max(F.unix_micros("timestamp")).alias("_to"),
            F.count(F.lit(1)).alias("events"),
            *counts,
        )
    )
    w = Window.partitionBy("visitorid").orderBy("_block")
    pause = F.col("_from") - F.lag("_to").over(w)
    starts = F.when(pause.isNull() | (pause > gap * 1_000_000), 1).otherwise(0)
    return blocks.withColumn("_new", starts).withColumn("session", F.sum("_new").over(w)).drop("_new")


def sessionize(ev: DataFrame, gap_minutes: int = DEFAULTS.session_gap_minutes) -> DataFrame:
    """Events with the visitor's session number; a gap longer than the limit starts one.

    The join key has the time block in it, which spreads a busy visitor.
    """
    numbered = session_blocks(ev, gap_minutes, ()).select("visitorid", "_block", "session")
    keyed = ev.withColumn("_block", time_block("timestamp", gap_minutes * 60))
    return keyed.join(numbered, ["visitorid", "_block"], "left").drop("_block")


def session_counts(blocks: DataFrame, global_key: bool = False) -> DataFrame:
    """Event counts per session; ``global_key`` groups by the number alone, across visitors."""
    keys = ["session"] if global_key else ["visitorid", "session"]
    values = [c for c in blocks.columns if c not in ("visitorid", "session") and not c.startswith("_")]
    return blocks.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def session_lengths(ev: DataFrame, gap_minutes: int = 30, global_key: bool = False) -> DataFrame:
    counts = session_counts(session_blocks(ev, gap_minutes, ()), global_key)
    return counts.withColumnRenamed("events", "length")


def clipped_hist(lengths: DataFrame, col: str, p: float = 0.95, bins: int = 30) -> DataFrame:
    """Histogram of whole-number sizes up to their ``p`` quantile."""
    freq = _size_counts(lengths, col)
    cut = F.expr(f"percentile({col}, {p}D, n) over ()")
    return frequency_hist(freq.withColumn("_cut", cut).where(f"{col} <= _cut"), col, "n", bins)


def session_funnel(ev: DataFrame, gap_minutes: int = 30, global_key: bool = False) -> DataFrame:
    """Events of each kind per session."""
    return session_counts(session_blocks(ev, gap_minutes), global_key).drop("events")


def funnel_rates(funnel: DataFrame) -> DataFrame:
    """Share of all sessions with both steps, and the share among those with the first."""
    viewed, added, bought = (F.col(c) > 0 for c in ("view", "addtocart", "transaction"))

    def share(when):
        return F.avg(when.cast("double"))

    def given(when, base):
        return F.avg(F.when(base, when.cast("double")))

    return funnel.agg(
        F.count(F.lit(1)).alias("sessions"),
        share(viewed & added).alias("view_to_cart"),
        share(added & bought).alias("cart_to_transaction"),
        given(added, viewed).alias("view_to_cart_given_view"),
        given(bought, added).alias("cart_to_transaction_given_cart"),
    )


# popularity -----------------------------------------------------------------


def item_popularity(ev: DataFrame, top: int | None = None) -> DataFrame:
    counts = (
        ev.where(F.col("itemid").isNotNull()).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts if top is None else counts.orderBy(F.desc("n"), "itemid").limit(top)


def popularity_steps(popularity: DataFrame) -> DataFrame:
    """One row per distinct count: items with it, and items and events before it.

    N events have at most sqrt(2N) distinct counts, so the unpartitioned
    windows stay small at any scale.
    """
    before = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    steps = popularity.groupBy("n").agg(F.count(F.lit(1)).alias("items"))
    return steps.select(
        "n",
        "items",
        F.coalesce(F.sum("items").over(before), F.lit(0)).alias("items_before"),
        F.coalesce(F.sum(F.col("items") * F.col("n")).over(before), F.lit(0)).alias("events_before"),
        F.sum(F.col("items") * F.col("n")).over(everything).alias("total"),
    )


def long_tail(ev: DataFrame) -> DataFrame:
    """Rank of each item by count and the share of events covered up to it."""
    popularity = item_popularity(ev)
    ranked = with_position(popularity, [F.desc("n"), "itemid"], "rank")
    covered = F.col("events_before") + (F.col("rank") - F.col("items_before")) * F.col("n")
    # From the written ranks: the events are counted once.
    steps = popularity_steps(ranked.select("itemid", "n")).drop("items")
    return ranked.join(steps, "n").select(
        "itemid", "n", "rank", (covered / F.col("total")).alias("cum_share")
    )


def coverage_items(ev: DataFrame, thresholds: tuple[str, ...] = ("0.5", "0.8", "0.9")) -> DataFrame:
    """Number of top items that cover a share of the events, in whole-number arithmetic."""
    catalog = F.sum("items").over(Window.partitionBy()).alias("catalog")
    steps = popularity_steps(item_popularity(ev)).select("*", catalog)
    cases = []
    for t in thresholds:
        share = Fraction(t)
        need = F.lit(share.numerator) * F.col("total") - F.lit(share.denominator) * F.col("events_before")
        per_item = F.lit(share.denominator) * F.col("n")
        extra = F.ceil(need / per_item).cast("bigint")
        extra = F.greatest(extra, F.lit(1).cast("bigint"))
        inside = (need > 0) & (need <= per_item * F.col("items"))
        cases.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.when(inside, F.col("items_before") + extra).alias("items_needed"),
            )
        )
    found = (
        steps.select(F.explode(F.array(*cases)).alias("c"), "catalog")
        .where(F.col("c.items_needed").isNotNull())
        .select("c.threshold", "c.items_needed", "catalog")
    )
    # Where the coverage plot ends: a fifth beyond the needed items.
    cut = F.least(F.floor(F.col("items_needed") * F.lit(1.2)), F.col("catalog"))
    return found.withColumn("plot_cut", cut.cast("bigint")).drop("catalog")


def topk_coverage(ev: DataFrame, ks: tuple[int, ...] = (10, 100)) -> DataFrame:
    """Share of events of the ``k`` most popular items; a short catalog is covered whole."""
    steps = popularity_steps(item_popularity(ev))
    shares = []
    for k in ks:
        taken = F.least(F.greatest(F.lit(k) - F.col("items_before"), F.lit(0)), F.col("items"))
        shares.append((F.sum(taken * F.col("n")) / F.max("total")).alias(str(k)))
    wide = steps.agg(*shares)
    long = wide.unpivot([], wide.columns, "k", "share")
    return long.select(F.col("k").cast("bigint").alias("k"), "share")


# visitors -------------------------------------------------------------------


def visitor_lengths(ev: DataFrame, min_events: int = 2) -> DataFrame:
    counts = (
        ev.where(F.col("visitorid").isNotNull())
        .groupBy("visitorid")
        .agg(F.count(F.lit(1)).alias("length"))
    )
    return counts.where(F.col("length") >= min_events)


def visitor_length_hist(ev: DataFrame, bins: int = 14, p: float = 0.99) -> DataFrame:
    """Even bins from 2 to the ``p`` quantile; longer visitors are left out."""
    freq = _size_counts(visitor_lengths(ev), "length").withColumn(
        "_hi", F.expr(f"percentile(length, {p}D, n) over ()")
    )
    edges = edges_between(F.lit(2.0), F.col("_hi"), bins)
    at_or_below = F.size(F.filter("_edges", lambda e: e <= F.col("length")))
    counts = (
        freq.withColumn("_edges", edges)
        .where(F.col("length") <= F.col("_hi"))
        .groupBy(F.least(at_or_below - 1, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("n").alias("n"), F.max("_hi").alias("_hi"))
    )
    packed = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"), F.max("_hi").alias("_hi")
    )
    return (
        packed.withColumn("_edges", edges)
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            F.col("bin").cast("bigint").alias("bin"),
            F.col("_edges")[F.col("bin")].alias("lower"),
            F.col("_edges")[F.col("bin") + 1].alias("upper"),
            F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
        )
    )


def visitor_length_bands(ev: DataFrame, short: int = 5, long: int = 15) -> DataFrame:
    """Visitors in the short, medium and long bands marked on the length plot."""
    n = F.col("length")
    band = F.when(n <= short, "short").when(n <= long, "medium").otherwise("long")
    return visitor_lengths(ev).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("visitors"))


def visitor_length_stats(ev: DataFrame) -> DataFrame:
    freq = _size_counts(visitor_lengths(ev), "length")
    return freq.agg(
        F.expr("percentile(length, 0.5D, n)").alias("median"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
        F.expr("percentile(length, 0.95D, n)").alias("p95"),
    )


def inter_event_gaps(ev: DataFrame) -> DataFrame:
    """(visitorid, gap_seconds, pairs): gaps between a visitor's consecutive events.

    Events of one instant fold into a row first; they are ``n - 1`` gaps of
    zero. Gaps are then found inside visitor-hours, and across hours from the
    first and last instant of each, so a busy visitor is many small windows: an
    hour has at most 3.6 million distinct milliseconds. Both parts read the same
    shuffled instants: they ask for the same columns of them.
    """
    usable = ev.where(F.col("visitorid").isNotNull() & F.col("timestamp").isNotNull())
    micros = F.unix_micros("timestamp")
    instants = usable.groupBy(
        "visitorid", time_block("timestamp", 3_600).alias("_hour"), micros.alias("_at")
    ).agg(F.count(F.lit(1)).alias("_n"))
    hour = Window.partitionBy("visitorid", "_hour")
    placed = instants.select("*", F.lag("_at").over(hour.orderBy("_at")).alias("_before"), F.max("_at").over(hour).alias("_last"))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    within = (
        placed.select(
            "visitorid",
            F.explode(
                F.array(
                    F.struct((F.col("_at") - F.col("_before")).alias("gap"), one.alias("pairs")),
                    F.struct(none.alias("gap"), (F.col("_n") - 1).alias("pairs")),
                )
            ).alias("g"),
        )
        .select("visitorid", "g.gap", "g.pairs")
        .where(F.col("gap").isNotNull() & (F.col("pairs") > 0))
    )
    earlier = Window.partitionBy("visitorid").orderBy("_hour")
    firsts = placed.where(F.col("_before").isNull())
    across = firsts.select(
        "visitorid",
        (F.col("_at") - F.lag("_last").over(earlier)).alias("gap"),
        F.least(F.col("_n"), one).alias("pairs"),
    ).where(F.col("gap").isNotNull())
    both = within.unionByName(across)
    return both.select("visitorid", (F.col("gap") / F.lit(1e6)).alias("gap_seconds"), "pairs")


def gap_hist(ev: DataFrame, edges: list[float] = GAP_EDGES) -> DataFrame:
    return fixed_hist(inter_event_gaps(ev), "gap_seconds", edges, weight="pairs")


def gap_stats(ev: DataFrame) -> DataFrame:
    """Median gap and the share of all gaps of at most a minute."""
    # Once per gap, written: both figures come from these rows.
    gaps = materialise(inter_event_gaps(ev).groupBy("gap_seconds").agg(F.sum("pairs").alias("pairs")))
    quick = F.sum(F.when(F.col("gap_seconds") <= 60, F.col("pairs")).otherwise(0))
    median = exact_quantiles(gaps, "gap_seconds", [0.5], weight="pairs", keep=False)[0]
    return gaps.agg(F.lit(median).cast("double").alias("median_gap_seconds"), (quick / F.sum("pairs")).alias("share_within_minute"))


def eda_summary(ev: DataFrame) -> DataFrame:
    return ev.agg(
        F.count(F.lit(1)).alias("events"),
        F.to_date(F.min("timestamp")).alias("date_min"),
        F.to_date(F.max("timestamp")).alias("date_max"),
        F.count_distinct("visitorid").alias("visitors"),
        F.count_distinct("itemid").alias("items"),
    )


def _size_counts(lengths: DataFrame, col: str) -> DataFrame:
    """How many groups have each size; at most sqrt(2N) rows for N events."""
    return lengths.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
