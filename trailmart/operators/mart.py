"""Business queries over the sales mart (itemid, date, categoryid, sales, forecast)
and the visitor sequences. Item and category pages come for all keys at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.histograms import fixed_hist, frequency_hist
from ..functions.scalars import ratio, rounded
from .evaluation import normal_quantile
from .forecasting import attach_forecast
from .recommending import by_item_id, cooccurrence, reco_confidence


def build_mart(counts: DataFrame, categories: DataFrame, predictions: DataFrame) -> DataFrame:
    """(itemid, date, categoryid, sales, forecast) from the pipeline's own tables.

    ``counts`` are the daily item counts, ``categories`` one category per item, ``predictions`` forecasts by the
    day they were made on; a day without one has a null forecast.
    """
    sold = counts.select("itemid", "date", F.col("sales").cast("double").alias("sales"))
    mart = sold.join(categories.select("itemid", F.col("categoryid").cast("bigint").alias("categoryid")), "itemid", "left")
    return attach_forecast(mart, predictions).select("itemid", "date", "categoryid", "sales", "forecast")


def filter_dates(mart: DataFrame, start, end) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    if str(start) > str(end):
        raise ValueError("start date must be before end date")
    return mart.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_categories(mart: DataFrame, ids: list[int] | None = None) -> DataFrame:
    """Rows of the listed categories; no list means all rows."""
    return mart.where(F.col("categoryid").isin(list(ids))) if ids else mart


def kpis(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("sales").alias("total_sales"),
        F.count_distinct("itemid").alias("active_items"),
        F.avg("sales").alias("avg_sale"),
    )


def daily_revenue(mart: DataFrame) -> DataFrame:
    return mart.groupBy("date").agg(F.sum("sales").alias("sales"))


def performance(mart: DataFrame, by: str) -> DataFrame:
    """Sum, count and mean of sales per key, to the cent."""
    # The sum goes to cents first, so the mean does not depend on the order of addition.
    total = rounded(F.sum("sales"))
    return mart.where(F.col(by).isNotNull()).groupBy(by).agg(
        total.alias("total_sales"),
        F.count("sales").alias("transactions"),
        rounded(total / F.nullif(F.count("sales"), F.lit(0))).alias("avg_sale"),
    )


def best_worst_day(mart: DataFrame) -> DataFrame:
    """Mean daily total with the best and the worst day; the earliest of equals."""
    # Cents, so that equal totals tie whatever the order they were added in.
    daily = daily_revenue(mart).select("date", rounded("sales").alias("sales"))
    best = F.min(F.struct((-F.col("sales")).alias("minus"), "date", "sales"))
    worst = F.min(F.struct("sales", "date"))
    return daily.agg(
        F.avg("sales").alias("avg_daily_sales"), best.alias("b"), worst.alias("w")
    ).select(
        "avg_daily_sales",
        F.col("b.date").alias("best_day"),
        F.col("b.sales").alias("best_sales"),
        F.col("w.date").alias("worst_day"),
        F.col("w.sales").alias("worst_sales"),
    )


def sales_trend(mart: DataFrame) -> DataFrame:
    """Least-squares slope of the daily totals over their row number; null for one day."""
    # One row per calendar day, so the unpartitioned window is small.
    at = (F.row_number().over(Window.orderBy("date")) - 1).cast("double")
    return daily_revenue(mart).withColumn("at", at).agg(F.regr_slope("sales", "at").alias("slope"))


def insights(mart: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """(position, insight): the report sentences in order.

    Three passes over the mart (by day, category and item), each folded to one
    row. ``metrics`` (one row with r2 and mape) adds two sentences on the model.
    """
    # The wording and number formats of the sentences.
    days = _day_report(mart).select(
        _sentences(
            (1, "Total Revenue: $%,.2f across %,d transactions", ["total", "rows"]),
            (2, "Daily Average: $%,.2f per day", ["avg_daily"]),
            (3, "Best Sales Day: %s with $%,.2f", ["best_day", "best_sales"]),
            (4, "Lowest Sales Day: %s with $%,.2f", ["worst_day", "worst_sales"]),
            (8, "Average Transaction: $%.2f per item sale", ["avg_sale"]),
            (11, "Sales Trend: %s at $%.2f per day", ["direction", "steepness"]),
            (12, "%s", ["warning"]),
        )
    )
    categories = _best_of(mart, "categoryid").select(
        _sentences(
            (5, "Top Category: %s ($%,.2f)", ["key", "sales"]),
            (6, "Category Spread: %d categories with %,d total transactions", ["keys", "transactions"]),
        )
    )
    items = _best_of(mart, "itemid").select(
        _sentences((7, "Best Selling Item: %s ($%,.2f)", ["key", "sales"]))
    )
    result = days.unionByName(categories).unionByName(items)
    if metrics is not None:
        r2 = F.col("r2")
        # R2 tiers and their wording.
        quality = (
            F.when(r2 > 0.8, "Excellent forecasting accuracy - predictions are highly reliable")
            .when(r2 > 0.6, "Good forecasting accuracy - suitable for business planning")
            .when(r2 > 0.4, "Moderate accuracy - use predictions with caution")
            .otherwise("Poor accuracy - consider model improvements")
        )
        rated = metrics.withColumn("quality", quality).select(
            _sentences(
                (9, "Model Quality: %s", ["quality"]),
                (10, "Prediction Error: %.1f%% average error rate", ["mape"]),
            )
        )
        result = result.unionByName(rated)
    return result.select("s.position", "s.insight").where(F.col("insight").isNotNull())


def _sentences(*lines):
    """Sentences as rows; one with a null argument becomes null."""
    built = []
    for position, text, columns in lines:
        complete = F.lit(True)
        for c in columns:
            complete = complete & F.col(c).isNotNull()
        insight = F.when(complete, F.format_string(text, *columns))
        built.append(F.struct(F.lit(position).cast("bigint").alias("position"), insight.alias("insight")))
    return F.explode(F.array(*built)).alias("s")


def _day_report(mart: DataFrame) -> DataFrame:
    """Totals, best and worst day and trend in one row, from one row per day."""
    daily = mart.groupBy("date").agg(
        F.sum("sales").alias("exact"),
        rounded(F.sum("sales")).alias("sales"),
        F.count(F.lit(1)).alias("rows"),
        F.count("sales").alias("priced"),
    )
    at = (F.row_number().over(Window.orderBy("date")) - 1).cast("double")
    best = F.min(F.struct((-F.col("sales")).alias("minus"), "date", "sales"))
    worst = F.min(F.struct("sales", "date"))
    report = daily.withColumn("at", at).agg(
        F.sum("exact").alias("total"),
        F.sum("rows").alias("rows"),
        F.avg("exact").alias("avg_daily"),
        (F.sum("exact") / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_sale"),
        best.alias("b"),
        worst.alias("w"),
        F.regr_slope("exact", "at").alias("slope"),
    )
    return report.select(
        "total",
        "rows",
        "avg_daily",
        "avg_sale",
        F.date_format("b.date", "yyyy-MM-dd").alias("best_day"),
        F.col("b.sales").alias("best_sales"),
        F.date_format("w.date", "yyyy-MM-dd").alias("worst_day"),
        F.col("w.sales").alias("worst_sales"),
        F.when(F.col("slope").isNotNull(), F.when(F.col("slope") > 0, "Growing").otherwise("Declining")).alias("direction"),
        F.abs("slope").alias("steepness"),
        F.when(F.col("rows").isNull(), "No data available for analysis.").alias("warning"),
    )


def _best_of(mart: DataFrame, by: str) -> DataFrame:
    """Best key by sales, smallest key of equals, with the number of keys."""
    best = F.min(F.struct((-F.col("total_sales")).alias("minus"), F.col(by).alias("key"), "total_sales"))
    return (
        performance(mart, by)
        .agg(best.alias("b"), F.count(F.lit(1)).alias("keys"), F.sum("transactions").alias("transactions"))
        .select(
            F.col("b.key").cast("string").alias("key"), F.col("b.total_sales").alias("sales"), "keys", "transactions"
        )
    )


# forecast tab ---------------------------------------------------------------


def actual_vs_forecast_sample(mart: DataFrame, n: int = 500) -> DataFrame:
    """At most ``n`` rows in hash order, with the common axis range of the plot."""
    key = F.md5(F.concat_ws("|", F.col("itemid").cast("string"), F.date_format("date", "yyyy-MM-dd")))
    sample = mart.orderBy(key, "itemid", "date").limit(n)
    whole = Window.partitionBy()  # at most n rows
    return sample.select(
        "itemid",
        "date",
        "sales",
        "forecast",
        F.least(F.min("sales").over(whole), F.min("forecast").over(whole)).alias("axis_min"),
        F.greatest(F.max("sales").over(whole), F.max("forecast").over(whole)).alias("axis_max"),
    )


def daily_actual_vs_forecast(mart: DataFrame, by: str | None = None) -> DataFrame:
    """Actual and forecast totals per date, or per key and date."""
    return mart.groupBy(*([by] if by else []), "date").agg(
        F.sum("sales").alias("sales"), F.sum("forecast").alias("forecast")
    )


# sequence tab ---------------------------------------------------------------


def seq_lengths(seq: DataFrame) -> DataFrame:
    return seq.select("visitorid", F.size("item_seq").cast("bigint").alias("seq_length"))


def _length_counts(seq: DataFrame) -> DataFrame:
    """Sequences per length; lengths are capped, so a few dozen rows."""
    return seq_lengths(seq).groupBy("seq_length").agg(F.count(F.lit(1)).alias("n"))


def sequence_kpis(seq: DataFrame) -> DataFrame:
    length, n = F.col("seq_length"), F.col("n")
    return _length_counts(seq).agg(
        F.sum(n).alias("sessions"),
        (F.sum(length * n) / F.sum(n)).alias("mean_length"),
        F.expr("percentile(seq_length, 0.5D, n)").alias("median_length"),
        F.min(F.struct(-n, length.alias("mode")))["mode"].alias("mode_length"),
        F.max(length).alias("max_length"),
        F.sum(length * n).alias("interactions"),
    )


def sequence_hist(seq: DataFrame, unit_up_to: int = 20, bins: int = 25) -> DataFrame:
    """One bin per length for short sequences, else even bins; with the share of sessions."""
    counts = _length_counts(seq)
    longest = counts.agg(F.max("seq_length")).first()[0] or 1
    if longest <= unit_up_to:
        hist = fixed_hist(counts, "seq_length", list(range(1, longest + 2)), weight="n")
    else:
        hist = frequency_hist(counts, "seq_length", "n", bins)
    whole = Window.partitionBy()  # one row per bin
    return hist.withColumn("pct", F.col("n") * 100 / F.sum("n").over(whole))


def length_buckets(seq: DataFrame) -> DataFrame:
    length = F.col("seq_length")
    bucket = F.when(length <= 3, "quick").when(length <= 10, "regular").otherwise("deep")
    whole = Window.partitionBy()  # three rows
    return (
        _length_counts(seq)
        .groupBy(bucket.alias("bucket"))
        .agg(F.sum("n").alias("sessions"))
        .withColumn("pct", F.col("sessions") * 100 / F.sum("sessions").over(whole))
    )


def trending_items(seq: DataFrame, k: int = 10, items: DataFrame | None = None) -> DataFrame:
    """The most frequent items; item ids with the item dimension, else indexes."""
    top = (
        seq.select(F.explode("item_seq").alias("item"))
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "item")
        .limit(k)
    )
    return top if items is None else by_item_id(top, items, "item")


def session_explorer(
    seq: DataFrame, visitorid: int | None = None, first: int = 10, k: int = 5
) -> DataFrame:
    """Length and first items of a session, and what goes with its last item.

    One visitor, or every session at once.
    """
    chosen = seq if visitorid is None else seq.where(F.col("visitorid") == visitorid)
    overview = chosen.where(F.size("item_seq") > 0).select(
        "visitorid",
        F.size("item_seq").cast("bigint").alias("seq_length"),
        F.slice("item_seq", 1, first).alias("first_items"),
        F.element_at("item_seq", -1).alias("anchor"),
    )
    anchors = None if visitorid is None else overview.select("anchor").distinct()
    pairs = reco_confidence(cooccurrence(seq, k, anchors=anchors), seq)
    lists = pairs.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "other", "confidence", "tier"))).alias("recommended")
    )
    return overview.join(lists, "anchor", "left").withColumnRenamed("anchor", "last_item")


# item and category pages ----------------------------------------------------


def item_deep_dive(mart: DataFrame) -> DataFrame:
    """Totals per item and its first best day."""
    peak = F.min(F.struct((-F.col("sales")).alias("minus"), "date"))
    return mart.groupBy("itemid").agg(
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_sale"),
        F.count(F.lit(1)).alias("transactions"),
        peak["date"].alias("peak_day"),
        F.max("sales").alias("peak_sales"),
    )


def category_daily(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("categoryid").isNotNull()).groupBy("categoryid", "date").agg(
        F.sum("sales").alias("sales")
    )


def deviate(key: Column, step: Column, seed: int) -> Column:
    """A standard normal number for each (key, step, seed): 52 bits of a digest through the inverse normal."""
    digest = F.md5(F.concat_ws("/", key.cast("string"), step.cast("string"), F.lit(str(seed))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return normal_quantile((bits + 0.5) / float(1 << 52))


def project(
    rows: DataFrame,
    by: str,
    horizon: int = 7,
    amplitude: float = 0.15,
    noise: float = 0.0,
    seed: int = 0,
    last: int = 14,
) -> DataFrame:
    """Projection of each key's recent mean with a weekly wave and its mean step.

    ``rows`` has one row per key and date. Items use amplitude 0.15, categories
    0.2. A key with one row has no step and projects to null. ``noise`` is the
    share of the mean used as standard deviation: a normal deviate that key, step
    and seed decide, the same however the table is partitioned.
    """
    latest = Window.partitionBy(by).orderBy(F.desc("date"))
    recent = rows.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= last)
    base = recent.groupBy(by).agg(
        F.avg("sales").alias("m"),
        ratio(F.max_by("sales", "date") - F.min_by("sales", "date"), F.count(F.lit(1)) - 1).alias("t"),
        F.max("date").alias("until"),
    )
    h = F.col("h")
    wave = 1 + F.lit(amplitude) * F.sin((h - 1) * F.lit(2 * math.pi) / 7)
    drift = F.when(F.col("m") > 0, 1 + F.col("t") / F.nullif("m", F.lit(0.0)) * h * 0.1).otherwise(F.lit(1.0))
    value = F.col("m") * wave * drift
    if noise:
        value = value + deviate(F.col(by), h, seed) * F.col("m") * noise
    steps = base.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(
        by,
        F.date_add("until", h).alias("date"),
        F.when(value.isNotNull(), F.greatest(value, F.lit(0.0))).alias("forecast"),
    )


def item_projection(mart: DataFrame, horizon: int = 14, **options) -> DataFrame:
    return project(mart.select("itemid", "date", "sales"), "itemid", horizon, **options)


def category_projection(mart: DataFrame, horizon: int = 14, **options) -> DataFrame:
    return project(category_daily(mart), "categoryid", horizon, **{"amplitude": 0.2, **options})


def growth(projection: DataFrame, rows: DataFrame, by: str, last: int = 7) -> DataFrame:
    """Projected mean against the mean of the last rows, in percent; 0 without a base."""
    latest = Window.partitionBy(by).orderBy(F.desc("date"))
    current = (
        rows.withColumn("_rn", F.row_number().over(latest))
        .where(F.col("_rn") <= last)
        .groupBy(by)
        .agg(F.avg("sales").alias("current_avg"))
    )
    future = projection.groupBy(by).agg(F.avg("forecast").alias("future_avg"))
    change = (F.col("future_avg") - F.col("current_avg")) / F.nullif("current_avg", F.lit(0.0)) * 100
    return current.join(future, by).withColumn(
        "growth_pct", F.when(F.col("current_avg") > 0, change).otherwise(F.lit(0.0))
    )


def category_deep_dive(mart: DataFrame) -> DataFrame:
    """Totals and market share per category."""
    total = mart.select(F.sum("sales")).scalar()
    return (
        mart.where(F.col("categoryid").isNotNull())
        .groupBy("categoryid")
        .agg(
            F.sum("sales").alias("revenue"),
            F.count_distinct("itemid").alias("items"),
            F.avg("sales").alias("avg_sale"),
        )
        .withColumn("share_pct", ratio(F.col("revenue") * 100, total))
    )


def top_products_in_category(mart: DataFrame, k: int = 5) -> DataFrame:
    totals = (
        mart.where(F.col("categoryid").isNotNull())
        .groupBy("categoryid", "itemid")
        .agg(rounded(F.sum("sales")).alias("sales"))
    )
    best = Window.partitionBy("categoryid").orderBy(F.desc("sales"), "itemid")
    return totals.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def selectors(mart: DataFrame) -> dict[str, DataFrame]:
    """Choices of the dashboard's selectors."""
    return {
        "items": mart.select("itemid").distinct().orderBy("itemid"),
        "categories": mart.select("categoryid").distinct().orderBy("categoryid"),
        "dates": mart.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")),
    }
