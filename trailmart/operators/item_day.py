"""Item-day demand features.

Frames and lags count observed item-days, not calendar days: a day without
events has no row. Every per-item window shares one order (a whole-number
day), so the table is shuffled by item and sorted once; an item has at most
one row per calendar day, which bounds its window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import carry_forward_by_id
from ..functions.scalars import ratio
from ..params import Params

DEFAULTS = Params()
DAY = "_day"


def item_window():
    return Window.partitionBy("itemid").orderBy(DAY)


def with_day(day: DataFrame) -> DataFrame:
    return day if DAY in day.columns else day.withColumn(DAY, F.unix_date("date"))


def daily_item_counts(
    ev: DataFrame, event_columns: dict[str, str] = DEFAULTS.event_columns
) -> DataFrame:
    """Events of each kind per item and UTC day; a kind that never occurs is a zero column."""
    counts = [
        F.count_if((F.col("event") == event) & F.col("visitorid").isNotNull()).alias(name)
        for event, name in event_columns.items()
    ]
    return (
        ev.where(F.col("itemid").isNotNull())
        .groupBy("itemid", F.to_date("timestamp").alias("date"))
        .agg(*counts)
    )


def item_attribute(props: DataFrame, name: str, column: str | None = None) -> DataFrame:
    """One value per item: the first by (timestamp, value)."""
    return item_attributes(props, {name: column or name})


def item_attributes(props: DataFrame, names: dict[str, str]) -> DataFrame:
    """First value of several properties per item, in one pass over the filtered table."""
    firsts = [
        F.min(
            F.when(F.col("property") == prop, F.struct("timestamp", "value"))
        )["value"].alias(column)
        for prop, column in names.items()
    ]
    return props.where(F.col("property").isin(*names)).groupBy("itemid").agg(*firsts)


def price_ffill(items: DataFrame, scope: str = "global") -> DataFrame:
    """Price of an unpriced item from the item before it (by id).

    Price is constant per item, so filling the item-day table in (item, date)
    order is the same as filling the item table. ``scope="item"`` leaves
    unpriced items null.
    """
    if scope == "item":
        return items
    return carry_forward_by_id(items, "itemid", "price")


def priced_items(ev: DataFrame, props: DataFrame, scope: str = "global") -> DataFrame:
    """(itemid, price, categoryid) of the items that occur in the events."""
    seen = ev.where(F.col("itemid").isNotNull()).select("itemid").distinct()
    known = item_attributes(props, {"price": "price", "categoryid": "categoryid"})
    items = seen.join(known, "itemid", "left").withColumn(
        "categoryid", F.col("categoryid").cast("bigint")
    )
    return price_ffill(items, scope)


def rolling_sums(
    day: DataFrame,
    windows: tuple[int, ...] = DEFAULTS.windows,
    cols: tuple[str, ...] = ("views", "adds", "sales"),
) -> DataFrame:
    """Sum of the current and the ``n - 1`` rows before it.

    Taken as the difference of two running totals, which are exact for counts:
    a growing frame costs the same per row however long the window is, where a
    sliding frame adds up all its rows again.
    """
    start = Window.unboundedPreceding
    w = item_window()

    def window_sum(c: str, n: int):
        earlier = F.coalesce(F.sum(c).over(w.rowsBetween(start, -n)), F.lit(0))
        return (F.sum(c).over(w.rowsBetween(start, 0)) - earlier).cast("double")

    sums = [window_sum(c, n).alias(f"{c}_sum_{n}d") for n in windows for c in cols]
    return with_day(day).select("*", *sums)


def sales_lags(day: DataFrame, lags: tuple[int, ...] = DEFAULTS.lags) -> DataFrame:
    """Sales some rows back, 0 before the first; the weekday lag is the seven-row lag."""
    w = item_window()
    back = [
        F.lag("sales", k, 0).over(w).cast("double").alias(name)
        for k, name in [*((k, f"sales_lag_{k}d") for k in lags), (7, "sales_lag_dow")]
    ]
    return with_day(day).select("*", *back)


def target_at(day: DataFrame, horizon: int = DEFAULTS.horizon_days) -> DataFrame:
    """Sales of the item on exactly the day ``horizon`` days later, 0 if it has no row."""
    ahead = item_window().rangeBetween(horizon, horizon)
    later = F.coalesce(F.sum("sales").over(ahead), F.lit(0)).cast("double")
    return with_day(day).withColumn(f"target_next{horizon}", later)


def price_change(day: DataFrame, lag: int = 7) -> DataFrame:
    before = F.lag("price", lag).over(item_window())
    return with_day(day).withColumn("price_pct_chg_7d", ratio(F.col("price") - before, before))


def ratios(day: DataFrame) -> DataFrame:
    return day.withColumns(
        {
            "ctr_7d": ratio("adds_sum_7d", "views_sum_7d"),
            "buyrate_7d": ratio("sales_sum_7d", "views_sum_7d"),
        }
    )


def category_day_summary(day: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Per (category, date): sums of ``cols``, and their means over the whole category.

    The category means come from the (category, date) sums, so a category that
    holds a third of all rows has only one row per day left in its window.
    """
    sums = [F.sum(F.coalesce(c, F.lit(0.0))).alias(f"_sum_{c}") for c in cols]
    per_day = (
        day.where(F.col("categoryid").isNotNull())
        .groupBy("categoryid", "date")
        .agg(*sums, F.count(F.lit(1)).alias("_n"))
    )
    whole = Window.partitionBy("categoryid")
    means = [
        (F.sum(f"_sum_{c}").over(whole) / F.sum("_n").over(whole)).alias(f"_mean_{c}") for c in cols
    ]
    return per_day.select("categoryid", "date", *[f"_sum_{c}" for c in cols], *means)


def smoothed(value, category_mean, alpha: float):
    """Value pulled towards its category mean; null when there is no category."""
    return (value + F.lit(alpha) * category_mean) / F.lit(1.0 + alpha)


def smooth_by_category(day: DataFrame, col: str, alpha: float, name: str) -> DataFrame:
    value = F.coalesce(col, F.lit(0.0))
    means = day.where(F.col("categoryid").isNotNull()).groupBy("categoryid").agg(
        F.avg(value).alias("_mean")
    )
    return (
        day.join(means, "categoryid", "left")
        .withColumn(name, smoothed(value, F.col("_mean"), alpha))
        .drop("_mean")
    )


def category_sales(day: DataFrame) -> DataFrame:
    """Seven-row sales of the item's whole category on the same date."""
    totals = (
        day.where(F.col("categoryid").isNotNull())
        .groupBy("categoryid", "date")
        .agg(F.sum("sales_sum_7d").alias("cat_sales_7d"))
    )
    return day.join(totals, ["categoryid", "date"], "left")


def calendar(day: DataFrame) -> DataFrame:
    dow = F.weekday("date")
    return day.withColumns(
        {
            "dow": dow,
            "is_weekend": (dow >= 5).cast("int"),
            "weekofyear": F.weekofyear("date"),
            "month": F.month("date"),
            "day_of_year": F.dayofyear("date"),
        }
    )


def one_hot_dow(day: DataFrame) -> DataFrame:
    return day.withColumns({f"dow_{i}": (F.col("dow") == i).cast("byte") for i in range(7)})


def forecast_features(ev: DataFrame, props: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The feature table.

    Category figures are joined while rows are still narrow; the many window
    columns come last, after the only shuffles, so no wide row is ever moved.
    """
    counts = with_day(daily_item_counts(ev, params.event_columns))
    day = counts.join(priced_items(ev, props, params.price_scope), "itemid", "left")
    week = ratios(rolling_sums(day, (7,)))
    summary = category_day_summary(week, ("ctr_7d", "buyrate_7d", "sales_sum_7d"))
    day = day.join(summary, ["categoryid", "date"], "left")

    day = sales_lags(rolling_sums(day, params.windows), params.lags)
    return _finished(ratios(price_change(target_at(day, params.horizon_days))), params)


def _finished(day: DataFrame, params: Params) -> DataFrame:
    """Smoothed columns, calendar and column order of rows with their category figures."""
    zero = F.lit(0.0)
    day = day.withColumns(
        {
            "ctr_sm_7d": smoothed(F.coalesce("ctr_7d", zero), F.col("_mean_ctr_7d"), params.ratio_alpha),
            "buyrate_sm_7d": smoothed(
                F.coalesce("buyrate_7d", zero), F.col("_mean_buyrate_7d"), params.ratio_alpha
            ),
            "sales_sm_7d": smoothed(
                F.col("sales_sum_7d"), F.col("_mean_sales_sum_7d"), params.sales_alpha
            ),
            "cat_sales_7d": F.col("_sum_sales_sum_7d"),
        }
    )
    return one_hot_dow(calendar(day)).select(*feature_columns(params))


def features_from_stored(counts: DataFrame, items: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The feature table from ``daily_item_counts`` and ``priced_items`` that are stored by item (``sources.layout``).

    The join with the items and all windows read the rows where they lie; only the (category, date) figures are
    shuffled. They are joined last: by broadcast where they are small enough, and no row goes by item again.
    """
    day = with_day(counts).join(items, "itemid", "left")
    summary = category_day_summary(ratios(rolling_sums(day, (7,))), ("ctr_7d", "buyrate_7d", "sales_sum_7d"))
    wide = sales_lags(rolling_sums(day, params.windows), params.lags)
    wide = ratios(price_change(target_at(wide, params.horizon_days)))
    return _finished(wide.join(summary, ["categoryid", "date"], "left"), params)


def feature_columns(params: Params = DEFAULTS) -> list[str]:
    """Column order of the feature table; counts of further events come after the date."""
    windowed = ("views", "adds", "sales")
    return [
        "itemid",
        "date",
        *[c for c in params.event_columns.values() if c not in windowed],
        "price",
        "categoryid",
        *[f"{c}_sum_{n}d" for n in params.windows for c in windowed],
        *[f"sales_lag_{k}d" for k in params.lags],
        "sales_lag_dow",
        "ctr_7d",
        "buyrate_7d",
        "ctr_sm_7d",
        "buyrate_sm_7d",
        "cat_sales_7d",
        "sales_sm_7d",
        "price_pct_chg_7d",
        "is_weekend",
        "weekofyear",
        "month",
        "day_of_year",
        *[f"dow_{i}" for i in range(7)],
        f"target_next{params.horizon_days}",
    ]
