"""Demand features of one more day from stored state, without reading the history again.

``item_state`` keeps for every item its last observed days (as many as the widest window needs) and its first
attributes; ``category_state`` keeps the running sums behind the category means. A new day's events fold to
item-days, meet the state by item, and give the day's feature rows and the next state: the rows are the ones that a
full build over all events up to that day gives for it.

A day must come after the days in the state. Items without events that day keep their state as it is. Properties
may come with any day; of an attribute the first by (timestamp, value) counts, as in the full build. The full build
changes past rows too: targets of the day ``horizon`` days ago are returned as ``due``, and category means of older
rows are those of the state at their time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..params import Params
from ..sources import tables
from . import item_day as D

DEFAULTS = Params()
COUNTS = ("views", "adds", "sales")
MEANS = ("ctr_7d", "buyrate_7d", "sales_sum_7d")
NAMES = {"price": "price", "categoryid": "categoryid"}


@dataclass
class State:
    items: DataFrame
    categories: DataFrame

    def save(self, path: str) -> State:
        """Written, and read back: days are then a chain of small jobs, not of plans."""
        tables.write_table(self.items, f"{path}/item_state")
        tables.write_table(self.categories, f"{path}/category_state")
        return State.load(self.items.sparkSession, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> State:
        return State(tables.read_table(spark, f"{path}/item_state"), tables.read_table(spark, f"{path}/category_state"))


def _first_attributes(props: DataFrame) -> DataFrame:
    """(timestamp, value) of the first value of each attribute per item."""
    firsts = [
        F.min(F.when(F.col("property") == prop, F.struct("timestamp", "value"))).alias(f"first_{column}")
        for prop, column in NAMES.items()
    ]
    return props.where(F.col("property").isin(*NAMES) & F.col("itemid").isNotNull()).groupBy("itemid").agg(*firsts)


def _entry() -> Column:
    return F.struct(D.DAY, *COUNTS)


def initial(ev: DataFrame, props: DataFrame, params: Params = DEFAULTS) -> State:
    """The state after all given events: one full build."""
    day = D.with_day(D.daily_item_counts(ev, params.event_columns))
    keep = max(*params.windows, *params.lags, params.horizon_days) + 1
    # An item has one entry per day at most, which bounds the list before it is cut.
    tails = day.groupBy("itemid").agg(F.slice(F.reverse(F.array_sort(F.collect_list(_entry()))), 1, keep).alias("tail"))
    items = tails.select("itemid", F.reverse("tail").alias("tail")).join(_first_attributes(props), "itemid", "full")
    week = D.ratios(D.rolling_sums(day.join(D.item_attribute(props, "categoryid"), "itemid", "left"), (7,)))
    return State(items, _category_sums(week))


def _category_sums(week: DataFrame) -> DataFrame:
    sums = [F.sum(F.coalesce(c, F.lit(0.0))).alias(f"sum_{c}") for c in MEANS]
    known = week.where(F.col("categoryid").isNotNull())
    return known.groupBy(F.col("categoryid").cast("bigint").alias("categoryid")).agg(*sums, F.count(F.lit(1)).alias("n"))


def _window_columns(params: Params) -> dict[str, Column]:
    """The item's window columns from ``tail``, whose last entry is the new day."""

    def total(c: str, n: int) -> Column:
        last = F.slice("tail", F.greatest(F.size("tail") - (n - 1), F.lit(1)), F.lit(n))
        return F.aggregate(last, F.lit(0).cast("bigint"), lambda acc, e: acc + e[c]).cast("double")

    def back(k: int) -> Column:
        return F.coalesce(F.get("tail", F.size("tail") - (k + 1))["sales"], F.lit(0)).cast("double")

    sums = {f"{c}_sum_{n}d": total(c, n) for n in params.windows for c in COUNTS}
    return sums | {f"sales_lag_{k}d": back(k) for k in params.lags} | {"sales_lag_dow": back(7)}


def advance(state: State, ev: DataFrame, props: DataFrame, params: Params = DEFAULTS) -> tuple[DataFrame, State, DataFrame]:
    """(feature rows of the day, next state, due targets) from one day's events and new properties.

    ``due`` has (itemid, date, target): the targets of item-days ``horizon`` days before that are known now.
    """
    day = D.with_day(D.daily_item_counts(ev, params.event_columns))
    keep = max(*params.windows, *params.lags, params.horizon_days) + 1
    new = _first_attributes(props).toDF("itemid", *[f"new_{c}" for c in NAMES.values()])
    # One shuffle by item for all three; the state is the only side that grows, with the number of items.
    met = state.items.join(day, "itemid", "full").join(new, "itemid", "full")
    firsts = {f"first_{c}": F.least(f"first_{c}", f"new_{c}") for c in NAMES.values()}
    grown = F.slice(F.concat("tail", F.array(_entry())), F.greatest(F.size("tail") + 2 - keep, F.lit(1)), F.lit(keep))
    tail = F.when(F.col("date").isNull(), F.col("tail")).otherwise(F.when(F.col("tail").isNull(), F.array(_entry())).otherwise(grown))
    met = met.withColumns({**firsts, "tail": tail})
    items = met.select("itemid", "tail", *firsts)

    priced = met.select("*", F.col("first_price.value").alias("price"), F.col("first_categoryid.value").cast("bigint").alias("categoryid"))
    # Unpriced items take the price of the item before, of those that have occurred.
    priced = D.price_ffill(priced.where(F.col("tail").isNotNull()).drop("new_price", "new_categoryid"), params.price_scope)
    rows = D.ratios(priced.where(F.col("date").isNotNull()).withColumns(_window_columns(params)))
    before = F.when(F.size("tail") > 7, F.col("price"))
    rows = rows.withColumns({"price_pct_chg_7d": ratio(F.col("price") - before, before), f"target_next{params.horizon_days}": F.lit(0.0)})

    both = state.categories.unionByName(_category_sums(rows))
    categories = both.groupBy("categoryid").agg(*[F.sum(c).alias(c) for c in both.columns if c != "categoryid"])
    means = categories.select("categoryid", *[(F.col(f"sum_{c}") / F.col("n")).alias(f"_mean_{c}") for c in MEANS])
    today = rows.where(F.col("categoryid").isNotNull()).groupBy("categoryid", "date").agg(F.sum("sales_sum_7d").alias("cat_sales_7d"))
    rows = rows.join(means, "categoryid", "left").join(today, ["categoryid", "date"], "left")
    zero = F.lit(0.0)
    rows = rows.withColumns(
        {
            "ctr_sm_7d": D.smoothed(F.coalesce("ctr_7d", zero), F.col("_mean_ctr_7d"), params.ratio_alpha),
            "buyrate_sm_7d": D.smoothed(F.coalesce("buyrate_7d", zero), F.col("_mean_buyrate_7d"), params.ratio_alpha),
            "sales_sm_7d": D.smoothed(F.col("sales_sum_7d"), F.col("_mean_sales_sum_7d"), params.sales_alpha),
        }
    )
    due_day = F.col(D.DAY) - params.horizon_days
    due = met.where(F.col("date").isNotNull() & F.exists("tail", lambda e: e[D.DAY] == due_day))
    due = due.select("itemid", F.date_sub("date", params.horizon_days).alias("date"), F.col("sales").cast("double").alias("target"))
    return D.one_hot_dow(D.calendar(rows)).select(*D.feature_columns(params)), State(items, categories), due
