"""Attributes as they were known on a day, for properties that change over time.

An as-of join without a range join: facts and rows go through one sort by item and day, and the last fact is carried
forward (``functions.ordering.carry_forward``). An item with a third of all rows is cut by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import carry_forward
from .item_day import price_change, with_day


def daily_facts(props: DataFrame, names: dict[str, str]) -> DataFrame:
    """Last value of each property per item and day, by (timestamp, value): one row however often it was set."""
    lasts = [
        F.max(F.when(F.col("property") == prop, F.struct("timestamp", "value")))["value"].alias(column)
        for prop, column in names.items()
    ]
    known = F.col("property").isin(*names) & F.col("itemid").isNotNull() & F.col("timestamp").isNotNull()
    return props.where(known & F.col("value").isNotNull()).groupBy("itemid", F.to_date("timestamp").alias("date")).agg(*lasts)


def asof_join(rows: DataFrame, facts: DataFrame, key: str, at: str) -> DataFrame:
    """``rows`` with the other columns of ``facts``: for each, the key's last value at ``at`` or before.

    Every column is carried by itself, so a fact may leave columns null. Without an earlier fact the value is null.
    Rows with a null key or time get nulls. Facts with the same key and time must be one row.
    """
    values = [c for c in facts.columns if c not in (key, at)]
    own = [c for c in rows.columns if c not in (key, at)]
    nothing = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in values]
    left = rows.select(key, at, F.lit(1).alias("_kind"), F.struct(*own).alias("_row") if own else F.lit(0).alias("_row"), *nothing)
    right = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, at, F.lit(0).alias("_kind"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), *values
    )
    both = carry_forward(left.unionByName(right), key, [at, "_kind"], values).where("_kind = 1")
    return both.select(key, at, *[F.col(f"_row.{c}").alias(c) for c in own], *values).select(*rows.columns, *values)


def attributes_asof(day: DataFrame, props: DataFrame, names: dict[str, str]) -> DataFrame:
    """Item-days with each property's value at the end of the day, null before it was first set."""
    return asof_join(day, daily_facts(props, names), "itemid", "date")


def price_change_asof(day: DataFrame, props: DataFrame, lag: int = 7) -> DataFrame:
    """Change of the price as of the day against the price ``lag`` observed days of the item before."""
    return price_change(with_day(attributes_asof(day, props, {"price": "price"})), lag)
