"""Cleaning of events, item properties and the category tree, with drop counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms, first_number, safe_long
from ..params import Params

DEFAULTS = Params()


def parse_epoch_ms(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.withColumn(col, epoch_ms(col)).where(F.col(col).isNotNull())


def event_whitelist(df: DataFrame, allowed: tuple[str, ...] = DEFAULTS.allowed_events) -> DataFrame:
    return df.where(F.col("event").isin(*allowed))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; nulls are equal."""
    return df.dropDuplicates()


def dedupe_keyed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest in ``order``.

    An aggregate, not a row number: copies of one key are reduced before the
    shuffle. ``order`` should make rows of one key distinct.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def layout_by_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Time-ordered files for writing, without a global sort on one task.

    The other columns follow in the range key, so that one busy instant can be split too.
    """
    order = [col, *[c for c in df.columns if c != col]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


# filters of cleaned events ---------------------------------------------------


def bot_filter(ev: DataFrame, most: int) -> DataFrame:
    """Events but those of visitor-days with more than ``most`` of them; rows without visitor or time stay.

    The counts fold in each task, so a bot is one row per task and day there. The days to drop are the small side of
    the join: each of them stands for more than ``most`` events.
    """
    day = F.to_date("timestamp")
    per_day = ev.where(F.col("visitorid").isNotNull() & F.col("timestamp").isNotNull()).groupBy("visitorid", day.alias("_day"))
    busy = per_day.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("visitorid", "_day")
    return ev.withColumn("_day", day).join(busy, ["visitorid", "_day"], "left_anti").select(*ev.columns)


def min_interactions(ev: DataFrame, least: int) -> DataFrame:
    """Events of visitors with at least ``least`` events."""
    enough = ev.groupBy("visitorid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return ev.join(enough.select("visitorid"), "visitorid", "left_semi").select(*ev.columns)


def drop_missing_category(ev: DataFrame, props: DataFrame) -> DataFrame:
    """Events of items that have a category."""
    known = props.where((F.col("property") == "categoryid") & F.col("value").isNotNull()).select("itemid").distinct()
    return ev.join(known, "itemid", "left_semi").select(*ev.columns)


def filtered(ev: DataFrame, props: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The optional filters that ``params`` asks for, bots first; none by default."""
    if params.max_events_per_day is not None:
        ev = bot_filter(ev, params.max_events_per_day)
    if params.drop_missing_category:
        ev = drop_missing_category(ev, props)
    if params.min_interactions is not None:
        ev = min_interactions(ev, params.min_interactions)
    return ev


# events ---------------------------------------------------------------------


def clean_events(df: DataFrame, allowed: tuple[str, ...] = DEFAULTS.allowed_events) -> DataFrame:
    parsed = parse_epoch_ms(df)
    return dedupe_rows(drop_missing(event_whitelist(parsed, allowed), ["visitorid"]))


def clean_events_stats(
    df: DataFrame, allowed: tuple[str, ...] = DEFAULTS.allowed_events, approx: bool = False
) -> DataFrame:
    """Counters of ``clean_events``: every row is charged to the first rule it fails."""
    rule = (
        F.when(F.col("timestamp").isNull(), "bad_ts")
        .when(~F.coalesce(F.col("event").isin(*allowed), F.lit(False)), "bad_event")
        .when(F.col("visitorid").isNull(), "missing_visitor")
        .otherwise("kept")
    )
    tagged = df.withColumn("timestamp", epoch_ms("timestamp")).withColumn("_rule", rule)
    copies = _copies(tagged, [*df.columns, "_rule"])
    kept = F.col("_rule") == "kept"
    distinct = F.approx_count_distinct if approx else F.count_distinct
    day = F.to_date("timestamp")
    return copies.agg(
        _rows(F.lit(True), "rows_before"),
        _rows(F.col("_rule") == "bad_ts", "rows_dropped_bad_ts"),
        _rows(F.col("_rule") == "bad_event", "rows_dropped_bad_event"),
        _rows(F.col("_rule") == "missing_visitor", "rows_dropped_missing_visitor"),
        _extras(kept),
        F.count_if(kept).alias("rows_after"),
        distinct(F.when(kept, F.col("visitorid"))).alias("unique_visitors"),
        distinct(F.when(kept, F.col("itemid"))).alias("unique_items"),
        F.min(F.when(kept, day)).alias("date_min"),
        F.max(F.when(kept, day)).alias("date_max"),
    )


# item properties ------------------------------------------------------------

_PROPERTY_KEY = ["itemid", "property", "timestamp"]


def clean_properties(df: DataFrame) -> DataFrame:
    rows = parse_epoch_ms(df).withColumn("value", first_number("value"))
    rows = drop_missing(drop_missing(rows, ["value"]), ["itemid", "property"])
    if set(rows.columns) == {*_PROPERTY_KEY, "value"}:
        # Smallest value of the key: a plain hash aggregate.
        return rows.groupBy(*_PROPERTY_KEY).agg(F.min("value").alias("value")).select(*df.columns)
    return dedupe_keyed(rows, _PROPERTY_KEY, ["value"])


def clean_properties_stats(df: DataFrame) -> DataFrame:
    rule = (
        F.when(F.col("timestamp").isNull(), "bad_ts")
        .when(F.col("value").isNull(), "bad_value")
        .when(F.col("itemid").isNull() | F.col("property").isNull(), "missing_ids")
        .otherwise("kept")
    )
    tagged = (
        df.withColumn("timestamp", epoch_ms("timestamp"))
        .withColumn("value", first_number("value"))
        .withColumn("_rule", rule)
    )
    copies = _copies(tagged, [*_PROPERTY_KEY, "_rule"])
    kept = F.col("_rule") == "kept"
    return copies.agg(
        _rows(F.lit(True), "rows_before"),
        _rows(F.col("_rule") == "bad_ts", "rows_dropped_bad_ts"),
        _rows(F.col("_rule") == "bad_value", "rows_dropped_bad_value"),
        _rows(F.col("_rule") == "missing_ids", "rows_dropped_missing_ids"),
        _extras(kept),
        F.count_if(kept).alias("rows_after"),
        F.count_distinct(F.when(kept, F.col("itemid"))).alias("unique_items"),
        F.count_distinct(F.when(kept, F.col("property"))).alias("unique_properties"),
    )


# category tree --------------------------------------------------------------


def clean_category(df: DataFrame) -> DataFrame:
    """One row per category; ids to whole numbers first, so ``7`` and ``7.0`` are one; -1 marks a root.

    Of several rows the smallest real parent stays; -1 only where no row names one.
    """
    rows = drop_missing(df, ["categoryid"]).withColumn("categoryid", safe_long("categoryid"))
    if "parentid" not in df.columns:
        return rows.select("categoryid").distinct()
    parent = F.coalesce(F.min(safe_long("parentid")), F.lit(-1).cast("bigint"))
    if set(df.columns) == {"categoryid", "parentid"}:
        return rows.groupBy("categoryid").agg(parent.alias("parentid")).select(*df.columns)
    rows = rows.withColumn("parentid", safe_long("parentid"))
    kept = dedupe_keyed(rows.withColumn("_root", F.col("parentid").isNull()), ["categoryid"], ["_root", "parentid"])
    return kept.drop("_root").withColumn("parentid", F.coalesce("parentid", F.lit(-1).cast("bigint")))


def clean_category_stats(df: DataFrame) -> DataFrame:
    missing = F.col("categoryid").isNull()
    has_parent = "parentid" in df.columns
    parent = F.coalesce(F.min(safe_long("parentid")), F.lit(-1).cast("bigint")) if has_parent else F.lit(None)
    # Unparsable ids are one key of their own, as in the cleaned table.
    counted = df.groupBy(missing.alias("_missing"), safe_long("categoryid").alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"), parent.alias("_parent")
    )
    missing, kept = F.col("_missing"), ~F.col("_missing")
    return counted.agg(
        _rows(F.lit(True), "rows_before"),
        _rows(missing, "rows_dropped_missing"),
        _extras(kept),
        F.count_if(kept).alias("rows_after"),
        F.count_distinct(F.when(kept, F.col("_id"))).alias("unique_categories"),
        _rows(kept & F.col("_id").isNull(), "unparsable_ids"),
        F.count_distinct(F.when(kept, F.col("_parent"))).alias("unique_parents"),
    )


# helpers --------------------------------------------------------------------


def _copies(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows with their number of copies; copies fold before the shuffle."""
    return tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _rows(when: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(when, F.col("_n"))), F.lit(0)).alias(name)


def _extras(kept: Column) -> Column:
    return F.coalesce(F.sum(F.when(kept, F.col("_n") - 1)), F.lit(0)).alias("duplicates_dropped")
