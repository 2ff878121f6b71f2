"""Per-visitor item sequences and the dense item and category indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import with_position
from ..params import Params
from .item_day import item_attribute

DEFAULTS = Params()


def item_index(ev: DataFrame) -> DataFrame:
    """1-based index of items in order of first appearance by (visitor, time, item)."""
    first = F.min(F.struct("visitorid", "timestamp")).alias("_first")
    items = ev.where(F.col("itemid").isNotNull()).groupBy("itemid").agg(first)
    order = ["_first.visitorid", "_first.timestamp", "itemid"]
    return with_position(items, order, "item_idx").select("itemid", "item_idx")


item_dim = item_index


def extend_index(stored: DataFrame, ev: DataFrame) -> DataFrame:
    """A stored item index with the items it lacks: old numbers stay, new items follow in order of first appearance.

    Sequences made with an older state of the index still join. ``stored`` is the written table.
    """
    new = item_index(ev.join(stored.select("itemid"), "itemid", "left_anti"))
    last = stored.select(F.coalesce(F.max("item_idx"), F.lit(0))).scalar()
    return stored.select("itemid", "item_idx").unionByName(new.withColumn("item_idx", F.col("item_idx") + last))


def category_index(cats: DataFrame) -> DataFrame:
    """1-based index of categories in id order."""
    ids = cats.select("categoryid").where(F.col("categoryid").isNotNull()).distinct()
    return with_position(ids, ["categoryid"], "cat_idx")


def item_category(props: DataFrame, fanout: bool = False) -> DataFrame:
    """Category of each item; ``fanout`` keeps every category row an item has."""
    if fanout:
        rows = props.where(F.col("property") == "categoryid")
        return rows.select(
            "itemid", F.col("value").cast("bigint").alias("categoryid"), F.col("timestamp").alias("_since")
        )
    return item_attribute(props, "categoryid").withColumn(
        "categoryid", F.col("categoryid").cast("bigint")
    )


def attach_category(ev: DataFrame, props: DataFrame, fanout: bool = False) -> DataFrame:
    return ev.join(item_category(props, fanout), "itemid", "left").drop("_since")


def last_n_per_visitor(ev: DataFrame, n: int = DEFAULTS.max_sequence) -> DataFrame:
    """The last ``n`` events of each visitor, ``rn`` = 1 for the latest.

    A limit on a row number is applied before the shuffle as well, so a visitor
    with a third of all events sends at most ``n`` rows per task.
    """
    latest = Window.partitionBy("visitorid").orderBy(
        *[F.desc(c) for c in _tie_break(ev)]
    )
    return ev.withColumn("rn", F.row_number().over(latest)).where(F.col("rn") <= n)


def _tie_break(ev: DataFrame) -> list[str]:
    order = ["timestamp", "itemid", "event"]
    return order + [c for c in ("_since", "cat_idx") if c in ev.columns]


def reco_sequences(
    ev: DataFrame, props: DataFrame, cats: DataFrame, params: Params = DEFAULTS, items: DataFrame | None = None
) -> DataFrame:
    """(visitorid, item_seq, cat_seq, time_seq) of each visitor's last events.

    Events without an item are left out. Times are whole minutes since the
    first kept event. ``items`` is the item dimension where it exists already.
    """
    usable = ev.where(F.col("itemid").isNotNull() & F.col("visitorid").isNotNull())
    usable = usable.select("visitorid", "timestamp", "event", "itemid")
    index = category_index(cats)
    categories = (
        item_category(props, params.category_fanout)
        .join(index, "categoryid", "left")
        .withColumn("cat_idx", F.coalesce("cat_idx", F.lit(0).cast("bigint")))
        .drop("categoryid")
    )
    items = item_index(ev.where(F.col("visitorid").isNotNull())) if items is None else items
    if params.category_fanout:
        # Each event repeats once per category row of its item before the cut.
        spread = usable.join(categories, "itemid", "left")
        kept = last_n_per_visitor(spread, params.max_sequence).join(items, "itemid")
    else:
        kept = last_n_per_visitor(usable, params.max_sequence).join(
            items.join(categories, "itemid", "left"), "itemid"
        )
    cat_idx = F.coalesce("cat_idx", F.lit(0).cast("bigint")).alias("cat_idx")
    steps = F.sort_array(
        F.collect_list(F.struct((-F.col("rn")).alias("at"), "timestamp", "item_idx", cat_idx))
    )
    packed = kept.groupBy("visitorid").agg(steps.alias("s"))
    started = F.unix_micros(F.col("s")[0]["timestamp"])
    minutes = F.transform(
        "s",
        lambda x: F.floor((F.unix_micros(x["timestamp"]) - started) / F.lit(60_000_000)).cast("double"),
    )
    return packed.select(
        "visitorid",
        F.col("s.item_idx").alias("item_seq"),
        F.col("s.cat_idx").alias("cat_seq"),
        minutes.alias("time_seq"),
    )


def sequence_stats(seq: DataFrame) -> DataFrame:
    return seq.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum(F.size("item_seq")).alias("interactions"),
        F.max(F.array_max("item_seq")).alias("n_items"),
    )
