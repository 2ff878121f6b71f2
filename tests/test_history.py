"""Attributes as of a day, one more day from stored state, tables stored by item."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trailmart.functions.ordering import carry_forward
from trailmart.operators import daily, history
from trailmart.operators import item_day as D
from trailmart.session import scratch_path
from trailmart.sources import layout
from trailmart.sources.adapter import StarTables

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_asof(rows, facts):
    out = []
    for key, at, x in rows:
        seen = sorted((t, v) for k, t, v in facts if key is not None and k == key and at is not None and t is not None and t <= at)
        out.append((key, at, x, seen[-1][1] if seen else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [2, 5])
def test_asof_join_of_a_hot_key(spark, partitions):
    """Two thirds of all rows are one key: its run is cut over several sort partitions."""
    rng = random.Random(partitions)
    key = lambda: rng.choice([7, 7, 7, 7, 1, 2, None])
    rows = [(key(), rng.choice([None, *range(400)]), i) for i in range(900)]
    facts = list({(k, t): (k, t, rng.random()) for k, t in ((key(), rng.choice([None, *range(400)])) for _ in range(150))}.values())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        left = spark.createDataFrame(rows, "k int, at int, x int").repartition(6)
        got = history.asof_join(left, spark.createDataFrame(facts, "k int, at int, v double"), "k", "at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=str) == brute_asof(rows, facts)


def test_asof_join_has_no_range_join(spark):
    left = spark.createDataFrame([(1, 2, "a")], "k int, at int, x string")
    text = plan(history.asof_join(left, spark.createDataFrame([(1, 1, 5.0)], "k int, at int, v double"), "k", "at"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_columns_are_carried_by_themselves(spark):
    rows = [("a", 1, 5, None), ("a", 2, None, "x"), ("a", 3, None, None), ("b", 1, None, None), ("b", 2, 7, None), (None, 1, 1, "q"), (None, 2, None, None)]
    got = carry_forward(spark.createDataFrame(rows, "k string, t int, u int, v string"), "k", ["t"], ["u", "v"]).collect()
    assert {(r.k, r.t): (r.u, r.v) for r in got if r.k} == {
        ("a", 1): (5, None), ("a", 2): (5, "x"), ("a", 3): (5, "x"), ("b", 1): (None, None), ("b", 2): (7, None),
    }
    assert [(r.u, r.v) for r in got if r.k is None] == [(None, None)] * 2


def test_price_changes_with_time(spark, properties):
    day = spark.createDataFrame([(1, dt.date(2024, 1, d), 1) for d in range(1, 12)] + [(2, dt.date(2024, 1, 5), 1)], "itemid long, date date, sales long")
    props = properties([
        ("2024-01-02 10:00:00", 1, "price", 10.0), ("2024-01-02 23:59:59", 1, "price", 20.0), ("2024-01-09 00:00:00", 1, "price", 30.0),
        ("2024-01-09 00:00:00", 1, "price", 25.0), ("2024-01-20 00:00:00", 2, "price", 1.0), ("2024-01-01 00:00:00", 1, "other", 9.0),
    ])
    got = {(r.itemid, r.date.day): (r.price, r.price_pct_chg_7d) for r in history.price_change_asof(day, props).collect()}
    assert got[1, 1] == (None, None) and got[1, 2][0] == got[1, 8][0] == 20.0 and got[1, 9] == (30.0, 0.5) and got[2, 5] == (None, None)


def test_days_one_by_one_equal_the_full_build(spark, events, properties):
    rng = random.Random(3)
    rows = []
    for d in range(1, 13):
        for _ in range(rng.randint(5, 25)):
            kind = rng.choice(["view", "view", "addtocart", "transaction"])
            rows.append((rng.randint(1, 9), f"2024-02-{d:02d} {rng.randint(0, 23):02d}:00:00", kind, rng.choice([1, 1, 1, 2, 3, 4, 5, d, None])))
    props = properties(
        [("2024-01-01 00:00:00", i, "price", 10.0 * i) for i in (1, 3, 6)]
        + [("2024-01-02 00:00:00", 1, "price", 99.0)]
        + [("2024-01-01 00:00:00", i, "categoryid", float(i % 2)) for i in range(1, 10)]
    )
    ev = events(rows)
    age = F.dayofmonth("timestamp")
    state = daily.initial(ev.where(age < 4), props).save(scratch_path(spark, "state"))
    full_targets = {}
    for d in range(4, 13):
        got, state, due = daily.advance(state, ev.where(age == d), props.limit(0))
        full = D.forecast_features(ev.where(age <= d), props)
        full_targets = {(r.itemid, r.date): r.target_next7 for r in full.collect()}
        want = full.where(F.col("date") == f"2024-02-{d:02d}").collect()
        assert len(want) > 0

        def key(r):
            return tuple(round(v, 9) if isinstance(v, float) else v for v in r)

        assert sorted(map(key, got.collect())) == sorted(map(key, want))
        assert all(full_targets[r.itemid, r.date] == r.target for r in due.collect())
        state = state.save(scratch_path(spark, "state"))


def test_a_day_without_events_changes_nothing(spark, events, properties):
    ev, props = events([(1, "2024-02-01 00:00:00", "view", 5)]), properties([("2024-01-01 00:00:00", 5, "price", 3.0)])
    state = daily.initial(ev, props)
    rows, after, due = daily.advance(state, ev.limit(0), props.limit(0))
    assert rows.count() == 0 and due.count() == 0
    assert after.items.select("itemid", "tail").collect() == state.items.select("itemid", "tail").collect()
    rows, _, _ = daily.advance(daily.initial(ev.limit(0), props), ev, props.limit(0))
    assert [(r.itemid, r.price, r.views_sum_60d) for r in rows.collect()] == [(5, 3.0, 1.0)]


def test_stored_tables_need_no_shuffle_by_item(spark):
    star = StarTables(spark, SMALL)
    names = []
    for name, df in (("counts", D.daily_item_counts(star.events())), ("items", D.priced_items(star.events(), star.properties()))):
        path = scratch_path(spark, name)
        names.append(layout.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), "itemid", [], 8, path))
    counts, items = (layout.read_bucketed(spark, n) for n in names)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(D.features_from_stored(counts, items))
        # Even where nothing is small enough for a broadcast: the figures and the rows that meet them, by category.
        assert "hashpartitioning(itemid" not in text and "SortMergeJoin [itemid" in text
        assert text.count("Exchange hashpartitioning(") == text.count("Exchange hashpartitioning(categoryid")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for n in names:
        spark.sql(f"DROP TABLE {n}")
