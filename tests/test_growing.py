"""Work that goes on: streams, sketches per day, bounded counters, a lasting index, filters, repeatable noise."""

import collections
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trailmart.functions.scalars import safe_long
from trailmart.operators import cleaning as C
from trailmart.operators import exploration as E
from trailmart.operators import mart as B
from trailmart.operators import sequences as Q
from trailmart.operators import sketches as K
from trailmart.operators.heavy import heavy_hitters
from trailmart.params import Params
from trailmart.session import scratch_path
from trailmart.streaming import events as stream

SCHEMA = "visitorid bigint, timestamp timestamp, event string, itemid bigint"


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def clicks(spark):
    """A week of events; visitor 1 has half of them, item 3 too."""
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 1, 1, rng.randint(2, 30)]), f"2024-03-{rng.randint(1, 7):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00",
         "view", rng.choice([3, 3, rng.randint(1, 400)]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "visitorid bigint, timestamp string, event string, itemid bigint")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).orderBy("timestamp")
    path = scratch_path(spark, "clicks")
    df.write.parquet(path)
    return spark.read.parquet(path)


# streams


def test_sessions_of_a_stream_equal_the_batch_and_late_rows_are_counted(spark, clicks):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "state"))
    days = [clicks.where(F.dayofmonth("timestamp").between(a, b)) for a, b in ((1, 3), (4, 5), (6, 7))]
    for part in days[:2]:
        part.coalesce(1).write.mode("append").parquet(folder)
    build = stream.session_stream
    first = stream.run_available(build(stream.read_stream(spark, folder, SCHEMA, 1), delay="2 hours"), out, checkpoint)
    assert first.late == 0 and first.rows == days[0].count() + days[1].count()
    # Five rows of the first day come after the fifth day: too late.
    days[0].limit(5).unionByName(days[2]).coalesce(1).write.mode("append").parquet(folder)
    stream.closing_row(clicks).write.mode("append").parquet(folder)
    second = stream.run_available(build(stream.read_stream(spark, folder, SCHEMA, 1), delay="2 hours"), out, checkpoint)
    assert second.late >= 5 - 4 and second.rows == 5 + days[2].count() + 1
    sessions = E.sessionize(clicks).groupBy("visitorid", "session").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count("*").alias("events")
    )
    got = spark.read.parquet(out)
    assert sorted_rows(got.select("visitorid", "first", "last", "events")) == sorted_rows(sessions.drop("session"))


def test_a_pause_of_exactly_the_gap_does_not_end_a_session(spark):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (1, "2024-01-01 01:00:01")], "visitorid bigint, t string")
    rows = rows.select("visitorid", F.col("t").cast("timestamp").alias("timestamp"), F.lit("view").alias("event"), F.lit(1).cast("bigint").alias("itemid"))
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows.unionByName(stream.closing_row(rows)).write.parquet(folder)
    stream.run_available(stream.session_stream(stream.read_stream(spark, folder, SCHEMA)), out, scratch_path(spark, "state"))
    assert sorted(r.events for r in spark.read.parquet(out).collect()) == [1, 2]


def test_copies_across_files_are_dropped(spark):
    raw = "timestamp string, visitorid bigint, event string, itemid bigint"
    parts = [
        [("1000", 1, "view", 5), ("1000", 1, "view", 5), ("2000", None, "view", 5), ("x", 1, "view", 5), ("3000", 1, "other", 5)],
        [("1000", 1, "view", 5), ("1000", 1, "view", 6), ("4000", 2, "transaction", None)],
    ]
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "state"))
    rows = []
    for part in parts:
        rows += part
        spark.createDataFrame(part, raw).coalesce(1).write.mode("append").parquet(folder)
        stream.run_available(stream.clean_stream(stream.read_stream(spark, folder, raw, 1)), out, checkpoint)
    assert sorted_rows(spark.read.parquet(out)) == sorted_rows(C.clean_events(spark.createDataFrame(rows, raw)))


# sketches and counters


def test_sketches_merge_to_the_whole(spark, clicks):
    path = scratch_path(spark, "sketches")
    for day in range(1, 8):
        K.write_days(K.daily_sketches(clicks.where(F.dayofmonth("timestamp") == day)), path)
    days = spark.read.parquet(path)
    assert days.count() == 7
    K.write_days(K.daily_sketches(clicks.where(F.dayofmonth("timestamp") == 7)), path)
    found = K.merged(spark.read.parquet(path)).first()
    exact = clicks.agg(F.count("*"), F.count_distinct("visitorid"), F.count_distinct("itemid")).first()
    assert found.events == exact[0] and spark.read.parquet(path).count() == 7
    assert abs(found.visitors - exact[1]) <= exact[1] * K.DISTINCT_ERROR and abs(found.items - exact[2]) <= exact[2] * K.DISTINCT_ERROR
    sizes = sorted(r["count"] for r in clicks.groupBy("visitorid", F.to_date("timestamp")).count().collect())
    assert found.visitor_days == len(sizes) and sizes[int(0.48 * len(sizes))] <= found.q50 <= sizes[int(0.52 * len(sizes))]


def test_days_are_read_from_their_files_alone(spark, clicks):
    path = K.write_days(K.daily_sketches(clicks), scratch_path(spark, "sketches"))
    week = K.merged(spark.read.parquet(path).where("date = '2024-03-05'"))
    assert "PartitionFilters: [isnotnull(date" in week._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("counters, most", [(4096, 4096), (16, 4096), (4, 4)])
def test_heavy_hitters_equal_the_full_count(spark, clicks, counters, most):
    want = collections.Counter(r.itemid for r in clicks.collect())
    best = sorted(want.items(), key=lambda x: (-x[1], x[0]))
    for top in (1, 10, 1000):
        got = heavy_hitters(clicks.repartition(5), "itemid", top, counters, most).collect()
        assert [tuple(r) for r in got] == best[:top]


def test_heavy_hitters_of_odd_tables(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",), ("b",), (None,), (None,)], "v string")
    assert [tuple(r) for r in heavy_hitters(df, "v", 5).collect()] == [("b", 2), ("a", 1)]
    assert heavy_hitters(df.limit(0), "v", 5).count() == 0


# index, filters, noise, ids


def test_index_keeps_old_numbers(spark, events):
    old = events([(2, "2024-01-01 00:00:00", "view", 30), (1, "2024-01-02 00:00:00", "view", 10)])
    new = old.unionByName(events([(0, "2024-01-03 00:00:00", "view", 99), (5, "2024-01-03 00:00:00", "view", 5), (0, "2024-01-04 00:00:00", "view", None)]))
    stored = Q.item_index(old)
    assert sorted_rows(stored) == [(10, 1), (30, 2)]
    longer = Q.extend_index(stored, new)
    assert sorted_rows(longer) == [(10, 1), (30, 2), (5, 4), (99, 3)]
    assert sorted_rows(Q.extend_index(longer, new)) == sorted_rows(longer)
    assert sorted_rows(Q.extend_index(stored.limit(0), old)) == sorted_rows(stored)


def test_filters(spark, events, properties):
    ev = events(
        [(1, f"2024-01-01 00:{m:02d}:00", "view", m % 3) for m in range(10)] + [(1, "2024-01-02 00:00:00", "view", 0)]
        + [(2, "2024-01-01 00:00:00", "view", 1), (2, "2024-01-03 00:00:00", "view", None), (None, "2024-01-01 00:00:00", "view", 2)]
    )
    props = properties([("2024-01-01 00:00:00", 0, "categoryid", 5.0), ("2024-01-01 00:00:00", 1, "price", 5.0), ("2024-01-01 00:00:00", 1, "categoryid", 1.0)])
    assert C.filtered(ev, props) is ev
    assert C.bot_filter(ev, 9).count() == 4 and C.bot_filter(ev, 10).count() == 14
    assert {r.visitorid for r in C.min_interactions(ev, 3).collect()} == {1}
    assert {r.itemid for r in C.drop_missing_category(ev, props).collect()} == {0, 1}
    some = replace(Params(), max_events_per_day=9, drop_missing_category=True, min_interactions=1)
    assert sorted((r.visitorid, r.itemid) for r in C.filtered(ev, props, some).collect()) == [(1, 0), (2, 1)]
    assert C.filtered(ev, props, some).columns == ev.columns


def test_noise_does_not_depend_on_partitions(spark):
    rows = [(i, f"2024-01-{d:02d}", float(10 + i + d)) for i in range(40) for d in range(1, 10)]
    df = spark.createDataFrame(rows, "itemid long, date string, sales double").withColumn("date", F.to_date("date"))
    options = {"horizon": 20, "noise": 0.1, "seed": 3}
    one = sorted_rows(B.item_projection(df.coalesce(1), **options))
    assert one == sorted_rows(B.item_projection(df.repartition(211, "date"), **options))
    assert one != sorted_rows(B.item_projection(df, **{**options, "seed": 4}))
    z = [r[0] for r in spark.range(4000).select(B.deviate(F.col("id"), F.lit(1), 9)).collect()]
    mean = sum(z) / len(z)
    assert abs(mean) < 0.06 and abs(sum((x - mean) ** 2 for x in z) / len(z) - 1) < 0.08


def test_only_whole_numbers_are_ids(spark):
    texts = ["257597.5", "1e3", "257597.0", " 12 ", "-3.", "1.5E12", "1.55E1", "9" * 25, "", "x1", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(safe_long("v")).collect()] == [None, None, 257597, 12, -3, 1_500_000_000_000, None, None, None, None, None]
    doubles = spark.createDataFrame([(1433221332117.0,), (2.5,), (float("nan"),), (7.0,)], "v double")
    assert [r[0] for r in doubles.select(safe_long("v")).collect()] == [1433221332117, None, None, 7]
