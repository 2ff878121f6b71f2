import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmart.functions.scalars import first_number, rounded, safe_long
from trailmart.operators import cleaning as C

EVENTS = "timestamp string, visitorid bigint, event string, itemid bigint, transactionid bigint"


@pytest.mark.parametrize(
    "text, number",
    [
        ("n552.000 639502", 552.0),
        ("-5", -5.0),
        ("a-5b", -5.0),
        ("5.", 5.0),
        ("abc", None),
        ("", None),
        (None, None),
        ("10-20", 10.0),
        ("--3", -3.0),
    ],
)
def test_first_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(first_number("v")).first()[0] == number


def test_safe_long(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(safe_long("v")).collect()] == [12, 12, None, None]
    assert [r[0] for r in df.select(safe_long("v", -1)).collect()] == [12, 12, -1, -1]


def test_rounding_goes_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.675,)], "v double")
    assert [r[0] for r in df.select(rounded("v")).collect()] == list(np.round([0.125, 0.375, 2.675], 2))


def raw(spark):
    return spark.createDataFrame(
        [
            ("1000", 1, "view", 10, None),
            ("1000", 1, "view", 10, None),  # copy, null equals null
            ("1000", 1, "view", None, None),  # a missing item stays
            ("1000", None, "view", 10, None),
            ("oops", 1, "view", 10, None),
            (None, 1, "view", 10, None),
            ("2000", 2, "other", 10, None),
            ("2000", 2, None, 10, None),
            ("86400000", 2, "transaction", 11, 7),
        ],
        EVENTS,
    )


def test_clean_events(spark):
    kept = C.clean_events(raw(spark)).collect()
    assert sorted((r.visitorid, r.event, r.itemid or 0) for r in kept) == [
        (1, "view", 0),
        (1, "view", 10),
        (2, "transaction", 11),
    ]


def test_clean_events_stats_add_up(spark):
    s = C.clean_events_stats(raw(spark)).first()
    assert s.rows_before == 9
    assert (s.rows_dropped_bad_ts, s.rows_dropped_bad_event, s.rows_dropped_missing_visitor) == (2, 2, 1)
    assert s.duplicates_dropped == 1
    assert s.rows_after == 3 == C.clean_events(raw(spark)).count()
    assert (s.unique_visitors, s.unique_items) == (2, 2)
    assert C.clean_events_stats(raw(spark), approx=True).first().unique_visitors == 2
    assert (str(s.date_min), str(s.date_max)) == ("1970-01-01", "1970-01-02")


def test_clean_properties_and_stats(spark):
    rows = [
        ("1", 1, "price", "n9.5"),
        ("1", 1, "price", "n8"),  # same key: the smallest value stays
        ("2", 1, "price", "n7"),
        ("1", None, "price", "1"),
        ("1", 1, None, "1"),
        ("1", 1, "name", "red"),
        (None, 1, "price", "1"),
    ]
    df = spark.createDataFrame(rows, "timestamp string, itemid bigint, property string, value string")
    kept = sorted(tuple(r[1:]) for r in C.clean_properties(df).collect())
    assert kept == [(1, "price", 7.0), (1, "price", 8.0)]
    s = C.clean_properties_stats(df).first()
    assert (s.rows_before, s.rows_dropped_bad_ts, s.rows_dropped_bad_value) == (7, 1, 1)
    assert (s.rows_dropped_missing_ids, s.duplicates_dropped, s.rows_after) == (2, 1, 2)


def test_clean_category(spark):
    rows = [("5", "1"), ("5", "2"), ("6", None), (None, "1"), ("x", "3")]
    df = spark.createDataFrame(rows, "categoryid string, parentid string")
    kept = C.clean_category(df).collect()
    assert sorted((r.categoryid or 0, r.parentid) for r in kept) == [(0, 3), (5, 1), (6, -1)]
    s = C.clean_category_stats(df).first()
    assert (s.rows_before, s.rows_dropped_missing, s.duplicates_dropped, s.rows_after) == (5, 1, 1, 3)
    assert (s.unique_categories, s.unparsable_ids, s.unique_parents) == (2, 1, 3)
    assert C.clean_category(df.select("categoryid")).columns == ["categoryid"]


def test_category_ties(spark):
    rows = [("5", None), ("5", "10"), ("5", "11"), ("7", None), ("7.0", "3"), ("8", None)]
    df = spark.createDataFrame(rows, "categoryid string, parentid string")
    expected = [(5, 10), (7, 3), (8, -1)]  # a real parent before -1; 7 and 7.0 are one
    assert sorted(map(tuple, C.clean_category(df).collect())) == expected
    more = df.selectExpr("*", "'n' as name")
    assert sorted((r.categoryid, r.parentid) for r in C.clean_category(more).collect()) == expected
    assert C.clean_category_stats(df).first().rows_after == 3


def test_numbers_written_with_a_point(spark, tmp_path):
    from trailmart.sources import tables

    (tmp_path / "e.csv").write_text("timestamp,visitorid,event,itemid,transactionid\n1433221332117.0,257597.0,view,10.0,\n")
    raw_rows = tables.read_events(spark, str(tmp_path / "e.csv"))
    assert dict(raw_rows.dtypes)["visitorid"] == "bigint"
    row = C.clean_events(raw_rows).selectExpr("visitorid", "itemid", "unix_millis(timestamp) as ms").first()
    assert tuple(row) == (257597, 10, 1433221332117)


def test_dedupe_keyed_keeps_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert sorted(map(tuple, C.dedupe_keyed(df, ["k"], ["o"]).collect())) == [(1, 2, "b"), (2, 9, "z")]


def test_layout_splits_one_busy_instant(spark):
    df = spark.range(40_000).select(F.lit(1).cast("timestamp").alias("timestamp"), F.col("id").alias("visitorid"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = C.layout_by_time(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 20_000
