import math

import pytest

from trailmart.operators import evaluation as V
from trailmart.operators import mart as B


def table(spark, rows):
    df = spark.createDataFrame(rows, "itemid bigint, date string, categoryid bigint, sales double, forecast double")
    return df.withColumn("date", df.date.cast("date"))


@pytest.fixture(scope="module")
def mart(spark):
    return table(
        spark,
        [
            (1, "2024-01-01", 7, 10.0, 9.0),
            (1, "2024-01-02", 7, 20.0, 19.0),
            (2, "2024-01-02", 7, 5.0, 4.0),
            (3, "2024-01-03", 8, 25.0, 30.0),
        ],
    ).cache()


def test_filters(mart):
    assert B.filter_dates(mart, "2024-01-02", "2024-01-02").count() == 2
    with pytest.raises(ValueError):
        B.filter_dates(mart, "2024-01-03", "2024-01-02")
    assert B.filter_categories(mart, [8]).count() == 1
    assert B.filter_categories(mart, []).count() == B.filter_categories(mart).count() == 4


def test_best_day_is_the_earliest_of_equals(mart):
    r = B.best_worst_day(mart).first()
    assert (str(r.best_day), r.best_sales, str(r.worst_day), r.worst_sales) == ("2024-01-02", 25.0, "2024-01-01", 10.0)
    assert r.avg_daily_sales == 20.0
    assert B.sales_trend(mart).first().slope == pytest.approx(7.5)


def test_insights(mart):
    lines = {r.position: r.insight for r in B.insights(mart, V.forecast_metrics(mart)).collect()}
    assert lines[1] == "Total Revenue: $60.00 across 4 transactions"
    assert lines[3] == "Best Sales Day: 2024-01-02 with $25.00"
    assert lines[5] == "Top Category: 7 ($35.00)"
    assert lines[6] == "Category Spread: 2 categories with 4 total transactions"
    assert lines[7] == "Best Selling Item: 1 ($30.00)"
    assert lines[9].startswith("Model Quality: Excellent")
    assert lines[10] == "Prediction Error: 13.8% average error rate"
    assert lines[11] == "Sales Trend: Growing at $7.50 per day"
    assert [r.insight for r in B.insights(mart.where("false")).collect()] == [
        "No data available for analysis."
    ]
    one_day = B.insights(mart.where("date = '2024-01-01'"))
    assert 11 not in {r.position for r in one_day.collect()}


def test_pages(mart):
    dive = {r.itemid: r for r in B.item_deep_dive(mart).collect()}
    assert (dive[1].total_sales, str(dive[1].peak_day), dive[1].peak_sales) == (30.0, "2024-01-02", 20.0)
    cats = {r.categoryid: (r.revenue, r["items"], round(r.share_pct, 4)) for r in B.category_deep_dive(mart).collect()}
    assert cats == {7: (35.0, 2, 58.3333), 8: (25.0, 1, 41.6667)}
    top = B.top_products_in_category(mart, 1).orderBy("categoryid").collect()
    assert [(r.categoryid, r.itemid) for r in top] == [(7, 1), (8, 3)]


def test_projection(spark):
    long = [(1, f"2024-01-{d:02d}", 1, float(d), 0.0) for d in range(1, 21)]
    df = table(spark, long + [(2, "2024-01-05", 1, 9.0, 0.0), (3, "2024-01-05", 1, 0.0, 0.0), (3, "2024-01-06", 1, 0.0, 0.0)])
    got = B.item_projection(df, 3).orderBy("itemid", "date").collect()
    mean, step = sum(range(7, 21)) / 14, 1.0
    for h in (1, 2, 3):
        wave = 1 + 0.15 * math.sin(2 * math.pi * (h - 1) / 7)
        assert got[h - 1].forecast == pytest.approx(mean * wave * (1 + step / mean * h * 0.1))
    assert [str(r.date) for r in got[:3]] == ["2024-01-21", "2024-01-22", "2024-01-23"]
    assert [r.forecast for r in got[3:6]] == [None] * 3  # one row has no step
    assert [r.forecast for r in got[6:]] == [0.0] * 3
    grown = {r.itemid: r.growth_pct for r in B.growth(B.item_projection(df), df, "itemid").collect()}
    assert grown[3] == 0.0 and grown[2] is None
    noisy = B.item_projection(df, 3, noise=0.08, seed=4).where("itemid = 1").collect()
    assert all(r.forecast >= 0 for r in noisy) and noisy[0].forecast != got[0].forecast


def lengths(spark, sizes):
    return spark.createDataFrame([(i, list(range(n))) for i, n in enumerate(sizes)], "visitorid bigint, item_seq array<bigint>")


def test_sequence_tables(spark):
    seq = lengths(spark, [1, 1, 2, 2, 4, 11])
    k = B.sequence_kpis(seq).first()
    assert (k.sessions, k.median_length, k.mode_length, k.max_length, k.interactions) == (6, 2.0, 1, 11, 21)
    assert {r.bucket: r.sessions for r in B.length_buckets(seq).collect()} == {"quick": 4, "regular": 1, "deep": 1}
    unit = B.sequence_hist(seq).orderBy("bin").collect()
    assert len(unit) == 11 and unit[0].n == 2 and unit[10].n == 1
    assert len(B.sequence_hist(lengths(spark, [1, 30])).collect()) == 25
    assert [(r["item"], r.n) for r in B.trending_items(seq, 2).collect()] == [(0, 6), (1, 4)]


def test_session_explorer(spark):
    seq = lengths(spark, [3, 12])
    one = B.session_explorer(seq, 1).collect()
    everyone = {r.visitorid: r for r in B.session_explorer(seq).collect()}
    assert len(one) == 1 and one[0] == everyone[1]
    assert one[0].first_items == list(range(10)) and one[0].last_item == 11
    assert [x.other for x in everyone[0].recommended][0] == 1


def test_sample_is_bounded_and_repeatable(mart):
    a, b = (B.actual_vs_forecast_sample(mart, 3).collect() for _ in range(2))
    assert a == b and len(a) == 3
    assert a[0].axis_min == min(min(r.sales, r.forecast) for r in a)
