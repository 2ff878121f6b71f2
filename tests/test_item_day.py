import random
from dataclasses import replace

import pytest

from trailmart.functions.ordering import carry_forward_by_id
from trailmart.operators import item_day as D
from trailmart.params import Params


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("itemid", "date").collect()]


def sales(item, day, n=1, event="transaction"):
    return [(100 + i, f"2024-01-{day:02d} 10:00:{i:02d}", event, item) for i in range(n)]


def test_counts_leave_out_null_items_and_keep_zero_columns(events):
    ev = events(sales(1, 1, 2) + sales(1, 1, 3, "view") + [(5, "2024-01-01 00:00:00", "view", None)])
    assert rows_of(D.daily_item_counts(ev), "views", "adds", "sales") == [(3, 0, 2)]


def test_windows_count_rows_not_days(events):
    day = D.with_day(D.daily_item_counts(events(sales(1, 1, 1) + sales(1, 10, 2) + sales(1, 30, 4) + sales(2, 5, 1))))
    sums = D.rolling_sums(day, (3,))
    assert rows_of(sums, "sales_sum_3d") == [(1.0,), (3.0,), (7.0,), (1.0,)]
    assert rows_of(D.sales_lags(day, (1,)), "sales_lag_1d", "sales_lag_dow")[:3] == [(0, 0), (1, 0), (2, 0)]


def test_target_is_exactly_seven_days_ahead(events):
    day = D.with_day(D.daily_item_counts(events(sales(1, 1) + sales(1, 7, 5) + sales(1, 8, 3) + sales(1, 9, 4))))
    assert rows_of(D.target_at(day), "target_next7") == [(3.0,), (0.0,), (0.0,), (0.0,)]


@pytest.mark.parametrize("scale", [1, 2**22 + 7, 2**43 + 11])
def test_fill_matches_a_plain_loop_at_any_id_size(spark, scale):
    dice = random.Random(scale)
    keys = sorted(dice.sample(range(400), 120))
    data = [(k * scale, dice.choice([None, None, round(dice.random(), 3)])) for k in keys]
    df = spark.createDataFrame(data, "itemid bigint, price double").repartition(4)
    last, expected = None, {}
    for key, price in data:
        last = price if price is not None else last
        expected[key] = last
    filled = carry_forward_by_id(df, "itemid", "price")
    assert {r.itemid: r.price for r in filled.collect()} == expected


def test_fill_sorts_nothing_in_one_task(spark):
    df = spark.range(1000).selectExpr("id as itemid", "cast(null as double) as price")
    plan = carry_forward_by_id(df, "itemid", "price")._jdf.queryExecution().executedPlan().toString()
    items = [line for line in plan.splitlines() if "SinglePartition" in line and "itemid" in line]
    assert not items


@pytest.fixture(scope="module")
def shop(events, properties):
    ev = events(
        sales(1, 1, 2, "view") + sales(1, 1) + sales(2, 1, 1) + sales(2, 2, 4, "view") + sales(2, 2, 1, "addtocart")
        + sales(3, 2, 2) + sales(4, 3, 1, "view")
    )
    props = properties(
        [
            ("2024-01-02 00:00:00", 2, "price", 20.0),
            ("2024-01-01 00:00:00", 2, "price", 10.0),  # the earlier one counts
            ("2024-01-01 00:00:00", 4, "price", 40.0),
            ("2024-01-01 00:00:00", 9, "price", 90.0),  # no events
            ("2024-01-01 00:00:00", 1, "categoryid", 7.0),
            ("2024-01-01 00:00:00", 2, "categoryid", 7.0),
            ("2024-01-01 00:00:00", 4, "categoryid", 8.0),
        ]
    )
    return ev, props


def test_price_is_filled_across_items_unless_scoped(shop):
    def price(scope):
        return {r.itemid: r.price for r in D.priced_items(*shop, scope).collect()}

    assert price("global") == {1: None, 2: 10.0, 3: 10.0, 4: 40.0}
    assert price("item") == {1: None, 2: 10.0, 3: None, 4: 40.0}


def test_forecast_features(shop):
    f = D.forecast_features(*shop)
    assert f.columns == D.feature_columns()
    got = {(r.itemid, r.date.day): r for r in f.collect()}
    assert len(got) == 5
    # no views in the window: the ratio is null, but counts as 0 when smoothed
    assert got[2, 1].ctr_7d is None and got[2, 2].ctr_7d == 0.25
    mean = (0 + 0 + 0.25) / 3
    assert got[2, 2].ctr_sm_7d == pytest.approx((0.25 + 10 * mean) / 11)
    assert got[1, 1].cat_sales_7d == 2.0 and got[2, 2].cat_sales_7d == 1.0
    assert got[2, 2].sales_sm_7d == pytest.approx((1 + 5 * 1.0) / 6)
    # no category: nothing to smooth towards
    assert got[3, 2].sales_sm_7d is None and got[3, 2].cat_sales_7d is None
    assert (got[1, 1].dow_0, got[1, 1].dow_1, got[1, 1].is_weekend, got[1, 1].weekofyear) == (1, 0, 0, 1)


def test_further_events_are_kept_as_counts(events, properties):
    ev = events(sales(1, 1) + sales(1, 1, 2, "removefromcart"))
    columns = {**Params().event_columns, "removefromcart": "removefromcart"}
    f = D.forecast_features(ev, properties([]), replace(Params(), event_columns=columns))
    assert rows_of(f, "removefromcart", "sales_sum_3d") == [(2, 1.0)]


def test_item_scope_parameter(shop):
    f = D.forecast_features(*shop, replace(Params(), price_scope="item"))
    assert {r.itemid: r.price for r in f.collect()}[3] is None


def test_price_change_needs_seven_rows(events, properties):
    ev = events([row for d in range(1, 10) for row in sales(1, d)])
    props = properties([("2024-01-01 00:00:00", 1, "price", 5.0)])
    f = D.forecast_features(ev, props)
    assert rows_of(f, "price_pct_chg_7d") == [(None,)] * 7 + [(0.0,)] * 2
    free = properties([("2024-01-01 00:00:00", 1, "price", 0.0)])
    assert rows_of(D.forecast_features(ev, free), "price_pct_chg_7d") == [(None,)] * 9
