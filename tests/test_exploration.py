import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from trailmart.functions.histograms import equal_width_hist, fixed_hist
from trailmart.functions.ordering import exact_quantiles, with_position
from trailmart.operators import exploration as E

START = datetime(2024, 1, 1)


def stamp(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


@pytest.fixture(scope="module")
def busy(events):
    """One visitor holds a third of the rows, many at the same instant."""
    dice = random.Random(3)
    rows, at = [], 0
    for i in range(600):
        visitor = 1 if i % 3 == 0 else dice.randrange(2, 40)
        at += dice.choice([0, 0, 5, 61, 900, 1800, 1801])
        rows.append((visitor, at, dice.choice(["view", "view", "addtocart", "transaction"]), dice.randrange(30)))
    return rows, events([(v, stamp(s), e, i) for v, s, e, i in rows]).cache()


def sessions_by_loop(rows, gap=1800):
    times = defaultdict(list)
    for v, s, e, i in rows:
        times[v].append((s, e))
    found = []
    for v, visits in times.items():
        number, last = 0, None
        for s, e in sorted(visits):
            if last is None or s - last > gap:
                number += 1
            last = s
            found.append((v, number, s, e))
    return found


def test_session_gap_is_strict(events):
    ev = events(
        [
            (1, stamp(0), "view", 1),
            (2, stamp(10), "view", 1),
            (1, stamp(1799), "view", 1),
            (1, stamp(1799 + 1800), "view", 1),
            (1, stamp(1799 + 1800 + 1801), "view", 1),
        ]
    )
    got = sorted((r.visitorid, r.timestamp, r.session) for r in E.sessionize(ev).collect())
    assert [g[2] for g in got] == [1, 1, 1, 2, 1]


def test_sessions_match_a_loop(busy):
    rows, ev = busy
    expected = sessions_by_loop(rows)
    got = E.sessionize(ev).collect()
    assert Counter((r.visitorid, r.session, r.event) for r in got) == Counter((v, n, e) for v, n, _, e in expected)
    lengths = {(r.visitorid, r.session): r.length for r in E.session_lengths(ev).collect()}
    assert lengths == Counter((v, n) for v, n, _, _ in expected)
    shared = {r.session: r.length for r in E.session_lengths(ev, global_key=True).collect()}
    assert shared == Counter(n for _, n, _, _ in expected)


def test_funnel_rates(busy):
    rows, ev = busy
    kinds = defaultdict(set)
    for v, n, _, e in sessions_by_loop(rows):
        kinds[v, n].add(e)
    r = E.funnel_rates(E.session_funnel(ev)).first()
    assert r.sessions == len(kinds)
    assert r.view_to_cart == pytest.approx(np.mean([{"view", "addtocart"} <= k for k in kinds.values()]))
    bought = [{"transaction", "addtocart"} <= k for k in kinds.values() if "addtocart" in k]
    assert r.cart_to_transaction_given_cart == pytest.approx(np.mean(bought))


def test_gaps_match_a_loop(busy):
    rows, ev = busy
    times = defaultdict(list)
    for v, s, _, _ in rows:
        times[v].append(s)
    gaps = [b - a for t in times.values() for a, b in zip(sorted(t), sorted(t)[1:])]
    got = Counter()
    for r in E.inter_event_gaps(ev).collect():
        got[r.gap_seconds] += r.pairs
    assert got == Counter(gaps)
    expected, _ = np.histogram([g for g in gaps if g <= 1800], bins=E.GAP_EDGES)
    assert [r.n for r in E.gap_hist(ev).orderBy("bin").collect()] == list(expected)
    stats = E.gap_stats(ev).first()
    assert stats.median_gap_seconds == np.median(gaps)
    assert stats.share_within_minute == pytest.approx(np.mean([g <= 60 for g in gaps]))


def test_visitor_lengths(busy):
    rows, ev = busy
    lengths = [n for n in Counter(v for v, *_ in rows).values() if n > 1]
    stats = E.visitor_length_stats(ev).first()
    assert stats.median == np.median(lengths)
    assert stats.mean == pytest.approx(np.mean(lengths))
    assert stats.p95 == pytest.approx(np.percentile(lengths, 95))
    edges = np.linspace(2, np.percentile(lengths, 99), 15)
    expected, _ = np.histogram(lengths, bins=edges)
    got = E.visitor_length_hist(ev).orderBy("bin").collect()
    assert [r.n for r in got] == list(expected)
    assert [r.lower for r in got] == pytest.approx(list(edges[:-1]))


def test_clipped_hist_matches_numpy(spark):
    sizes = [1] * 50 + [2] * 30 + [3] * 10 + [7] * 5 + [40] * 3 + [500]
    df = spark.createDataFrame([(s,) for s in sizes], "length bigint")
    kept = [s for s in sizes if s <= np.quantile(sizes, 0.95)]
    expected, edges = np.histogram(kept, bins=30)
    got = E.clipped_hist(df, "length").orderBy("bin").collect()
    assert [r.n for r in got] == list(expected)
    assert got[-1].upper == edges[-1]


@pytest.mark.parametrize("values", [[0.0, 0.1, 0.2, 0.3, 0.7, 1.0], [5.0, 5.0], [i / 7 for i in range(50)]])
def test_equal_width_hist_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected, edges = np.histogram(values, bins=10)
    got = equal_width_hist(df, "v", 10).orderBy("bin").collect()
    assert [r.n for r in got] == list(expected)
    assert [r.lower for r in got] == pytest.approx(list(edges[:-1]))


def test_fixed_hist_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 1, 2, 3, 4)], "v double")
    assert [r.n for r in fixed_hist(df, "v", [0, 1, 3]).orderBy("bin").collect()] == [1, 3]


def test_popularity(events):
    ev = events([(1, stamp(i), "view", item) for i, item in enumerate([1, 1, 1, 2, 2, 3])])
    tail = [(r.itemid, r["rank"], r.cum_share) for r in E.long_tail(ev).orderBy("rank").collect()]
    assert tail == [(1, 1, 0.5), (2, 2, pytest.approx(5 / 6)), (3, 3, 1.0)]
    cover = {r.threshold: (r.items_needed, r.plot_cut) for r in E.coverage_items(ev).collect()}
    assert cover == {0.5: (1, 1), 0.8: (2, 2), 0.9: (3, 3)}
    assert {r.k: r.share for r in E.topk_coverage(ev, (1, 10)).collect()} == {1: 0.5, 10: 1.0}
    assert [r.itemid for r in E.item_popularity(ev, top=2).orderBy("itemid").collect()] == [1, 2]


def test_dense_days_and_heatmap(events):
    ev = events([(1, "2024-01-01 05:00:00", "view", 1), (1, "2024-01-03 05:30:00", "view", 1)])
    days = E.daily_volume(ev, dense=True).orderBy("date").collect()
    assert [r.n for r in days] == [1, 0, 1]
    heat = E.hour_weekday_heatmap(ev).collect()
    assert len(heat) == 1 and heat[0].hour == 5
    assert (heat[0].wday_0, heat[0].wday_1, heat[0].wday_2) == (1.0, 0.0, 1.0)


def test_missing_pct(events):
    ev = events([(1, stamp(0), "view", None), (1, stamp(0), "view", 2), (None, stamp(0), "view", 2)])
    got = {r["column"]: r.missing_pct for r in E.missing_pct(ev).collect()}
    assert got == {"visitorid": 33.3, "timestamp": 0.0, "event": 0.0, "itemid": 33.3}


def test_with_position_is_dense_over_partitions(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 as k").repartition(7)
    got = sorted((r.k, r.id, r.position) for r in with_position(df, ["k", "id"]).collect())
    assert [g[2] for g in got] == list(range(1, 5001))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    dice = random.Random(seed)
    values = [0.0] * 400 + [round(dice.gauss(0, 10), dice.choice([0, 3])) for _ in range(801)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    probs = [0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.99, 1]
    assert exact_quantiles(df, "v", probs) == pytest.approx(list(np.quantile(values, probs)), abs=0, rel=1e-15)
    weighted = spark.createDataFrame(list(Counter(values).items()), "v double, w bigint")
    assert exact_quantiles(weighted, "v", probs, "w") == pytest.approx(list(np.quantile(values, probs)), rel=1e-15)
    assert exact_quantiles(df.where("false"), "v", [0.5]) == [None]


@pytest.mark.parametrize(
    "values",
    [[1.0, 2.0, float("inf")], [float("-inf"), 1.0, 2.0, 3.0, float("inf")], [-1.7e308, 1.7e308, 0.0, 5.0], [float("inf")] * 3],
)
def test_quantiles_of_endless_and_huge_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values + [float("nan")]], "v double")
    probs = [0, 0.25, 0.5, 0.75, 1]
    with np.errstate(all="ignore"):
        wanted = [float(np.quantile(values, p, method="lower")) for p in probs]
    got = exact_quantiles(df, "v", probs)
    exact = [(p * (len(values) - 1)) % 1 == 0 for p in probs]
    assert [g for g, e in zip(got, exact) if e] == [w for w, e in zip(wanted, exact) if e]
    assert exact_quantiles(df.where("isnan(v)"), "v", [0.5]) == [None]
