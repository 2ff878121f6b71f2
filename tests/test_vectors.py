"""Learned item vectors and the search among them."""

import random

import pytest

from trailmart.operators import recommending as R
from trailmart.operators import vectors as W
from trailmart.session import scratch_path


@pytest.fixture(scope="module")
def tastes(spark):
    """Visitors who walk at random among the 20 items of one of 30 tastes; too few for most pairs to be seen."""
    rng = random.Random(2)
    rows = []
    for v in range(500):
        taste = rng.randrange(30)
        rows.append((v, [1 + taste * 20 + rng.randrange(20) for _ in range(9)]))
    path = scratch_path(spark, "tastes")
    spark.createDataFrame(rows, "visitorid bigint, item_seq array<bigint>").write.parquet(path)
    return spark.read.parquet(path)


def test_vectors_beat_counts_and_popularity(spark, tastes):
    train, test = R.visitor_split(tastes)
    hist, popular = R.leave_last_out(test), R.popular_items(train, 40)
    m = W.VectorModel(rank=32, window=8, decay=0.9)
    before, after = W.item_vectors(train, m)
    visitors = W.visitor_vectors(hist, before, m)
    found = W.nearest(visitors, after, 20, m)
    ours = R.hit_ndcg(W.recommend(hist, found, popular)).first()
    counts = R.hit_ndcg(R.topk_next(R.transitions(train), hist, popular)).first()
    base = R.hit_ndcg(R.popularity_baseline(train, hist)).first()
    assert ours.samples == counts.samples > 50
    assert ours.hit_rate > counts.hit_rate > base.hit_rate and ours.ndcg > base.ndcg
    assert ours.hit_rate > 0.35
    assert W.recall(found, visitors, after, 20).first().recall >= 0.9


def test_inner_products_become_distances(spark):
    after = spark.createDataFrame([(1, [3.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, -2.0]), (4, [0.0, 0.0])], "next long, vector array<float>")
    for r in W.one_length(after).collect():
        assert abs(sum(x * x for x in r.point) - 1) < 1e-6
    visitors = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, -1.0]), (3, [0.0, 0.0])], "visitorid long, vector array<double>")
    got = W.nearest(visitors, after, 2, W.VectorModel(rank=2, bucket=4.0)).orderBy("visitorid", "distance").collect()
    assert [(r.visitorid, r.next) for r in got] == [(1, 1), (1, 2), (2, 3)]


def test_free_places_go_to_popular_items(spark):
    hist = spark.createDataFrame([(1, [5], 9), (2, [6], 8)], "visitorid long, history array<long>, target long")
    found = spark.createDataFrame([(1, 7, 0.5), (1, 20, 0.2)], "visitorid long, next long, distance double")
    popular = spark.createDataFrame([(20, 1), (21, 2), (22, 3), (23, 4)], "next long, place int")
    got = {r.visitorid: list(r.top) for r in W.recommend(hist, found, popular, 3).collect()}
    assert got == {1: [20, 7, 21], 2: [20, 21, 22]}


def test_plan_has_no_join_of_all_pairs(spark, tastes):
    m = W.VectorModel()
    before, after = W.item_vectors(tastes, m)
    text = W.nearest(W.visitor_vectors(R.leave_last_out(tastes), before, m), after, 5, m)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
