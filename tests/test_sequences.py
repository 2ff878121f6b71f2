from dataclasses import replace

import pytest

from trailmart.operators import recommending as R
from trailmart.operators import sequences as Q
from trailmart.params import Params


@pytest.fixture(scope="module")
def cats(spark):
    return spark.createDataFrame([(30, -1), (20, 30)], "categoryid bigint, parentid bigint")


def test_sequences_keep_the_last_fifty(events, properties, cats):
    rows = [(1, f"2024-01-01 00:{m:02d}:30", "view", 100 + m) for m in range(51)]
    rows += [(2, "2024-01-01 00:00:00", "view", 7), (2, "2024-01-01 00:00:00", "view", 5)]
    rows += [(3, "2024-01-01 00:00:00", "view", None)]
    props = properties([("2024-01-01 00:00:00", 5, "categoryid", 30.0), ("2024-01-01 00:00:00", 7, "categoryid", 99.0)])
    seq = {r.visitorid: r for r in Q.reco_sequences(events(rows), props, cats).collect()}
    assert set(seq) == {1, 2}  # nothing usable from visitor 3
    assert seq[1].item_seq == list(range(2, 52))  # the first event is beyond the cap
    assert seq[1].time_seq == [float(i) for i in range(50)]
    # equal times go by item; category 99 is unknown
    assert seq[2].item_seq == [52, 53]
    assert seq[2].cat_seq == [2, 0]


def test_item_index_follows_first_appearance(events):
    ev = events([(2, "2024-01-01 00:00:00", "view", 1), (1, "2024-01-02 00:00:00", "view", 9), (1, "2024-01-01 00:00:00", "view", 5)])
    assert {r.itemid: r.item_idx for r in Q.item_index(ev).collect()} == {5: 1, 9: 2, 1: 3}


def test_fanout_repeats_events_per_category_row(events, properties, cats):
    ev = events([(1, "2024-01-01 00:00:00", "view", 5)])
    props = properties([("2024-01-01 00:00:00", 5, "categoryid", 30.0), ("2024-01-02 00:00:00", 5, "categoryid", 20.0)])
    plain = Q.reco_sequences(ev, props, cats).first()
    spread = Q.reco_sequences(ev, props, cats, replace(Params(), category_fanout=True)).first()
    assert (plain.item_seq, plain.cat_seq) == ([1], [2])
    assert (spread.item_seq, spread.cat_seq) == ([1, 1], [2, 1])


def seqs(spark, *lists):
    return spark.createDataFrame(list(enumerate(map(list, lists), 1)), "visitorid bigint, item_seq array<bigint>")


def test_cut_of_history_and_target(spark):
    got = {r.visitorid: (r.history, r.target) for r in R.leave_last_out(seqs(spark, [], [1], [1, 2], range(1, 52), range(1, 53))).collect()}
    assert got[3] == ([1], 2)
    assert got[4] == (list(range(1, 51)), 51)
    assert got[5] == (list(range(2, 52)), 52)
    assert set(got) == {3, 4, 5}


def test_cooccurrence_weights(spark):
    a, b, c = 1, 2, 3
    df = seqs(spark, [a, b, a, c], [])
    got = {(r.anchor, r.other): r.weight for r in R.cooccurrence_weights(df).collect()}
    assert got[a, b] == 1.0 and got[a, c] == 0.5
    assert got[b, a] == 1.5  # one before, one after
    assert got[c, a] == pytest.approx(1 / 4 + 1 / 2) and got[c, b] == pytest.approx(1 / 3)
    assert (a, a) not in got


def test_cooccurrence_top_and_anchor_filter(spark):
    df = seqs(spark, [1, 2, 3, 4], [1, 2], [9, 8])
    top = R.cooccurrence(df, 2)
    assert [(r.other, r["rank"]) for r in top.where("anchor = 1").orderBy("rank").collect()] == [(2, 1), (3, 2)]
    only = R.cooccurrence(df, 2, anchors=df.sparkSession.createDataFrame([(1,)], "anchor bigint"))
    assert sorted(map(tuple, only.collect())) == sorted(map(tuple, top.where("anchor = 1").collect()))


def test_confidence_tiers(spark):
    df = seqs(spark, [1, 2], [1, 2], [1, 3])
    got = {(r.anchor, r.other): (round(r.confidence, 4), r.tier) for r in R.reco_confidence(R.cooccurrence(df), df).collect()}
    assert got[1, 2] == (66.6667, "Medium")
    assert got[1, 3] == (33.3333, "Low")
    assert got[3, 1] == (50.0, "Medium")


def test_transitions_and_window(spark):
    df = seqs(spark, [1, 2, 1, 2], [5])
    assert {(r.item, r.next): r.n for r in R.transitions(df).collect()} == {(1, 2): 2, (2, 1): 1}
    wide = {(r.item, r.next): r.score for r in R.transitions(df, window=3, decay=0.5).collect()}
    assert wide == {(1, 2): 2.25, (2, 1): 1.0, (1, 1): 0.5, (2, 2): 0.5}


def test_hits_at_the_edge_of_k(spark):
    rows = [([4, 5, 6], 4), ([4, 5, 6], 5), ([4, 5, 6], 6), ([4, 5, 6], 7), ([], 4)]
    df = spark.createDataFrame(rows, "top array<bigint>, target bigint")
    m = R.hit_ndcg(df, 2).first()
    assert m.samples == 5 and m.hit_rate == pytest.approx(2 / 5)
    import math

    assert m.ndcg == pytest.approx((1 + 1 / math.log2(3)) / 5)


def test_model_ranks_followers(spark):
    df = seqs(spark, [1, 2], [1, 2], [1, 3], [1, 4])
    best = {r["item"]: [c.next for c in r.candidates] for r in R.next_item_model(df, k=2).collect()}
    assert best == {1: [2, 3]}
    # 1 is followed by 2, 3 and 4; free places go to the most popular items: 1, 2, 3, 4
    hist = R.leave_last_out(seqs(spark, [1, 2], [7, 8]))
    scored = R.topk_next(R.transitions(df), hist, R.popular_items(df, 6), 3)
    assert {r.visitorid: r.top for r in scored.collect()} == {1: [2, 3, 4], 2: [1, 2, 3]}


def test_answers_are_full_and_use_the_whole_history(spark):
    df = seqs(spark, [1, 5], [1, 5], [2, 6], [2, 6], [2, 6], [9], [9], [9], [9])
    hist = R.leave_last_out(seqs(spark, [1, 2, 99], [3, 98]))
    top = {r.visitorid: r.top for r in R.topk_next(R.transitions(df), hist, R.popular_items(df, 20), 10).collect()}
    assert top[1][:2] == [6, 5]  # the last item's follower before the earlier one's
    assert [len(t) for t in top.values()] == [5, 5] and top[2][0] == 9  # all items there are, popular ones first
    flat = R.topk_next(R.transitions(df), hist.where("visitorid = 1"), R.popular_items(df, 4), 2, recency=0.0).first()
    assert flat.top == [6, 9]


def test_popularity_baseline(spark):
    train = seqs(spark, [1, 2], [2, 3], [2])
    hist = R.leave_last_out(seqs(spark, [1, 2], [5, 6]))
    assert {r.visitorid: r.top for r in R.popularity_baseline(train, hist, 2).collect()} == {1: [2, 1], 2: [2, 1]}


def test_recommendations_in_item_ids(spark):
    items = spark.createDataFrame([(700, 1), (800, 2), (900, 3)], "itemid long, item_idx long")
    rows = R.item_recommendations(seqs(spark, [1, 2, 3], [1, 2]), items, 1).collect()
    assert {(r.itemid, r.recommended) for r in rows} == {(700, 800), (800, 700), (900, 800)} or len(rows) == 3
    assert {r.itemid for r in rows} == {700, 800, 900}


def test_split_is_stable_and_whole(spark):
    df = seqs(spark, *[[1]] * 500)
    train, test = R.visitor_split(df)
    ids = {r.visitorid for r in train.collect()}
    assert 350 < len(ids) < 450
    assert ids.isdisjoint({r.visitorid for r in test.collect()}) and len(ids) + test.count() == 500


def test_tuning_finds_the_better_window(spark):
    # the next item is always two steps back in every session
    lists = [[a, b, a, b] for a in range(1, 20) for b in (a + 100, a + 200)] * 3
    results, best = R.tune_reco(seqs(spark, *lists), [R.RecoCandidate(window=1), R.RecoCandidate(window=2, decay=1.0)])
    assert [r["scored_on"] for r in results] == ["holdout", "holdout", "in_sample"]
    assert best in (R.RecoCandidate(window=1), R.RecoCandidate(window=2, decay=1.0))
    assert all(0 <= r["ndcg"] <= r["hit_rate"] <= 1 for r in results)
    curve = R.training_curve(spark.createDataFrame(results)).orderBy("iteration").collect()
    assert curve[1].best_ndcg == max(c.ndcg for c in curve)
