"""Boosted trees with the loss itself, and successive halving."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmart.operators import boosting as X
from trailmart.operators import forecasting as M
from trailmart.operators import search as S
from trailmart.operators.evaluation import wmape_of
from trailmart.operators.recommending import RecoCandidate
from trailmart.session import scratch_path


@pytest.fixture(scope="module")
def demand(spark):
    """Counts whose mean is far from linear in the features, with a column of nulls."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1500):
        a, b = rng.random(2) * 4
        mean = 1 + 12 * ((a > 2) != (b > 2)) + 3 * (1 < a < 1.5)
        target = float(max(rng.poisson(mean), 1))
        rows.append((i % 200, f"2024-03-{1 + i % 28:02d}", float(a), None if i % 5 == 0 else float(b), 1.0 + i % 3, target))
    df = spark.createDataFrame(rows, "itemid long, date string, a double, b double, sales_sum_7d double, target_next7 double")
    df = df.withColumn("date", F.to_date("date"))
    path = scratch_path(spark, "demand")
    df.write.parquet(path)
    return M.temporal_split(spark.read.parquet(path))


def wmape(pred):
    return pred.agg(wmape_of(M.TARGET, "forecast")).first()[0]


@pytest.mark.parametrize("power", [1.0, 1.4])
def test_boosting_beats_the_linear_fit_and_the_mean(spark, demand, power):
    train, valid = demand
    model = X.train_boosted(train, valid, X.Boosting(power=power, rounds=20, depth=3, step=0.4, patience=4))
    losses = [c[1] for c in model.curve]
    assert all(a > b for a, b in zip(losses, losses[1:])) and len(model.trees) > 4
    mean = train.agg(F.avg(M.TARGET)).first()[0]
    linear = M.predict(M.train_forecast(train, valid, M.Candidate("poisson")), valid)
    ours = wmape(model.predict(valid))
    assert ours < 0.9 * wmape(linear) and ours < 0.9 * wmape(valid.withColumn("forecast", F.lit(mean)))


def test_patience_keeps_the_best_round(spark, demand):
    train, valid = demand
    noise = train.withColumn(M.TARGET, F.rand(3) * 5 + 1)
    model = X.train_boosted(noise, valid.withColumn(M.TARGET, F.rand(4) * 5 + 1), X.Boosting(rounds=30, depth=4, step=0.5, patience=2))
    held = [c[2] for c in model.curve]
    best = min(range(len(held)), key=held.__getitem__)
    assert len(model.trees) == best and len(held) == best + 3 < 30
    kept = X.curve_table(spark, model).where("kept").count()
    assert kept == best + 1


def test_leaf_values_are_best_for_the_loss(spark, demand):
    """One whole step: in each leaf the derivative of the loss is zero."""
    train, _ = demand
    for power in (1.0, 1.5):
        model = X.train_boosted(train, None, X.Boosting(power=power, rounds=1, step=1.0, depth=2), floor=0.5)
        rows = model.scores(X._ready(M.sample_weight(train, 0.5), model.names))
        up, down = X.pull(F.col(M.TARGET), F.col("_score"), power)
        found = rows.groupBy(F.round("_score", 9)).agg(F.sum(F.col("sample_weight") * (up - down)).alias("g"), F.sum(F.col("sample_weight") * down).alias("s"))
        assert all(abs(r.g) < 1e-9 * r.s for r in found.collect())


def test_saved_model_predicts_the_same(spark, demand):
    train, valid = demand
    model = X.train_boosted(train, valid, X.Boosting(rounds=3))
    again = X.BoostedModel.load(spark, model.save(scratch_path(spark, "boosted")))
    assert sorted(again.predict(valid).collect()) == sorted(model.predict(valid).collect()) and again.curve == model.curve


def test_no_sales_at_all_is_an_error(spark, demand):
    train, _ = demand
    with pytest.raises(ValueError):
        X.train_boosted(train.withColumn(M.TARGET, F.lit(0.0)), None)


def test_halving_promotes_the_best(spark):
    worth = [0.1, 0.9, None, 0.5, 0.9, float("nan"), 0.2]
    asked = []

    def evaluate(candidate, share):
        asked.append((candidate, share))
        return worth[candidate] if share < 100 or candidate != 1 else 0.3

    scores, best = S.successive_halving(spark, 7, evaluate, rungs=(10, 40, 100), keep=0.5)
    assert best == 4
    assert [(s.candidate, s.promoted) for s in scores if s.rung == 0] == [(0, False), (1, True), (2, False), (3, True), (4, True), (5, False), (6, True)]
    assert [(s.candidate, s.promoted) for s in scores if s.rung == 1] == [(1, True), (3, False), (4, True), (6, False)]
    assert [(s.candidate, s.promoted) for s in scores if s.rung == 2] == [(1, False), (4, True)]
    assert len(asked) == 7 + 4 + 2


def test_rungs_grow(spark):
    ids = spark.range(2000).withColumnRenamed("id", "visitorid")
    parts = [{r.visitorid for r in ids.where(S.in_rung("visitorid", share)).collect()} for share in (25, 50, 100)]
    assert parts[0] < parts[1] < parts[2] and len(parts[2]) == 2000 and 400 < len(parts[0]) < 600


def test_search_of_both_models(spark, demand):
    f = demand[0].unionByName(demand[1])
    scores, best = S.search_forecast(f, [X.Boosting(rounds=0), X.Boosting(rounds=8, step=0.5)], rungs=(60, 100))
    assert best == 1 and {s.share for s in scores} == {60, 100}
    seq = spark.createDataFrame([(v, [1, 2, 3, 4] if v % 2 else [4, 3, 2, 1]) for v in range(300)], "visitorid long, item_seq array<int>")
    scores, best = S.search_reco(seq, [RecoCandidate(), RecoCandidate(window=3)], rungs=(100,))
    assert all(s.score > 0.5 for s in scores) and best in (0, 1)
