import random

import pytest
from pyspark.sql import functions as F

from trailmart.operators import evaluation as V
from trailmart.operators import forecasting as M
from trailmart.session import scratch_path
from trailmart.sources import tables


@pytest.fixture(scope="module")
def features(spark):
    dice = random.Random(5)
    rows = []
    for item in range(30):
        for day in range(40):
            level = item % 6 + 1.0
            rows.append((item, day, level * 7, None if item % 5 == 0 else level, float(max(0, round(level + dice.gauss(0, 0.4))))))
    df = spark.createDataFrame(rows, "itemid bigint, d int, sales_sum_7d double, ctr_7d double, target_next7 double")
    return df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))).drop("d").repartition(4).cache()


def test_split_by_time(features):
    train, valid = M.temporal_split(features)
    assert train.count() + valid.count() == 1200
    assert str(valid.agg(F.min("date")).first()[0]) == "2024-02-02"
    assert train.agg(F.max("date")).first()[0] < valid.agg(F.min("date")).first()[0]


@pytest.mark.parametrize("by", ["date", "row"])
def test_expanding_folds(features, by):
    folded = M.expanding_folds(features, 5, by)
    sizes = {r.block: r["count"] for r in folded.groupBy("block").count().collect()}
    assert set(sizes) == set(range(6)) and sum(sizes.values()) == 1200
    unit = 1200 // 6 if by == "row" else 40 // 6 * 30
    assert all(sizes[b] == unit for b in range(1, 6))
    if by == "date":
        for r in M.fold_summary(folded).collect():
            assert r.train_until < r.valid_from


def test_oversampling(features):
    low = features.where("target_next7 <= 5").count()
    assert M.oversample_low(features).count() == 1200 + 2 * low
    assert M.oversample_low(features, as_weight=True).agg(F.sum("copies")).first()[0] == 1200 + 2 * low


@pytest.mark.parametrize("kind", ["poisson", "tweedie", "trees"])
def test_models_beat_the_mean(features, kind):
    rows = M.nonzero_target(features)
    train, valid = M.temporal_split(rows)
    model = M.train_forecast(train, valid, M.Candidate(kind, rounds=10))
    mean = train.agg(F.avg("target_next7")).first()[0]
    flat = valid.withColumn("forecast", F.lit(mean)).agg(V.wmape_of("target_next7", "forecast")).first()[0]
    assert M.score(model, valid) < 0.7 * flat
    if kind == "trees":
        gains = M.feature_importance(model)
        assert gains[0][0] in ("x_sales_sum_7d", "x_ctr_7d") and gains == sorted(gains, key=lambda g: (-g[1], g[0]))


def test_saved_model_is_the_same(spark, features):
    train, valid = M.temporal_split(M.nonzero_target(features))
    model = M.train_tweedie(train, 1.5)
    path = tables.save_model(model, scratch_path(spark, "model"))
    again = tables.load_model(spark, [path + "-none", path])
    assert M.score(again, valid) == pytest.approx(M.score(model, valid))
    with pytest.raises(FileNotFoundError):
        tables.load_model(spark, [path + "-none"])


def test_tuning_and_gate(spark, features):
    options = [M.Candidate("tweedie", regularisation=50.0), M.Candidate("tweedie", regularisation=0.01)]
    results, best = M.tune_forecast(M.nonzero_target(features), options, n_folds=2)
    assert len(results) == 4 and best == options[1]
    _, row = M.refit(M.nonzero_target(features), best)
    assert row["scored_on"] == "in_sample" and 0 < row["wmape"] < 0.3
    scores = spark.createDataFrame([("wmape", 0.1), ("hit_rate", 0.3), ("other", 1.0)], "metric string, value double")
    gate = {r.metric: r.passed for r in M.quality_gate(scores, {"wmape": 0.1}, {"hit_rate": 0.35}).collect()}
    assert gate == {"wmape": True, "hit_rate": False, "other": None}


def test_forecast_joins_the_mart_a_week_later(spark):
    mart = spark.sql("select 1L itemid, date'2024-01-08' date, 2L categoryid, 3d sales, 0d forecast")
    made = spark.sql("select 1L itemid, date'2024-01-01' date, 9d forecast")
    assert M.attach_forecast(mart, made).first().forecast == 9.0
