"""Shapes of the physical plans, the batch stages, and the SQL oracles."""

import os
import re

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from trailmart.operators import exploration as E
from trailmart.operators import item_day as D
from trailmart.operators import sequences as Q
from trailmart.plans import stages
from trailmart.plans.catalog import QUERIES
from trailmart.plans.oracle import ORACLES
from trailmart.session import scratch_path
from trailmart.sources.adapter import StarTables

SMALL = "/root/testdata/sf0.001"
# A few of each kind; ALL_QUERIES=1 runs every one.
SOME = [
    "scan_events", "parquet_roundtrip", "clean_events_stats", "clean_properties", "forecast_features",
    "reco_sequences", "sessionize", "session_length_hist", "long_tail", "coverage_items", "gap_stats",
    "expanding_folds", "tercile_matrix", "mape_by_quintile", "hit_ndcg", "reco_confidence", "insights",
    "category_projection", "session_explorer", "selector_dates", "price_change_asof", "forecast_features_stored", "features_new_day",
    "targets_due", "boosting_start", "boosting_balance", "tune_reco_rungs", "stream_clean_events", "stream_sessions", "sketch_ranges",
    "top_items_bounded", "item_index_extended", "item_projection_noise", "bot_filter", "min_interactions", "drop_missing_category",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return StarTables(spark, SMALL)


def test_features_move_only_narrow_rows(star):
    text = plan(D.forecast_features(star.events(), star.properties()))
    head = text.split("Exchange", 1)[0]
    # All frames of all columns are in the one window above the topmost shuffle.
    assert head.count("+- Window") == 1 and head.count("Sort ") == 1
    assert "sales_sum_60d" in head and "Python" not in text


def test_scan_reads_only_needed_columns(star):
    text = plan(E.daily_volume(star.events()))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert schema == "struct<ts:timestamp_ntz,event_type:string>"


def test_gaps_read_the_events_once(star):
    df = E.gap_hist(star.all_events())
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_last_n_is_limited_before_the_shuffle(star):
    text = plan(Q.last_n_per_visitor(star.events()))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_session_window_runs_on_folded_blocks(star):
    text = plan(E.session_lengths(star.events()))
    window = text.index("+- Window")
    assert "HashAggregate" in text[window:] and "partial_min" in text[window:]


def test_every_query_is_registered_with_sql_or_reason():
    # Fitted models and their tuning tables have no SQL form.
    assert set(QUERIES) - set(ORACLES) == {
        "train_forecast", "train_forecast_trees", "train_tweedie", "predict", "saved_model_predict",
        "feature_importance", "tune_forecast", "train_boosted", "boosting_curve", "tune_forecast_rungs", "vector_recommendations",
    }
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("ALL_QUERIES") else SOME)
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SMALL), name, SMALL) is None


def test_batch_stages(spark, star):
    raw, interim, processed = (scratch_path(spark, n) for n in ("raw", "interim", "processed"))
    star.raw_events().write.csv(f"{raw}/events.csv", header=True)
    props = star.raw_properties()
    props.where("itemid % 2 = 0").write.csv(f"{raw}/item_properties_part1.csv", header=True)
    props.where("itemid % 2 = 1").write.csv(f"{raw}/item_properties_part2.csv", header=True)
    star.raw_categories().write.csv(f"{raw}/category_tree.csv", header=True)
    stats = stages.clean(spark, raw, interim)
    kept = spark.read.parquet(f"{interim}/events_clean")
    assert kept.count() == stats["events"].first().rows_after > 0
    stages.features(spark, interim, processed)
    assert spark.read.parquet(f"{processed}/reco_sequences").count() > 0
    gate = stages.train_forecast(spark, processed, f"{processed}/model")
    assert {r.metric for r in gate.collect()} == {"mae", "wmape"}
    gate = stages.train_recommender(spark, processed, f"{processed}/next_items")
    assert {r.metric: r["limit"] for r in gate.collect()} == {"hit_rate": 0.35, "ndcg": 0.14, "samples": None}
    assert spark.read.parquet(f"{processed}/item_dim").agg(F.max("item_idx")).first()[0] > 0
