"""Batch stages: plain functions from input folders to written tables and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting, cleaning, evaluation, forecasting, recommending, search
from ..operators.item_day import daily_item_counts, forecast_features, item_attribute
from ..operators.mart import build_mart
from ..operators.sequences import item_index, reco_sequences
from ..params import Params
from ..sources import tables

DEFAULTS = Params()


def clean(spark: SparkSession, raw: str, out: str) -> dict[str, DataFrame]:
    """Clean the CSV inputs below ``raw`` into parquet below ``out``; returns the counters."""
    events = tables.read_events(spark, f"{raw}/events.csv")
    parts = [f"{raw}/item_properties_part1.csv", f"{raw}/item_properties_part2.csv"]
    properties = tables.read_properties(spark, parts)
    categories = tables.read_categories(spark, f"{raw}/category_tree.csv")
    dated = cleaning.clean_events(events).withColumn("date", F.to_date("timestamp"))
    # Whole days per file group, sorted by time inside.
    tables.write_table(cleaning.layout_by_time(dated), f"{out}/events_clean", partition_by="date")
    tables.write_table(cleaning.clean_properties(properties), f"{out}/item_properties")
    tables.write_table(cleaning.clean_category(categories), f"{out}/category_tree")
    return {
        "events": cleaning.clean_events_stats(events),
        "item_properties": cleaning.clean_properties_stats(properties),
        "category_tree": cleaning.clean_category_stats(categories),
    }


def features(spark: SparkSession, interim: str, out: str, params: Params = DEFAULTS) -> None:
    events = tables.read_table(spark, f"{interim}/events_clean")
    properties = tables.read_table(spark, f"{interim}/item_properties")
    categories = tables.read_table(spark, f"{interim}/category_tree")
    tables.write_table(forecast_features(events, properties, params), f"{out}/forecast_features")
    # One item dimension serves the sequences and everybody who reads them.
    tables.write_table(item_index(events.where(F.col("visitorid").isNotNull())), f"{out}/item_dim")
    items = tables.read_table(spark, f"{out}/item_dim")
    sequences = reco_sequences(events, properties, categories, params, items)
    tables.write_table(sequences, f"{out}/reco_sequences")


def train_forecast(
    spark: SparkSession, processed: str, model_path: str, candidate=None, params: Params = DEFAULTS
) -> DataFrame:
    """Fit on all but the last days, save the model, report on the last days."""
    f = forecasting.nonzero_target(tables.read_table(spark, f"{processed}/forecast_features"))
    train, valid = forecasting.temporal_split(f, params.validation_days)
    model = forecasting.train_forecast(train, valid, candidate or forecasting.Candidate())
    tables.save_model(model, model_path)
    pred = forecasting.predict(model, valid)
    report = pred.agg(
        F.avg(F.abs(F.col(forecasting.TARGET) - F.col("forecast"))).alias("mae"),
        evaluation.wmape_of(forecasting.TARGET, "forecast").alias("wmape"),
    )
    return forecasting.quality_gate(tables.metrics_table(report), {"wmape": params.max_wmape}, {})


def train_boosted(
    spark: SparkSession, processed: str, model_path: str, settings: boosting.Boosting = boosting.Boosting(), params: Params = DEFAULTS
) -> DataFrame:
    """Fit boosted trees on all but the last days, save them and their losses by round, report on the last days."""
    f = forecasting.nonzero_target(tables.read_table(spark, f"{processed}/forecast_features"))
    train, valid = forecasting.temporal_split(f, params.validation_days)
    model = boosting.train_boosted(train, valid, settings)
    model.save(model_path)
    tables.write_table(boosting.curve_table(spark, model), f"{model_path}-curve")
    report = boosting.BoostedModel.load(spark, model_path).predict(valid).agg(
        F.avg(F.abs(F.col(forecasting.TARGET) - F.col("forecast"))).alias("mae"),
        evaluation.wmape_of(forecasting.TARGET, "forecast").alias("wmape"),
    )
    return forecasting.quality_gate(tables.metrics_table(report), {"wmape": params.max_wmape}, {})


def tune_forecast(spark: SparkSession, processed: str, model_path: str, candidates: list[boosting.Boosting], floor: float = DEFAULTS.weight_floor_tuned) -> DataFrame:
    """Search by successive halving, fit the winner on all rows and save it; the scores of all rungs."""
    f = forecasting.nonzero_target(tables.read_table(spark, f"{processed}/forecast_features"))
    scores, best = search.search_forecast(f, candidates, floor=floor)
    search.refit_forecast(f, candidates[best], floor).save(model_path)
    tables.write_table(search.rung_table(spark, scores), f"{model_path}-rungs")
    return tables.read_table(spark, f"{model_path}-rungs")


def tune_recommender(spark: SparkSession, processed: str, model_path: str, candidates: list[recommending.RecoCandidate]) -> DataFrame:
    """Search by successive halving, write the winner's transitions over all visitors; the scores of all rungs."""
    sequences = tables.read_table(spark, f"{processed}/reco_sequences")
    scores, best = search.search_reco(sequences, candidates)
    c = candidates[best]
    tables.write_table(recommending.transitions(sequences, c.window, c.decay, c.history), model_path)
    tables.write_table(search.rung_table(spark, scores), f"{model_path}-rungs")
    return tables.read_table(spark, f"{model_path}-rungs")


def mart(spark: SparkSession, interim: str, processed: str, out: str, model_path: str | None = None) -> DataFrame:
    """Write the sales mart with forecasts of the saved model, or of the moving average; returns its diagnostics."""
    events = tables.read_table(spark, f"{interim}/events_clean")
    properties = tables.read_table(spark, f"{interim}/item_properties")
    f = tables.read_table(spark, f"{processed}/forecast_features")
    if model_path:
        predictions = forecasting.predict(tables.load_model(spark, [model_path]), f)
    else:
        predictions = forecasting.moving_average(f)
    built = build_mart(daily_item_counts(events), item_attribute(properties, "categoryid"), predictions)
    tables.write_table(built, f"{out}/mart")
    return tables.metrics_table(evaluation.forecast_metrics(tables.read_table(spark, f"{out}/mart")))


def train_recommender(
    spark: SparkSession, processed: str, model_path: str, params: Params = DEFAULTS
) -> DataFrame:
    """Write the complete transitions; report hit rate and NDCG on held-out visitors."""
    sequences = tables.read_table(spark, f"{processed}/reco_sequences")
    train, test = recommending.visitor_split(sequences)
    tables.write_table(recommending.transitions(train), model_path)
    model = tables.read_table(spark, model_path)
    popular = recommending.popular_items(train, 2 * params.top_k)
    scored = recommending.topk_next(model, recommending.leave_last_out(test), popular, params.top_k)
    report = tables.metrics_table(recommending.hit_ndcg(scored, params.top_k))
    return forecasting.quality_gate(
        report, {}, {"hit_rate": params.min_hit_rate, "ndcg": params.min_ndcg}
    )
