"""Every registered query, over the driver's tables shaped by the adapter."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms, first_number
from ..operators import cleaning as C
from ..operators import boosting as X
from ..operators import daily
from ..operators import evaluation as V
from ..operators import exploration as E
from ..operators import forecasting as M
from ..operators import history as H
from ..operators import item_day as D
from ..operators import mart as B
from ..operators import recommending as R
from ..operators import search as S
from ..operators import sequences as Q
from ..operators import sketches as K
from ..operators import vectors as W
from ..operators.heavy import heavy_hitters
from ..params import Params
from ..session import scratch_path, use_utc
from ..sources import layout, tables
from ..sources.adapter import StarTables
from ..streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, digits: int = 6, **column_digits: int):
    """Register a builder that takes the adapted tables.

    Doubles are rounded to ``digits``, columns named in ``column_digits`` to theirs.
    """

    def register(build: Callable[[StarTables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(StarTables(use_utc(spark), folder)), digits, column_digits)

        QUERIES[name] = run
        return build

    return register


def comparable(df: DataFrame, digits: int, column_digits: dict[str, int]) -> DataFrame:
    """Plain column types for the comparison: whole numbers, rounded doubles, text."""
    return df.select(
        *[_plain(f, column_digits.get(f.name, digits)).alias(f.name) for f in df.schema.fields]
    )


def _plain(field, digits: int):
    col, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
    if kind in ("tinyint", "smallint", "int"):
        return col.cast("bigint")
    if kind in ("double", "float") or kind.startswith("decimal"):
        return F.round(col.cast("double"), digits) + F.lit(0.0)
    if kind == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if kind == "timestamp":
        return F.unix_micros(col)
    if kind == "array<double>":
        return F.array_join(F.transform(col, lambda x: x.cast("bigint").cast("string")), ",")
    if kind.startswith("array<"):
        return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
    return col


def _rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A handful of report rows as a table."""
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], names)


# sources --------------------------------------------------------------------


def _csv(t: StarTables, df: DataFrame, name: str) -> str:
    path = scratch_path(t.spark, name)
    df.write.csv(path, header=True)
    return path


@query("scan_events")
def _(t):
    return tables.read_events(t.spark, _csv(t, t.raw_events(), "events"))


@query("scan_properties")
def _(t):
    raw = t.raw_properties()
    even = F.col("itemid") % 2 == 0
    parts = [_csv(t, raw.where(even), "part1"), _csv(t, raw.where(~even), "part2")]
    return tables.read_properties(t.spark, parts)


@query("scan_categories")
def _(t):
    return tables.read_categories(t.spark, _csv(t, t.raw_categories(), "categories"))


@query("parquet_roundtrip")
def _(t):
    path = scratch_path(t.spark, "events_clean")
    dated = t.events().withColumn("date", F.to_date("timestamp"))
    tables.write_table(C.layout_by_time(dated), path, partition_by="date")
    return tables.read_table(t.spark, path).select("visitorid", "itemid", "event", "timestamp", "date")


@query("item_dim")
def _(t):
    path = tables.write_table(Q.item_dim(t.events()), scratch_path(t.spark, "item_dim"))
    return tables.read_table(t.spark, path)


@query("metrics_table")
def _(t):
    return tables.metrics_table(V.forecast_metrics(t.mart()))


@query("table_profile")
def _(t):
    return tables.table_profile(
        {"events": t.events(), "item_properties": t.properties(), "category_tree": t.categories()}
    )


# cleaning -------------------------------------------------------------------


@query("parse_epoch_ms")
def _(t):
    return C.parse_epoch_ms(t.raw_events()).select("timestamp", "visitorid", "event", "itemid")


@query("event_whitelist")
def _(t):
    return C.event_whitelist(t.raw_events()).select("timestamp", "visitorid", "event", "itemid")


@query("drop_missing")
def _(t):
    return C.drop_missing(t.raw_events(), ["visitorid"]).select("visitorid", "event", "itemid")


@query("dedupe_rows")
def _(t):
    return C.dedupe_rows(t.raw_events())


@query("layout_by_time")
def _(t):
    return C.layout_by_time(t.events()).select("timestamp", "visitorid", "event")


@query("clean_events")
def _(t):
    return C.clean_events(t.raw_events())


@query("clean_events_stats")
def _(t):
    return C.clean_events_stats(t.raw_events())


@query("first_number")
def _(t):
    return t.raw_properties().select("itemid", "property", "value", first_number("value").alias("number"))


@query("dedupe_keyed")
def _(t):
    rows = t.raw_properties().withColumn("timestamp", epoch_ms("timestamp"))
    return C.dedupe_keyed(rows, ["itemid", "property"], ["timestamp", "value"])


@query("clean_properties")
def _(t):
    return t.properties()


@query("bot_filter")
def _(t):
    return C.bot_filter(t.events(), 3)


@query("min_interactions")
def _(t):
    return C.min_interactions(t.events(), 40)


@query("drop_missing_category")
def _(t):
    return C.drop_missing_category(t.events(), t.properties().where("itemid % 5 > 0"))


@query("stream_clean_events")
def _(t):
    """The raw events as files that arrive one after the other."""
    return _streamed(t, t.raw_events(), stream.clean_stream)[0].select("timestamp", "visitorid", "event", "itemid", "transactionid")


@query("stream_sessions")
def _(t):
    ev = t.events()
    return _streamed(t, ev.unionByName(stream.closing_row(ev)), stream.session_stream)[0]


def _streamed(t: StarTables, rows: DataFrame, build) -> tuple[DataFrame, stream.Report]:
    """``rows`` written in three parts by time, read as a stream one file after the other."""
    folder, out = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "streamed")
    order = F.coalesce(F.col("timestamp").try_cast("bigint"), F.lit(0))
    first, second = rows.withColumn("_at", order).approxQuantile("_at", [0.33, 0.66], 0.01)
    for low, high in ((None, first), (first, second), (second, None)):
        part = rows.where((order > low if low is not None else F.lit(True)) & (order <= high if high is not None else F.lit(True)))
        part.write.mode("append").parquet(folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    arriving = stream.read_stream(t.spark, folder, schema, files_at_once=4)
    report = stream.run_available(build(arriving), out, scratch_path(t.spark, "stream-checkpoint"))
    return tables.read_table(t.spark, out), report


@query("clean_properties_stats")
def _(t):
    return C.clean_properties_stats(t.raw_properties())


@query("clean_category")
def _(t):
    return t.categories()


@query("clean_category_stats")
def _(t):
    return C.clean_category_stats(t.raw_categories())


# item-day features ----------------------------------------------------------


def _day(t: StarTables) -> DataFrame:
    return D.with_day(D.daily_item_counts(t.events()))


def _keyed(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("itemid", "date", *cols)


@query("daily_item_counts")
def _(t):
    return D.daily_item_counts(t.events())


@query("item_price")
def _(t):
    return D.item_attribute(t.properties(), "price")


@query("item_category")
def _(t):
    return D.item_attribute(t.properties(), "categoryid")


@query("price_ffill")
def _(t):
    return D.priced_items(t.events(), t.properties()).select("itemid", "price")


@query("price_item_scope")
def _(t):
    return D.priced_items(t.events(), t.properties(), "item").select("itemid", "price")


@query("rolling_sums")
def _(t):
    return D.rolling_sums(_day(t)).drop(D.DAY)


@query("sales_lags")
def _(t):
    return D.sales_lags(_day(t)).drop(D.DAY)


@query("ratios")
def _(t):
    return _keyed(D.ratios(D.rolling_sums(_day(t), (7,))), "ctr_7d", "buyrate_7d")


def _with_category(t: StarTables) -> DataFrame:
    items = D.priced_items(t.events(), t.properties())
    return D.rolling_sums(_day(t), (7,)).join(items, "itemid", "left")


@query("smooth_by_category")
def _(t):
    return _keyed(D.smooth_by_category(_with_category(t), "sales_sum_7d", 5.0, "sales_sm_7d"), "sales_sm_7d")


@query("category_sales")
def _(t):
    return _keyed(D.category_sales(_with_category(t)), "cat_sales_7d")


@query("price_change")
def _(t):
    return _keyed(D.price_change(_with_category(t)), "price", "price_pct_chg_7d")


@query("calendar")
def _(t):
    return D.one_hot_dow(D.calendar(D.daily_item_counts(t.events()))).drop("views", "adds", "sales")


@query("target_next7")
def _(t):
    return _keyed(D.target_at(_day(t)), "target_next7")


@query("forecast_features")
def _(t):
    return D.forecast_features(t.events(), t.properties())


@query("price_asof")
def _(t):
    return H.attributes_asof(t.order_days(), t.price_history(), {"price": "price"})


@query("price_change_asof")
def _(t):
    return _keyed(H.price_change_asof(t.order_days(), t.price_history()), "price", "price_pct_chg_7d")


@query("forecast_features_stored")
def _(t):
    """F18 from tables that are stored by item."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {}
    tables_by_name = {"counts": D.daily_item_counts(t.events()), "items": D.priced_items(t.events(), t.properties())}
    for name, df in tables_by_name.items():
        path = scratch_path(t.spark, name)
        order = [c for c in df.columns if c == "date"]
        table = layout.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), "itemid", order, buckets, path)
        stored[name] = layout.read_bucketed(t.spark, table)
    return D.features_from_stored(stored["counts"], stored["items"])


@query("features_new_day")
def _(t):
    """The last day's features from the state of two days before, advanced day by day."""
    ev = t.events()
    last = ev.agg(F.max(F.to_date("timestamp"))).first()[0]
    age = F.datediff(F.lit(last), F.to_date("timestamp"))
    path = scratch_path(t.spark, "state")
    late = (F.col("property") == "price") & (F.col("itemid") % 3 == 0)
    state = daily.initial(ev.where(age > 1), t.properties().where(~late)).save(f"{path}/0")
    _, state, _ = daily.advance(state, ev.where(age == 1), t.properties().where(late))
    rows, _, _ = daily.advance(state.save(f"{path}/1"), ev.where(age == 0), t.properties().limit(0))
    return rows


@query("targets_due")
def _(t):
    """Targets that the last day settles."""
    ev = t.events()
    last = ev.agg(F.max(F.to_date("timestamp"))).first()[0]
    age = F.datediff(F.lit(last), F.to_date("timestamp"))
    state = daily.initial(ev.where(age > 0), t.properties()).save(scratch_path(t.spark, "state"))
    return daily.advance(state, ev.where(age == 0), t.properties())[2]


# sequences ------------------------------------------------------------------


@query("item_index")
def _(t):
    return Q.item_index(t.events())


@query("item_index_extended")
def _(t):
    """The index of the first weeks, with the items that came later."""
    ev = t.events()
    early = ev.where(F.dayofmonth("timestamp") <= 3)
    stored = tables.read_table(t.spark, tables.write_table(Q.item_index(early), scratch_path(t.spark, "item_index")))
    return Q.extend_index(stored, ev)


@query("category_index")
def _(t):
    return Q.category_index(t.categories())


@query("attach_category")
def _(t):
    rows = Q.attach_category(t.events(), t.properties())
    return rows.select("visitorid", "timestamp", "itemid", "categoryid")


@query("attach_category_fanout")
def _(t):
    rows = Q.attach_category(t.events(), t.properties(), fanout=True)
    return rows.select("visitorid", "timestamp", "itemid", "categoryid")


@query("last_n_per_visitor")
def _(t):
    return Q.last_n_per_visitor(t.events()).drop("transactionid")


@query("reco_sequences")
def _(t):
    return t.sequences()


@query("reco_sequences_fanout")
def _(t):
    return Q.reco_sequences(
        t.events(), t.properties(), t.categories(), Params(category_fanout=True)
    )


@query("sequence_stats")
def _(t):
    return Q.sequence_stats(t.sequences())


# exploration ----------------------------------------------------------------


@query("missing_pct")
def _(t):
    raw = {"events": t.raw_events(), "item_properties": t.raw_properties(), "category_tree": t.raw_categories()}
    return E.missing_pct_of(raw)


@query("event_type_counts")
def _(t):
    return E.event_type_counts(t.events())


@query("daily_volume")
def _(t):
    return E.daily_volume(t.events())


@query("daily_volume_dense")
def _(t):
    return E.daily_volume(t.all_events(), dense=True)


@query("hourly_volume")
def _(t):
    return E.hourly_volume(t.events())


@query("hour_weekday_heatmap")
def _(t):
    return E.hour_weekday_heatmap(t.all_events())


@query("sessionize")
def _(t):
    return E.sessionize(t.events()).select("visitorid", "timestamp", "itemid", "event", "session")


@query("session_lengths")
def _(t):
    return E.session_lengths(t.events())


@query("session_lengths_global")
def _(t):
    return E.session_lengths(t.events(), global_key=True)


@query("session_length_hist")
def _(t):
    return E.clipped_hist(E.session_lengths(t.events()), "length")


@query("session_length_hist_global")
def _(t):
    return E.clipped_hist(E.session_lengths(t.events(), global_key=True), "length")


@query("session_funnel")
def _(t):
    return E.session_funnel(t.events())


@query("funnel_rates")
def _(t):
    return E.funnel_rates(E.session_funnel(t.events()))


@query("funnel_rates_global")
def _(t):
    return E.funnel_rates(E.session_funnel(t.events(), global_key=True))


@query("item_popularity")
def _(t):
    return E.item_popularity(t.events())


@query("top_items")
def _(t):
    return E.item_popularity(t.events(), top=15)


@query("top_items_bounded")
def _(t):
    """``top_items`` from bounded counters."""
    return heavy_hitters(t.events(), "itemid", 15, counters=64)


@query("sketch_ranges")
def _(t):
    """Exact figures of ranges of days, and whether the stored sketches meet them within their errors."""
    ev = t.events().where("visitorid is not null")
    dated = ev.withColumn("date", F.to_date("timestamp"))
    path = scratch_path(t.spark, "sketches")
    # The last day comes later, and is read alone.
    last = dated.agg(F.max("date")).first()[0]
    K.write_days(K.daily_sketches(ev.where(F.to_date("timestamp") < F.lit(last))), path)
    K.write_days(K.daily_sketches(ev.where(F.to_date("timestamp") == F.lit(last))), path)
    days = tables.read_table(t.spark, path)
    out = []
    for name, span in (("all", F.lit(True)), ("week", F.col("date") > F.date_sub(F.lit(last), 7)), ("day", F.col("date") == F.lit(last))):
        exact = dated.where(span).agg(
            F.count("*").alias("events"), F.count_distinct("visitorid").alias("visitors"), F.count_distinct("itemid").alias("items")
        )
        found = K.merged(days.where(span)).first()
        sizes = dated.where(span).groupBy("date", "visitorid").agg(F.count("*").alias("n"))
        ranks = sizes.agg(
            F.count("*").alias("visitor_days"),
            *[F.avg((F.col("n") < found[q]).cast("double")).alias(f"below_{q}") for q in ("q50", "q90")],
            *[F.avg((F.col("n") <= found[q]).cast("double")).alias(f"upto_{q}") for q in ("q50", "q90")],
        ).first()
        near = [F.abs(F.lit(found[c]) - F.col(c)) <= F.col(c) * K.DISTINCT_ERROR for c in ("visitors", "items")]
        meets = [ranks[f"below_{q}"] <= p + K.RANK_ERROR and ranks[f"upto_{q}"] >= p - K.RANK_ERROR for q, p in (("q50", 0.5), ("q90", 0.9))]
        row = exact.select(
            F.lit(name).alias("span"),
            "*",
            F.lit(ranks.visitor_days).alias("visitor_days"),
            (F.col("events") == found.events).alias("events_ok"),
            (near[0] & near[1]).alias("distinct_ok"),
            F.lit(all(meets) and found.visitor_days == ranks.visitor_days).alias("quantiles_ok"),
        )
        out.append(row)
    return reduce(DataFrame.unionByName, out)


@query("long_tail")
def _(t):
    return E.long_tail(t.events())


@query("coverage_items")
def _(t):
    return E.coverage_items(t.events())


@query("topk_coverage")
def _(t):
    return E.topk_coverage(t.events())


@query("visitor_lengths")
def _(t):
    return E.visitor_lengths(t.all_events())


@query("visitor_length_hist")
def _(t):
    return E.visitor_length_hist(t.all_events())


@query("visitor_length_bands")
def _(t):
    return E.visitor_length_bands(t.all_events())


@query("visitor_length_stats")
def _(t):
    return E.visitor_length_stats(t.all_events())


@query("inter_event_gaps")
def _(t):
    return E.inter_event_gaps(t.all_events())


@query("gap_hist")
def _(t):
    return E.gap_hist(t.all_events())


@query("gap_stats")
def _(t):
    return E.gap_stats(t.all_events())


@query("eda_summary")
def _(t):
    return E.eda_summary(t.all_events())


# forecast preparation and models --------------------------------------------


def _features(t: StarTables) -> DataFrame:
    return D.forecast_features(t.events(), t.properties())


def _model_rows(t: StarTables) -> DataFrame:
    return M.nonzero_target(_features(t))


@query("nonzero_target")
def _(t):
    return _keyed(_model_rows(t), "target_next7")


@query("temporal_split")
def _(t):
    return _keyed(M.with_split(_model_rows(t)), "is_valid")


@query("sample_weight")
def _(t):
    return _keyed(M.sample_weight(_model_rows(t)), "sample_weight")


@query("log_target")
def _(t):
    return _keyed(M.log_target(_model_rows(t)), "log_target")


@query("expanding_folds")
def _(t):
    return M.fold_summary(M.expanding_folds(_model_rows(t)))


@query("expanding_folds_by_row")
def _(t):
    return _keyed(M.expanding_folds(_model_rows(t), by="row"), "block")


@query("oversample_low")
def _(t):
    train, _ = M.temporal_split(_model_rows(t))
    return _keyed(M.oversample_low(train), "target_next7")


def _written_rows(t: StarTables) -> DataFrame:
    """Training reads the written feature table, as the batch stages do."""
    path = tables.write_table(_features(t), scratch_path(t.spark, "forecast_features"))
    return M.nonzero_target(tables.read_table(t.spark, path))


def _scored(t: StarTables, candidate: M.Candidate) -> DataFrame:
    train, valid = M.temporal_split(_written_rows(t))
    return M.predict(M.train_forecast(train, valid, candidate), valid)


def _report(pred: DataFrame) -> DataFrame:
    report = pred.agg(
        F.avg(F.abs(F.col("target_next7") - F.col("forecast"))).alias("mae"),
        V.wmape_of("target_next7", "forecast").alias("wmape"),
    )
    return M.quality_gate(tables.metrics_table(report), {"wmape": Params().max_wmape}, {})


@query("train_forecast")
def _(t):
    return _report(_scored(t, M.Candidate("poisson")))


@query("train_forecast_trees")
def _(t):
    return _report(_scored(t, M.Candidate("trees")))


@query("train_tweedie")
def _(t):
    return _report(_scored(t, M.Candidate("tweedie")))


@query("predict")
def _(t):
    return _scored(t, M.Candidate("poisson"))


@query("saved_model_predict")
def _(t):
    train, valid = M.temporal_split(_written_rows(t))
    model = M.train_forecast(train, valid, M.Candidate("poisson"))
    path = tables.save_model(model, scratch_path(t.spark, "model"))
    return M.predict(tables.load_model(t.spark, [f"{path}-missing", path]), valid)


@query("feature_importance")
def _(t):
    train, valid = M.temporal_split(_written_rows(t))
    model = M.train_forecast(train, valid, M.Candidate("trees"))
    return t.spark.createDataFrame(M.feature_importance(model), "feature string, gain double")


@query("tune_forecast")
def _(t):
    options = [M.Candidate("tweedie", variance_power=1.1), M.Candidate("tweedie", variance_power=1.5)]
    rows = _written_rows(t)
    results, best = M.tune_forecast(rows, options)
    _, in_sample = M.refit(rows, best)
    return _rows(t.spark, [*results, in_sample])


_BOOSTED = {"poisson": X.Boosting(), "tweedie": X.Boosting(power=1.5)}


@query("train_boosted")
def _(t):
    train, valid = M.temporal_split(_written_rows(t))
    return _report(X.train_boosted(train, valid).predict(valid))


@query("boosting_curve")
def _(t):
    """Loss of both objectives after each round."""
    train, valid = M.temporal_split(_written_rows(t))
    curves = [
        X.curve_table(t.spark, X.train_boosted(train, valid, s)).select(F.lit(name).alias("objective"), "*") for name, s in _BOOSTED.items()
    ]
    return reduce(DataFrame.unionByName, curves)


@query("boosting_start")
def _(t):
    """The loss before the first tree."""
    train, valid = M.temporal_split(_written_rows(t))
    rows = []
    for name, s in _BOOSTED.items():
        model = X.train_boosted(train, valid, replace(s, rounds=0))
        rows.append({"objective": name, "train_loss": model.curve[0][1], "valid_loss": model.curve[0][2], "start": model.start})
    return _rows(t.spark, rows)


@query("boosting_balance")
def _(t):
    """One whole step: every leaf's forecasts add up to its rows' weighted targets."""
    train, _ = M.temporal_split(_written_rows(t))
    model = X.train_boosted(train, None, X.Boosting(rounds=1, step=1.0, depth=3))
    path = model.save(scratch_path(t.spark, "boosted"))
    pred = X.BoostedModel.load(t.spark, path).predict(train).join(
        M.sample_weight(train).select("itemid", "date", "sample_weight"), ["itemid", "date"]
    )
    w = F.col("sample_weight")
    return pred.agg(F.sum(w * F.col("target_next7")).alias("target"), F.sum(w * F.col("forecast")).alias("forecast"), F.count("*").alias("rows"))


@query("boosting_checks")
def _(t):
    """Every round lowers the training loss, training stops in time, and the kept rounds are the best on held-out rows."""
    train, valid = M.temporal_split(_written_rows(t))
    rows = []
    for name, s in _BOOSTED.items():
        model = X.train_boosted(train, valid, s)
        losses, held = [c[1] for c in model.curve], [c[2] for c in model.curve]
        best = min(range(len(held)), key=held.__getitem__)
        rows.append({
            "objective": name,
            "falls": all(a > b for a, b in zip(losses, losses[1:])),
            "kept_best": len(model.trees) == best,
            "stopped": len(held) - 1 in (s.rounds, best + s.patience),
            "not_worse_than_mean": held[best] <= held[0],
        })
    return _rows(t.spark, rows)


@query("tune_forecast_rungs")
def _(t):
    options = [X.Boosting(power=p, depth=d, rounds=10, patience=3) for p in (1.0, 1.5) for d in (2, 4)]
    scores, _ = S.search_forecast(_written_rows(t), options)
    return S.rung_table(t.spark, scores)


@query("written_features")
def _(t):
    path = tables.write_table(_features(t), scratch_path(t.spark, "forecast_features"))
    return tables.read_table(t.spark, path)


@query("written_sequences")
def _(t):
    path = tables.write_table(t.sequences(), scratch_path(t.spark, "reco_sequences"))
    return tables.read_table(t.spark, path)


@query("assemble", digits=3)
def _(t):
    rows = _features(t)
    for stage in M.assemble(M.feature_names(rows)):
        rows = stage.transform(rows)
    entries = vector_to_array("features")
    total = F.aggregate(entries, F.lit(0.0), lambda a, x: a + x)
    return rows.select("itemid", "date", F.size(entries).alias("width"), total.alias("total"))


@query("poisson_balance", digits=3)
def _(t):
    """A fitted Poisson model with a free intercept meets the weighted total of its training rows."""
    train, valid = M.temporal_split(_written_rows(t))
    fitted = M.train_forecast(train, valid, M.Candidate("poisson")).transform(M.sample_weight(train))
    weight = F.col("sample_weight")
    return fitted.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(weight * F.col(M.TARGET)).alias("target_total"),
        (F.sum(weight * F.col("forecast")) / F.sum(weight * F.col(M.TARGET))).alias("met"),
    )


@query("prediction_checks")
def _(t):
    """Predictions of each kind: one per validation row, finite, not negative, the same after saving."""
    train, valid = M.temporal_split(_written_rows(t))
    parts = []
    for kind in ("poisson", "trees", "tweedie"):
        model = M.train_forecast(train, valid, M.Candidate(kind, rounds=10))
        path = tables.save_model(model, scratch_path(t.spark, "model"))
        again = M.predict(tables.load_model(t.spark, [path]), valid)
        both = M.predict(model, valid).join(again.select("itemid", "date", F.col("forecast").alias("again")), ["itemid", "date"])
        value = F.col("forecast")
        parts.append(
            both.agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if((value >= 0) & (value < float("inf"))).alias("good"),
                F.count_if(value == F.col("again")).alias("equal"),
            ).select(F.lit(kind).alias("kind"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


@query("importance_checks")
def _(t):
    """Gains of all inputs add up to one, none is negative, and the names are the table's."""
    train, valid = M.temporal_split(_written_rows(t))
    model = M.train_forecast(train, valid, M.Candidate("trees", rounds=10))
    names = set(M.feature_names(train))
    gains = M.feature_importance(model, top=10_000)
    known = all(name.removeprefix("x_").removeprefix("null_") in names for name, _ in gains)
    row = {"inputs": len(gains), "total": sum(g for _, g in gains), "lowest_ok": min(g for _, g in gains) >= 0, "known": known}
    return _rows(t.spark, [row])


@query("tuning_grid")
def _(t):
    """Every candidate has a finite score on every fold."""
    options = [M.Candidate("tweedie", variance_power=1.1), M.Candidate("tweedie", variance_power=1.5, regularisation=0.3)]
    results, _ = M.tune_forecast(_written_rows(t), options)
    grid = _rows(t.spark, [{k: r[k] for k in ("candidate", "fold", "wmape")} for r in results])
    return grid.select("candidate", "fold", ((F.col("wmape") > 0) & (F.col("wmape") < float("inf"))).alias("finite"))


@query("early_stopping")
def _(t):
    """The tree learner ends before its limit once held-out rows no longer improve; without them it does not."""
    train, valid = M.temporal_split(_written_rows(t))
    limit = 60
    c = M.Candidate("trees", rounds=limit, depth=5, step=0.3)
    stopped = M.trees_used(M.train_forecast(train, valid, c))
    return _rows(t.spark, [{"limit": limit, "stopped_early": stopped < limit}])


def _bi_mart(t: StarTables) -> DataFrame:
    counts = D.daily_item_counts(t.events())
    return B.build_mart(counts, D.item_attribute(t.properties(), "categoryid"), M.moving_average(_features(t)))


@query("bi_mart")
def _(t):
    return _bi_mart(t)


@query("model_diagnostics")
def _(t):
    return V.forecast_metrics(_bi_mart(t))


@query("quality_gate")
def _(t):
    scores = tables.metrics_table(V.wmape(t.mart()))
    return M.quality_gate(scores, {"wmape": Params().max_wmape}, {})


# evaluation -----------------------------------------------------------------


@query("wmape")
def _(t):
    return V.wmape(t.mart())


@query("forecast_metrics")
def _(t):
    return V.forecast_metrics(t.mart())


@query("abs_error_hist", digits=4)
def _(t):
    return V.abs_error_hist(t.mart())


@query("log_error_hist", digits=4)
def _(t):
    return V.log_error_hist(t.mart())


@query("tercile_matrix")
def _(t):
    return V.quantile_matrix(t.mart(), 3)


@query("quartile_matrix")
def _(t):
    return V.quantile_matrix(t.mart(), 4, edges_from="actual", closed="left")


@query("residuals", digits=4)
def _(t):
    return V.residuals(t.mart()).select("itemid", "date", "forecast", "residual")


@query("qq_points", ordered=4, fitted=4)
def _(t):
    return V.qq_points(t.mart())


@query("mape_by_quantile", digits=2)
def _(t):
    return V.mape_by_quantile(t.mart())


@query("mape_by_quintile", digits=4)
def _(t):
    return V.mape_by_quantile(t.mart(), closed="left")


# recommender ----------------------------------------------------------------


@query("visitor_split")
def _(t):
    train, test = R.visitor_split(t.sequences())
    return train.select("visitorid", F.lit("train").alias("part")).unionByName(
        test.select("visitorid", F.lit("test").alias("part"))
    )


@query("leave_last_out")
def _(t):
    return R.leave_last_out(t.sequences())


@query("transitions")
def _(t):
    train, _ = R.visitor_split(t.sequences())
    return R.transitions(train)


@query("next_item_model")
def _(t):
    train, _ = R.visitor_split(t.sequences())
    model = R.next_item_model(train, window=3)
    return model.select("item", F.col("candidates.next").alias("candidates"))


def _scored_sequences(t: StarTables) -> DataFrame:
    train, test = R.visitor_split(t.sequences())
    return R.topk_next(R.transitions(train), R.leave_last_out(test), R.popular_items(train, 2 * Params().top_k))


@query("topk_next")
def _(t):
    return _scored_sequences(t).select("visitorid", "target", "top")


@query("hit_ndcg")
def _(t):
    return R.hit_ndcg(_scored_sequences(t))


@query("popularity_baseline")
def _(t):
    train, test = R.visitor_split(t.sequences())
    return R.hit_ndcg(R.popularity_baseline(train, R.leave_last_out(test)))


@query("item_recommendations", digits=4)
def _(t):
    return R.item_recommendations(t.sequences(), Q.item_index(t.events()))


@query("cooccurrence")
def _(t):
    return R.cooccurrence(t.sequences())


@query("reco_confidence", digits=4)
def _(t):
    seq = t.sequences()
    return R.reco_confidence(R.cooccurrence(seq), seq)


def _tuned(t: StarTables) -> DataFrame:
    options = [
        R.RecoCandidate(),
        R.RecoCandidate(window=3, recency=0.8),
        R.RecoCandidate(window=5, decay=0.8, history=20),
        R.RecoCandidate(window=3, recency=0.9, train_share=0.7),
    ]
    results, _ = R.tune_reco(t.sequences(), options)
    return _rows(t.spark, results)


@query("tune_reco")
def _(t):
    return _tuned(t)


def _vector_answers(t: StarTables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    seq = tables.read_table(t.spark, tables.write_table(t.sequences(), scratch_path(t.spark, "sequences")))
    train, test = R.visitor_split(seq)
    hist = R.leave_last_out(test)
    before, after = W.item_vectors(train)
    visitors = W.visitor_vectors(hist, before)
    found = W.nearest(visitors, after, Params().top_k)
    return W.recommend(hist, found, R.popular_items(train, 2 * Params().top_k)), found, visitors, after


@query("vector_recommendations")
def _(t):
    return R.hit_ndcg(_vector_answers(t)[0])


@query("vector_checks")
def _(t):
    """Every held-out visitor gets ``k`` different items, and the hash join finds nine of ten of the best ones."""
    answers, found, visitors, after = _vector_answers(t)
    k = Params().top_k
    right = (F.size("top") == k) & (F.size(F.array_distinct("top")) == k)
    counts = answers.agg(F.count("*").alias("samples"), F.count_if(right).alias("full"))
    return counts.withColumn("recall_ok", F.lit(W.recall(found, visitors, after, k).first().recall >= 0.9))


#: Windows, decays and histories that the rungs narrow down.
RUNG_OPTIONS = [
    R.RecoCandidate(window=w, decay=d, history=h, recency=r)
    for w, d, h, r in [(1, 0.5, 50, 0.5), (3, 0.5, 50, 0.8), (5, 0.8, 20, 0.5), (2, 0.7, 50, 0.9), (4, 0.6, 30, 0.7), (1, 0.5, 10, 0.3)]
]


@query("tune_reco_rungs")
def _(t):
    scores, _ = S.search_reco(tables.read_table(t.spark, tables.write_table(t.sequences(), scratch_path(t.spark, "sequences"))), RUNG_OPTIONS)
    return S.rung_table(t.spark, scores)


@query("training_curve")
def _(t):
    return R.training_curve(_tuned(t))


# business queries -----------------------------------------------------------


@query("filter_dates", digits=4)
def _(t):
    return B.filter_dates(t.mart(), "1996-01-01", "1996-12-31")


@query("filter_categories", digits=4)
def _(t):
    return B.filter_categories(t.mart(), [1, 2, 3])


@query("kpis", digits=2)
def _(t):
    return B.kpis(t.mart())


@query("daily_revenue", digits=2)
def _(t):
    return B.daily_revenue(t.mart())


@query("category_performance", digits=2)
def _(t):
    return B.performance(t.mart(), "categoryid")


@query("item_performance", digits=2)
def _(t):
    return B.performance(t.mart(), "itemid")


@query("best_worst_day", digits=2)
def _(t):
    return B.best_worst_day(t.mart())


@query("sales_trend", digits=4)
def _(t):
    return B.sales_trend(t.mart())


@query("insights")
def _(t):
    mart = t.mart()
    return B.insights(mart, V.forecast_metrics(mart))


@query("actual_vs_forecast_sample", digits=4)
def _(t):
    return B.actual_vs_forecast_sample(t.mart())


@query("daily_actual_vs_forecast", digits=4)
def _(t):
    return B.daily_actual_vs_forecast(t.mart())


@query("category_daily_actual_vs_forecast", digits=4)
def _(t):
    return B.daily_actual_vs_forecast(t.mart(), by="categoryid")


@query("sequence_kpis")
def _(t):
    return B.sequence_kpis(t.sequences())


@query("sequence_hist")
def _(t):
    return B.sequence_hist(t.sequences())


@query("length_buckets")
def _(t):
    return B.length_buckets(t.sequences())


@query("trending_items")
def _(t):
    return B.trending_items(t.sequences(), items=Q.item_index(t.events()))


@query("session_explorer")
def _(t):
    found = B.session_explorer(t.sequences())
    return found.withColumn("recommended", F.col("recommended.other"))


@query("item_deep_dive", digits=2, avg_sale=8)
def _(t):
    return B.item_deep_dive(t.mart())


@query("item_projection", digits=3)
def _(t):
    return B.item_projection(t.mart())


@query("category_projection", digits=3)
def _(t):
    return B.category_projection(t.mart())


@query("item_projection_noise", digits=3)
def _(t):
    return B.item_projection(t.mart(), noise=0.08, seed=7)


@query("category_projection_noise", digits=3)
def _(t):
    return B.category_projection(t.mart(), noise=0.05, seed=7)


@query("item_growth", digits=3)
def _(t):
    mart = t.mart()
    return B.growth(B.item_projection(mart), mart, "itemid")


@query("category_growth", digits=3)
def _(t):
    mart = t.mart()
    return B.growth(B.category_projection(mart), B.category_daily(mart), "categoryid")


@query("category_deep_dive", digits=2, avg_sale=6, share_pct=6)
def _(t):
    return B.category_deep_dive(t.mart())


@query("top_products_in_category", digits=2)
def _(t):
    return B.top_products_in_category(t.mart())


@query("selector_items")
def _(t):
    return B.selectors(t.mart())["items"]


@query("selector_categories")
def _(t):
    return B.selectors(t.mart())["categories"]


@query("selector_dates")
def _(t):
    return B.selectors(t.mart())["dates"]
