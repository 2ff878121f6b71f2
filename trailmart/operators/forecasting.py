"""Preparing, training, tuning and scoring the demand forecast with MLlib."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import with_position
from ..params import Params
from .evaluation import wmape_of

DEFAULTS = Params()
TARGET = "target_next7"
NOT_FEATURES = ("itemid", "date", TARGET, "sample_weight", "log_target", "is_valid", "block", "copies")


@dataclass(frozen=True)
class Candidate:
    """One model setting. ``kind``: poisson, tweedie or trees."""

    kind: str = "poisson"
    variance_power: float = 1.3
    regularisation: float = 0.1
    rounds: int = 40
    depth: int = 4
    step: float = 0.1

    @property
    def log_scale(self) -> bool:
        return self.kind != "poisson"


# preparation ----------------------------------------------------------------


def nonzero_target(f: DataFrame) -> DataFrame:
    return f.where(F.col(TARGET) > 0)


def with_split(f: DataFrame, days: int = DEFAULTS.validation_days) -> DataFrame:
    """``is_valid``: rows of the last ``days`` days up to the latest date, that date included."""
    latest = f.select(F.max("date")).scalar()
    return f.withColumn("is_valid", F.col("date") >= F.date_sub(latest, days))


def temporal_split(f: DataFrame, days: int = DEFAULTS.validation_days) -> tuple[DataFrame, DataFrame]:
    tagged = with_split(f, days)
    return tagged.where(~F.col("is_valid")), tagged.where("is_valid")


def sample_weight(f: DataFrame, floor: float = DEFAULTS.weight_floor_baseline) -> DataFrame:
    return f.withColumn("sample_weight", F.greatest("sales_sum_7d", F.lit(floor)))


def log_target(f: DataFrame) -> DataFrame:
    return f.withColumn("log_target", F.log1p(TARGET))


def expanding_folds(f: DataFrame, n: int = DEFAULTS.folds, by: str = "date") -> DataFrame:
    """``block`` 0 to ``n``: fold k is validated on block k and trained on the blocks before it.

    ``by="date"`` cuts the list of dates, ``by="row"`` the rows in (item, date) order.
    """
    if by == "row":
        placed = with_position(f, ["itemid", "date"], "_at")
        total = placed.select(F.count(F.lit(1))).scalar()
        return placed.withColumn("block", _block(F.col("_at") - 1, total, n)).drop("_at")
    # One row per calendar day: a small window and a bounded broadcast.
    dates = f.select("date").distinct()
    order, everything = Window.orderBy("date"), Window.partitionBy()
    blocks = dates.select(
        "date",
        _block(F.row_number().over(order) - 1, F.count(F.lit(1)).over(everything), n).alias("block"),
    )
    return f.join(F.broadcast(blocks), "date")


def _block(at, total, n: int):
    size = F.floor(total / F.lit(n + 1))
    start = total - F.lit(n) * size
    return F.when(at < start, F.lit(0)).otherwise(F.floor((at - start) / F.nullif(size, F.lit(0))) + 1).cast("bigint")


def fold_summary(folded: DataFrame, n: int = DEFAULTS.folds) -> DataFrame:
    """Rows and date range of both sides of each fold."""
    per_block = folded.groupBy("block").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    valid = F.col("block") == F.col("fold")
    train = F.col("block") < F.col("fold")
    return (
        per_block.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .groupBy(F.col("fold").cast("bigint").alias("fold"))
        .agg(
            F.sum(F.when(train, F.col("rows"))).alias("train_rows"),
            F.max(F.when(train, F.col("last"))).alias("train_until"),
            F.sum(F.when(valid, F.col("rows"))).alias("valid_rows"),
            F.min(F.when(valid, F.col("first"))).alias("valid_from"),
            F.max(F.when(valid, F.col("last"))).alias("valid_until"),
        )
    )


def oversample_low(
    f: DataFrame, threshold: float = 5, copies: int = 2, as_weight: bool = False
) -> DataFrame:
    """Rows with a small target appear ``copies`` more times, as rows or as a weight."""
    times = F.when(F.col(TARGET) <= threshold, copies + 1).otherwise(1)
    if as_weight:
        return f.withColumn("copies", times)
    return f.withColumn("copies", F.explode(F.array_repeat(F.lit(1), times))).drop("copies")


# training -------------------------------------------------------------------


def feature_names(f: DataFrame) -> list[str]:
    return [c for c in f.columns if c not in NOT_FEATURES]


def assemble(names: list[str]) -> list:
    """Stages from nullable columns to one vector; a null is 0 plus its own flag.

    No scaler: the linear learner standardises by itself and trees do not need it.
    """
    fills = ", ".join(f"coalesce(cast({c} as double), 0d) as x_{c}" for c in names)
    flags = ", ".join(f"cast({c} is null as double) as null_{c}" for c in names)
    inputs = [f"x_{c}" for c in names] + [f"null_{c}" for c in names]
    return [
        SQLTransformer(statement=f"select *, {fills}, {flags} from __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def _estimator(c: Candidate, early_stop: bool):
    label = "log_target" if c.log_scale else TARGET
    common = {"labelCol": label, "weightCol": "sample_weight", "predictionCol": "raw_prediction"}
    if c.kind == "trees":
        # The learner stops once the validation rows no longer improve.
        stop = {"validationIndicatorCol": "is_valid"} if early_stop else {}
        return GBTRegressor(
            maxIter=c.rounds, maxDepth=c.depth, stepSize=c.step, seed=42, **common, **stop
        )
    if c.kind == "tweedie":
        return GeneralizedLinearRegression(
            family="tweedie", variancePower=c.variance_power, linkPower=0.0,
            regParam=c.regularisation, maxIter=25, **common,
        )
    if c.kind == "poisson":
        return GeneralizedLinearRegression(
            family="poisson", link="log", regParam=c.regularisation, maxIter=25, **common
        )
    raise ValueError(f"unknown model kind {c.kind!r}")


def train_forecast(
    train: DataFrame,
    valid: DataFrame | None = None,
    candidate: Candidate = Candidate(),
    floor: float = DEFAULTS.weight_floor_baseline,
) -> PipelineModel:
    """Weighted fit; ``valid`` rows are only used to stop the tree learner early."""
    names = feature_names(train)
    rows = train.withColumn("is_valid", F.lit(False))
    early_stop = candidate.kind == "trees" and valid is not None
    if early_stop:
        rows = rows.unionByName(valid.withColumn("is_valid", F.lit(True)), allowMissingColumns=True)
    rows = log_target(sample_weight(rows, floor))
    if "copies" in rows.columns:
        rows = rows.withColumn("sample_weight", F.col("sample_weight") * F.coalesce("copies", F.lit(1)))
    inputs = assemble(names)
    ready = rows
    for stage in inputs:
        ready = stage.transform(ready)
    # The learners pass over the rows many times: keep only the assembled ones.
    ready = ready.select("features", TARGET, "log_target", "sample_weight", "is_valid").persist()
    try:
        fitted = _estimator(candidate, early_stop).fit(ready)
    finally:
        ready.unpersist()
    # A log of 50 stands for more than any count; beyond it the power would run over.
    value = "expm1(least(raw_prediction, 50d))" if candidate.log_scale else "raw_prediction"
    finish = SQLTransformer(statement=f"select *, greatest({value}, 0d) as forecast from __THIS__")
    return PipelineModel([*inputs, fitted, finish])


def train_tweedie(
    train: DataFrame, power: float = 1.3, floor: float = DEFAULTS.weight_floor_tuned
) -> PipelineModel:
    return train_forecast(train, None, Candidate("tweedie", variance_power=power), floor)


def predict(model: PipelineModel, f: DataFrame) -> DataFrame:
    return model.transform(f).select("itemid", "date", TARGET, "forecast")


def moving_average(f: DataFrame) -> DataFrame:
    """(itemid, date, forecast): a seventh of the last seven rows' sales; a predictor that needs no model."""
    return f.select("itemid", "date", (F.col("sales_sum_7d") / 7).alias("forecast"))


def attach_forecast(mart: DataFrame, predictions: DataFrame) -> DataFrame:
    """The mart with the forecast made ``horizon`` days before each row's date."""
    made = predictions.select(
        "itemid", F.date_add("date", DEFAULTS.horizon_days).alias("date"), "forecast"
    )
    return mart.drop("forecast").join(made, ["itemid", "date"], "left")


def score(model: PipelineModel, f: DataFrame) -> float | None:
    return predict(model, f).agg(wmape_of(TARGET, "forecast")).first()[0]


def trees_used(model: PipelineModel) -> int:
    """Trees a fitted tree model kept; fewer than its rounds when it stopped early."""
    return next(s for s in model.stages if hasattr(s, "featureImportances")).getNumTrees


def feature_importance(model: PipelineModel, top: int = 20) -> list[tuple[str, float]]:
    """Largest gains of a tree model; one entry per input column, so a short list."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    trees = next(s for s in model.stages if hasattr(s, "featureImportances"))
    gains = zip(names, trees.featureImportances.toArray().tolist())
    return sorted(gains, key=lambda g: (-g[1], g[0]))[:top]


def tune_forecast(
    f: DataFrame, candidates: list[Candidate], n_folds: int = DEFAULTS.folds
) -> tuple[list[dict], Candidate]:
    """wMAPE of every candidate on every expanding fold, and the best candidate by mean."""
    folded = expanding_folds(f, n_folds).persist()
    results = []
    for number, candidate in enumerate(candidates):
        for fold in range(1, n_folds + 1):
            train = oversample_low(folded.where(F.col("block") < fold), as_weight=True)
            valid = folded.where(F.col("block") == fold)
            model = train_forecast(train, valid, candidate, DEFAULTS.weight_floor_tuned)
            results.append(_scored_row(number, candidate, "holdout", fold, score(model, valid)))
    folded.unpersist()

    def mean(number: int) -> float:
        scores = [r["wmape"] for r in results if r["candidate"] == number and r["wmape"] is not None]
        return sum(scores) / len(scores) if scores else float("inf")

    best = min(range(len(candidates)), key=mean)
    return results, candidates[best]


def refit(f: DataFrame, best: Candidate) -> tuple[PipelineModel, dict]:
    """The best candidate fitted on all rows, with its in-sample score, labelled as such."""
    model = train_forecast(f, None, best, DEFAULTS.weight_floor_tuned)
    return model, _scored_row(None, best, "in_sample", None, score(model, f))


def _scored_row(number, candidate: Candidate, scored_on: str, fold, wmape) -> dict:
    return {
        "candidate": number, "scored_on": scored_on, "fold": fold, "wmape": wmape, **asdict(candidate)
    }


def quality_gate(metrics: DataFrame, at_most: dict[str, float], at_least: dict[str, float]) -> DataFrame:
    """(metric, value) rows with their limit and whether they pass; others have none."""
    limit, passed = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    for name, bound in at_most.items():
        hit = F.col("metric") == name
        limit = F.when(hit, F.lit(float(bound))).otherwise(limit)
        passed = F.when(hit, F.col("value") <= bound).otherwise(passed)
    for name, bound in at_least.items():
        hit = F.col("metric") == name
        limit = F.when(hit, F.lit(float(bound))).otherwise(limit)
        passed = F.when(hit, F.col("value") >= bound).otherwise(passed)
    return metrics.select("*", limit.alias("limit"), passed.alias("passed"))
