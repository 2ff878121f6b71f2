"""Boosted trees with a Poisson or Tweedie loss, over MLlib's own regression tree.

MLlib's boosting has squared loss only. Here each round fits one MLlib tree to the Newton step of the loss
(``gradient / curvature``, weighted with the curvature), then sets every leaf to the value that is best for the loss
itself: for these losses a logarithm of two sums over the leaf's rows, one small aggregation. The score is the log of
the forecast. Training stops when the validation loss has not improved for ``patience`` rounds, and the model keeps the
rounds up to the best one.

The rows are written once, with their features as one vector; the score is a column over the written rows, written
again every few rounds so that no plan is long. What the driver sees of a round is one row per leaf and the two losses.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Params
from ..session import scratch_path
from ..sources import tables
from .forecasting import TARGET, assemble, feature_names, sample_weight

DEFAULTS = Params()
#: A leaf without any sales would want minus infinity.
LOWEST = -10.0
#: Rounds between two written copies of the scores.
WRITE_EVERY = 5
SCORE = "_score"


@dataclass(frozen=True)
class Boosting:
    """Settings. ``power`` is the variance power: 1 is Poisson, between 1 and 2 Tweedie."""

    power: float = 1.0
    rounds: int = 40
    depth: int = 4
    step: float = 0.2
    patience: int = 5
    least_rows: int = 5


def loss(y: Column, score: Column, power: float) -> Column:
    """Negative log likelihood up to a constant; smallest where exp(score) is the mean."""
    if power == 1.0:
        return F.exp(score) - y * score
    return F.exp((2 - power) * score) / (2 - power) - y * F.exp((1 - power) * score) / (1 - power)


def pull(y: Column, score: Column, power: float) -> tuple[Column, Column]:
    """The two parts of the gradient: what pulls the score up and what pulls it down."""
    return y * F.exp((1 - power) * score), F.exp((2 - power) * score)


@dataclass
class BoostedModel:
    names: list[str]
    settings: Boosting
    start: float
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    leaves: list[list[float]] = field(default_factory=list)
    #: (round, train loss, validation loss); round 0 is the constant model.
    curve: list[tuple[int, float, float | None]] = field(default_factory=list)

    def scores(self, ready: DataFrame) -> DataFrame:
        """``ready`` (with features) and the log of the forecast."""
        out = ready.withColumn("_score", F.lit(self.start))
        for tree, values in zip(self.trees, self.leaves):
            out = _add(out, tree, values, self.settings.step)
        return out

    def predict(self, f: DataFrame) -> DataFrame:
        rows = self.scores(_ready(f, self.names))
        return rows.select("itemid", "date", TARGET, F.exp(F.least("_score", F.lit(50.0))).alias("forecast"))

    def save(self, path: str) -> str:
        for i, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/tree-{i:04d}")
        spark = SparkSession.active()
        about = {"names": self.names, "settings": vars(self.settings), "start": self.start, "leaves": self.leaves, "curve": self.curve}
        spark.createDataFrame([(json.dumps(about),)], "about string").write.mode("overwrite").parquet(f"{path}/about")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        about = json.loads(spark.read.parquet(f"{path}/about").first().about)
        trees = [DecisionTreeRegressionModel.load(f"{path}/tree-{i:04d}") for i in range(len(about["leaves"]))]
        curve = [tuple(c) for c in about["curve"]]
        return BoostedModel(about["names"], Boosting(**about["settings"]), about["start"], trees, about["leaves"], curve)


def _ready(f: DataFrame, names: list[str]) -> DataFrame:
    for stage in assemble(names):
        f = stage.transform(f)
    return f


def _add(rows: DataFrame, tree: DecisionTreeRegressionModel, values: list[float], step: float) -> DataFrame:
    """One more tree's step on the score."""
    value = F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_leaf").cast("int") + 1)
    out = tree.setLeafCol("_leaf").setPredictionCol("_tree").transform(rows)
    return out.withColumn("_score", F.col(SCORE) + F.lit(step) * value).drop("_leaf", "_tree")


def train_boosted(
    train: DataFrame, valid: DataFrame | None = None, settings: Boosting = Boosting(), floor: float = DEFAULTS.weight_floor_baseline
) -> BoostedModel:
    """Weighted fit on ``train``; ``valid`` only stops it."""
    p = settings.power
    names = feature_names(train)
    rows = train.withColumn("is_valid", F.lit(False))
    if valid is not None:
        rows = rows.unionByName(valid.withColumn("is_valid", F.lit(True)), allowMissingColumns=True)
    rows = _ready(sample_weight(rows, floor), names)
    kept = rows.select("features", F.col(TARGET).cast("double").alias("y"), F.col("sample_weight").alias("w"), "is_valid")
    base = _stored(kept, "boosting")
    total = base.where("not is_valid").agg(F.sum(F.col("w") * F.col("y")).alias("y"), F.sum("w").alias("w")).first()
    if not total.y:
        raise ValueError("no training row with a positive target")
    model = BoostedModel(names, settings, math.log(total.y / total.w))
    at = base.withColumn("_score", F.lit(model.start))
    best = (0, math.inf)
    for number in range(settings.rounds + 1):
        up, down = pull(F.col("y"), F.col(SCORE), p)
        tree = _fit_tree(at, up, down, settings, number) if number < settings.rounds else None
        sides, losses = _look(at, tree, up, down, p)
        model.curve.append((number, losses[False], losses.get(True)))
        watched = losses[True] if valid is not None and True in losses else losses[False]
        if watched < best[1]:
            best = (number, watched)
        if tree is None or number - best[0] >= settings.patience:
            break
        values = [max(LOWEST, math.log(a / b)) if a > 0 else LOWEST for a, b in (sides.get(i, (1.0, 1.0)) for i in range(_leaves(tree)))]
        model.trees.append(tree)
        model.leaves.append(values)
        at = _add(at, tree, values, settings.step)
        if (number + 1) % WRITE_EVERY == 0:
            at = _stored(at, "boosting-scores")
    model.trees, model.leaves = model.trees[: best[0]], model.leaves[: best[0]]
    return model


def _stored(df: DataFrame, name: str) -> DataFrame:
    return tables.read_table(df.sparkSession, tables.write_table(df, scratch_path(df.sparkSession, name)))


def _leaves(tree: DecisionTreeRegressionModel) -> int:
    return (tree.numNodes + 1) // 2


def _fit_tree(at: DataFrame, up: Column, down: Column, s: Boosting, number: int) -> DecisionTreeRegressionModel:
    curvature = (s.power - 1) * up + (2 - s.power) * down
    rows = at.where("not is_valid").select(
        "features", ((up - down) / curvature).alias("_label"), (F.col("w") * curvature).alias("_weight")
    )
    learner = DecisionTreeRegressor(
        labelCol="_label", weightCol="_weight", maxDepth=s.depth, minInstancesPerNode=s.least_rows, seed=42 + number, predictionCol="_tree"
    )
    return learner.fit(rows)


def _look(at: DataFrame, tree: DecisionTreeRegressionModel | None, up: Column, down: Column, p: float):
    """In one pass: each leaf's two sums over the training rows, and the mean loss of both sides at the score as it is."""
    seen = at.withColumn("_leaf", F.lit(0.0)) if tree is None else tree.setLeafCol("_leaf").setPredictionCol("_tree").transform(at)
    sums = seen.groupBy("is_valid", F.col("_leaf").cast("int").alias("leaf")).agg(
        F.sum(F.col("w") * up).alias("up"),
        F.sum(F.col("w") * down).alias("down"),
        F.sum(F.col("w") * loss(F.col("y"), F.col(SCORE), p)).alias("loss"),
        F.sum("w").alias("w"),
    )
    found = sums.collect()  # two rows per leaf at most
    sides = {r.leaf: (r.up, r.down) for r in found if not r.is_valid}
    losses = {}
    for side in {r.is_valid for r in found}:
        rows = [r for r in found if r.is_valid == side]
        losses[side] = math.fsum(r.loss for r in rows) / math.fsum(r.w for r in rows)
    return sides, losses


def curve_table(spark: SparkSession, model: BoostedModel) -> DataFrame:
    """(round, train_loss, valid_loss, kept): the loss after each round; ``kept`` rounds are in the model."""
    rows = [(n, float(a), None if b is None else float(b), n <= len(model.trees)) for n, a, b in model.curve]
    return spark.createDataFrame(rows, "round long, train_loss double, valid_loss double, kept boolean")
