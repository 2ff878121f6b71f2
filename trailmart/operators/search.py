"""Successive halving: many candidates on little data, few on all of it.

Each rung scores the candidates that are left on a larger share of the data and promotes the best part of them. The
candidates of a rung are scored at the same time, each as Spark jobs of its own; the driver keeps one row per score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import BoostedModel, Boosting, train_boosted
from .evaluation import wmape_of
from .forecasting import TARGET, temporal_split
from .recommending import RecoCandidate, evaluate_reco, hash_share, visitor_split

#: Shares of the data in percent, part of the candidates that goes on, and scorings at the same time.
RUNGS = (25, 50, 100)
KEEP = 0.5
AT_ONCE = 4


@dataclass(frozen=True)
class Score:
    rung: int
    share: int
    candidate: int
    score: float | None
    promoted: bool


def successive_halving(
    spark: SparkSession, count: int, evaluate: Callable[[int, int], float | None],
    rungs: Sequence[int] = RUNGS, keep: float = KEEP, at_once: int = AT_ONCE,
) -> tuple[list[Score], int]:
    """All scores, and the best candidate of the last rung. Larger is better; no score is worst; ties go to the first.

    ``evaluate(candidate, share)`` scores one candidate on ``share`` percent of the data.
    """
    if not count:
        raise ValueError("no candidates")
    left, table = list(range(count)), []
    for number, share in enumerate(rungs):
        with ThreadPoolExecutor(max_workers=min(at_once, len(left))) as pool:
            # The threads keep the session's job group and properties.
            scores = list(pool.map(inheritable_thread_target(spark)(lambda c: evaluate(c, share)), left))  # noqa: B023
        # Nine digits: the same order whatever the order of sums.
        ranked = sorted(zip(left, scores), key=lambda cs: (-math.inf if cs[1] is None or cs[1] != cs[1] else round(cs[1], 9), -cs[0]), reverse=True)
        go_on = 1 if number == len(rungs) - 1 else max(1, math.ceil(len(left) * keep))
        winners = {c for c, _ in ranked[:go_on]}
        table += [Score(number, share, c, s, c in winners) for c, s in zip(left, scores)]
        left = sorted(winners)
    return table, left[0]


def in_rung(col: str, share: int) -> Column:
    """A growing part of the ids: those of a rung are in all later ones. Apart from ``visitor_split``'s parts."""
    return hash_share(F.concat(F.lit("rung"), F.col(col).cast("string"))) < share


def search_reco(seq: DataFrame, candidates: list[RecoCandidate], rungs: Sequence[int] = RUNGS, keep: float = KEEP) -> tuple[list[Score], int]:
    """NDCG of recommender settings on the visitors of each rung; ``seq`` is read many times: give a written table."""

    def evaluate(number: int, share: int) -> float | None:
        c = candidates[number]
        train, test = visitor_split(seq.where(in_rung("visitorid", share)), c.train_share)
        return evaluate_reco(train, test, c).ndcg

    return successive_halving(seq.sparkSession, len(candidates), evaluate, rungs, keep)


def search_forecast(
    f: DataFrame, candidates: list[Boosting], rungs: Sequence[int] = RUNGS, keep: float = KEEP, floor: float = 0.5
) -> tuple[list[Score], int]:
    """Negative held-out wMAPE of boosted settings on the items of each rung; ``f`` is a written feature table."""

    def evaluate(number: int, share: int) -> float | None:
        train, valid = temporal_split(f.where(in_rung("itemid", share)))
        if train.isEmpty() or valid.isEmpty():
            return None
        model = train_boosted(train, valid, candidates[number], floor)
        found = model.predict(valid).agg(wmape_of(TARGET, "forecast")).first()[0]
        return None if found is None else -found

    return successive_halving(f.sparkSession, len(candidates), evaluate, rungs, keep)


def refit_forecast(f: DataFrame, best: Boosting, floor: float = 0.5) -> BoostedModel:
    """The winner fitted on all rows, stopped by its training loss."""
    return train_boosted(f, None, best, floor)


def rung_table(spark: SparkSession, scores: list[Score]) -> DataFrame:
    rows = [tuple(asdict(s).values()) for s in scores]
    return spark.createDataFrame(rows, "rung long, share long, candidate long, score double, promoted boolean")

