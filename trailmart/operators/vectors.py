"""Learned item vectors, and recommendations by a search among them.

Implicit-feedback factors (MLlib's ALS) of the table "this item, followed within a few steps by that item": every item
gets a vector as what comes before and one as what comes after. A visitor is the sum of the before-vectors of their
history, later items counting more; the items whose after-vectors have the largest inner product are recommended.

The search is a join by locality-sensitive hashes, not of all pairs. With one more coordinate that brings all items to
one length, the largest inner product is the smallest distance, which random projections in buckets find. A visitor
whose buckets give fewer than ``k`` items gets popular ones on the free places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import Params
from ..session import scratch_path
from ..sources import tables
from .recommending import transitions

DEFAULTS = Params()


@dataclass(frozen=True)
class VectorModel:
    """Settings of the factors and of the search."""

    rank: int = 16
    window: int = 3
    decay: float = 0.7
    rounds: int = 8
    alpha: float = 4.0
    regularisation: float = 0.1
    recency: float = 0.8
    bucket: float = 0.5
    hash_tables: int = 8
    seed: int = 42


def item_vectors(seq: DataFrame, m: VectorModel = VectorModel()) -> tuple[DataFrame, DataFrame]:
    """(item, vector) as what comes before, and (next, vector) as what comes after."""
    pairs = transitions(seq, m.window, m.decay).select(F.col("item").cast("int"), F.col("next").cast("int"), F.col("score").cast("float"))
    als = ALS(
        rank=m.rank, maxIter=m.rounds, regParam=m.regularisation, alpha=m.alpha, implicitPrefs=True, seed=m.seed,
        userCol="item", itemCol="next", ratingCol="score", checkpointInterval=-1,
    )
    model = als.fit(pairs)
    before = model.userFactors.select(F.col("id").cast("bigint").alias("item"), F.col("features").alias("vector"))
    after = model.itemFactors.select(F.col("id").cast("bigint").alias("next"), F.col("features").alias("vector"))
    return before, after


def visitor_vectors(hist: DataFrame, before: DataFrame, m: VectorModel = VectorModel()) -> DataFrame:
    """(visitorid, vector): weighted sums, one column per dimension so that each task adds up its part first."""
    steps = hist.select("visitorid", F.posexplode(F.reverse("history")).alias("_back", "item"))
    weight = F.pow(F.lit(m.recency), F.col("_back"))
    sums = [F.sum(weight * F.col("vector")[i]).alias(f"_{i}") for i in range(m.rank)]
    return steps.join(before, "item").groupBy("visitorid").agg(*sums).select("visitorid", F.array(*[f"_{i}" for i in range(m.rank)]).alias("vector"))


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def _scaled(v: str, by: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double") / F.when(by > 0, by).otherwise(1.0))


def one_length(after: DataFrame) -> DataFrame:
    """``after`` with ``point``: all vectors on one sphere by one more coordinate."""
    most = after.agg(F.max(_norm("vector"))).first()[0] or 1.0
    scaled = after.withColumn("_v", _scaled("vector", F.lit(most)))
    rest = F.sqrt(F.greatest(F.lit(0.0), 1 - F.pow(_norm("_v"), 2)))
    return scaled.select("next", array_to_vector(F.concat("_v", F.array(rest))).alias("point"))


def nearest(visitors: DataFrame, after: DataFrame, k: int, m: VectorModel = VectorModel()) -> DataFrame:
    """(visitorid, next, distance): up to ``k`` items each by the hash join, the nearest first."""
    length = _norm("vector")
    asked = visitors.where(length > 0).select(
        "visitorid", array_to_vector(F.concat(_scaled("vector", length), F.array(F.lit(0.0)))).alias("point")
    )
    lsh = BucketedRandomProjectionLSH(inputCol="point", outputCol="hashes", bucketLength=m.bucket, numHashTables=m.hash_tables, seed=m.seed)
    points = one_length(after)
    model = lsh.fit(points)
    # A distance of the root of 2 is an inner product of 0: what lies beyond speaks against an item.
    pairs = model.approxSimilarityJoin(asked, points, 2**0.5, "distance")
    pairs = pairs.select(F.col("datasetA.visitorid").alias("visitorid"), F.col("datasetB.next").alias("next"), "distance")
    best = Window.partitionBy("visitorid").orderBy("distance", "next")
    return pairs.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).drop("_rank")


def recommend(hist: DataFrame, found: DataFrame, popular: DataFrame, k: int = DEFAULTS.top_k) -> DataFrame:
    """``hist`` with ``top``: the items found, then popular ones up to ``k``. ``popular`` has (next, place), 2k rows."""
    pool = [F.struct(F.lit(r.next).alias("next"), F.lit(10.0 + r.place).alias("distance")) for r in popular.orderBy("place").limit(2 * k).collect()]
    both = found
    if pool:
        free = hist.select("visitorid").distinct().select("visitorid", F.explode(F.array(*pool)).alias("_p"))
        both = found.unionByName(free.select("visitorid", F.col("_p.next").cast(found.schema["next"].dataType).alias("next"), "_p.distance"))
    both = both.groupBy("visitorid", "next").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("visitorid").orderBy("distance", "next")
    ranked = both.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    top = ranked.groupBy("visitorid").agg(F.sort_array(F.collect_list(F.struct("_rank", "next"))).alias("_top"))
    return hist.join(top, "visitorid", "left").select(*hist.columns, F.col("_top.next").alias("top"))


def recall(found: DataFrame, visitors: DataFrame, after: DataFrame, k: int, asked: int = 200) -> DataFrame:
    """Share of the true ``k`` best items found, over a bounded number of visitors against all items."""
    some = tables.read_table(visitors.sparkSession, tables.write_table(visitors.orderBy("visitorid").limit(asked), scratch_path(visitors.sparkSession, "asked")))
    inner = F.aggregate(F.zip_with("vector", "_v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    # A stated number of queries against all items.
    pairs = after.select("next", F.col("vector").alias("_v")).join(F.broadcast(some)).withColumn("_s", inner).where("_s > 0")
    best = Window.partitionBy("visitorid").orderBy(F.desc("_s"), "next")
    true = pairs.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).select("visitorid", "next")
    hits = true.join(found.select("visitorid", "next", F.lit(1).alias("_hit")), ["visitorid", "next"], "left")
    return hits.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"), F.count("*").alias("pairs"))
