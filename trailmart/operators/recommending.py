"""Next-item recommendation from transitions and weighted co-occurrence.

Sequences are capped (50 events), so what one row expands to is bounded; all
per-row work stays in built-in functions.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from ..params import Params
from ..session import materialise

DEFAULTS = Params()


@dataclass(frozen=True)
class RecoCandidate:
    """``window`` 1 is a first-order transition count; further steps decay.

    ``recency`` weighs the items of the history that is scored; ``history`` is how far back both look.
    """

    window: int = 1
    decay: float = 0.5
    history: int = 50
    train_share: float = 0.8
    recency: float = 0.5


def hash_share(col: str | Column) -> Column:
    """A fixed number from 0 to 99 for each id."""
    text = F.col(col) if isinstance(col, str) else col
    digest = F.substring(F.md5(text.cast("string")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(100))


def visitor_split(seq: DataFrame, keep: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Visitors to train on and visitors held out; the same for every run."""
    inside = hash_share("visitorid") < round(keep * 100)
    return seq.where(inside), seq.where(~inside)


def leave_last_out(seq: DataFrame, max_len: int = DEFAULTS.max_sequence) -> DataFrame:
    """(visitorid, history, target) of sequences with at least two items."""
    n = F.size("item_seq")
    start = F.greatest(n - max_len, F.lit(1))
    length = F.least(n - 1, F.lit(max_len))
    return seq.where(n >= 2).select(
        "visitorid",
        F.slice("item_seq", start, length).alias("history"),
        F.element_at("item_seq", -1).alias("target"),
    )


def transitions(seq: DataFrame, window: int = 1, decay: float = 0.5, history: int = 50) -> DataFrame:
    """(item, next, score, n): how often an item follows another within ``window`` steps."""
    s = F.col("_s")
    last = F.slice("item_seq", F.greatest(F.size("item_seq") - history + 1, F.lit(1)), F.lit(history))

    def followers(i):
        later = F.slice(s, i + 2, F.lit(window))
        return F.transform(
            later,
            lambda other, step: F.struct(
                F.element_at(s, i + 1).alias("item"),
                other.alias("next"),
                F.pow(F.lit(float(decay)), step).alias("score"),
            ),
        )

    rows = seq.where(F.size("item_seq") >= 2).select(last.alias("_s"))
    steps = F.flatten(F.transform(F.sequence(F.lit(0), F.size(s) - 2), followers))
    return (
        rows.select(F.explode(steps).alias("t"))
        .groupBy("t.item", "t.next")
        .agg(rounded(F.sum("t.score"), 9).alias("score"), F.count(F.lit(1)).alias("n"))
    )


def next_item_model(
    seq: DataFrame, k: int = DEFAULTS.top_k, window: int = 1, decay: float = 0.5, history: int = 50
) -> DataFrame:
    """(item, candidates): the ``k`` best followers of each item, best first; a table to look at.

    Recommendations are ranked from the complete ``transitions`` (``topk_next``).
    """
    best = Window.partitionBy("item").orderBy(F.desc("score"), "next")
    return (
        transitions(seq, window, decay, history)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "next", "score"))).alias("candidates"))
    )


def popular_items(seq: DataFrame, most: int) -> DataFrame:
    """(next, place): the ``most`` most frequent items of the sequences, by number of places, then item."""
    counts = seq.select(F.explode("item_seq").alias("next")).groupBy("next").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "next").limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "next"))).select("next", "place")


def topk_next(
    model: DataFrame,
    hist: DataFrame,
    popular: DataFrame,
    k: int = DEFAULTS.top_k,
    recency: float = 0.5,
) -> DataFrame:
    """``hist`` with ``top``: ``k`` items for each row, or all there are.

    ``model`` is the complete ``transitions`` table. Every item of the history votes for its followers, an item
    further back with ``recency`` to the power of its steps. Places that stay free go to ``popular``, which needs
    twice ``k`` rows: ``k`` may be chosen already. Equal scores go by popularity, then by item.
    """
    steps = hist.select("visitorid", F.posexplode(F.reverse("history")).alias("_back", "item"))
    votes = steps.groupBy("visitorid", "item").agg(F.sum(F.pow(F.lit(float(recency)), F.col("_back"))).alias("_vote"))
    # A join on the item, whose hot keys adaptive planning splits; sums are taken in each task first.
    scored = votes.join(model, "item").select("visitorid", "next", (F.col("_vote") * F.col("score")).alias("s"))
    # 2k rows, as a list that every visitor gets.
    pool = popular.orderBy("place").limit(2 * k).agg(F.collect_list("next").alias("_pool"))
    free = hist.select("visitorid").distinct().join(F.broadcast(pool))
    free = free.select("visitorid", F.explode("_pool").alias("next"), F.lit(0.0).alias("s"))
    total = scored.unionByName(free).groupBy("visitorid", "next").agg(rounded(F.sum("s"), 9).alias("s"))
    placed = total.join(F.broadcast(popular.limit(2 * k)), "next", "left")
    best = Window.partitionBy("visitorid").orderBy(F.desc("s"), F.asc_nulls_last("place"), "next")
    ranked = placed.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k)
    top = ranked.groupBy("visitorid").agg(F.sort_array(F.collect_list(F.struct("_rank", "next"))).alias("_top"))
    return hist.join(top, "visitorid", "left").select(*hist.columns, F.col("_top.next").alias("top"))


def popularity_baseline(train: DataFrame, hist: DataFrame, k: int = DEFAULTS.top_k) -> DataFrame:
    """``hist`` with the ``k`` most popular items as everybody's answer."""
    pool = popular_items(train, k).orderBy("place").agg(
        F.sort_array(F.collect_list(F.struct("place", "next")))["next"].alias("top")
    )
    return hist.join(F.broadcast(pool))


def hit_ndcg(scored: DataFrame, k: int = DEFAULTS.top_k) -> DataFrame:
    """Hit rate and NDCG at ``k``, mean over all rows."""
    rank = F.array_position("top", F.col("target"))
    hit = (rank > 0) & (rank <= k)
    gain = F.when(hit, 1 / F.log2(F.nullif(rank, F.lit(0)).cast("double") + 1)).otherwise(F.lit(0.0))
    return scored.agg(
        F.avg(hit.cast("double")).alias("hit_rate"),
        F.avg(gain).alias("ndcg"),
        F.count(F.lit(1)).alias("samples"),
    )


# co-occurrence --------------------------------------------------------------


def cooccurrence_weights(seq: DataFrame, after_weight: float = 2.0) -> DataFrame:
    """(anchor, other, weight) over all sequences.

    From the anchor's first place in a sequence, every other position adds
    ``1 / (distance + 1)``, times ``after_weight`` when it comes later. Weights
    are rounded to nine digits so equal sums tie in whatever order they add up.
    """
    # One short sequence becomes up to 2,450 pairs; the pairs themselves fold before the shuffle.
    spread = seq.select("visitorid", F.col("item_seq").alias("_s")).repartition("visitorid")
    anchors = spread.select("_s", F.explode(F.array_distinct("_s")).alias("anchor"))
    placed = anchors.withColumn("_at", F.array_position("_s", F.col("anchor")).cast("int") - 1)
    pairs = placed.select("anchor", "_at", F.posexplode("_s").alias("_i", "other"))
    side = F.when(F.col("_i") > F.col("_at"), F.lit(float(after_weight))).otherwise(F.lit(1.0))
    weight = side / (F.abs(F.col("_i") - F.col("_at")) + 1)
    return (
        pairs.where(F.col("other") != F.col("anchor"))
        .groupBy("anchor", "other")
        .agg(rounded(F.sum(weight), 9).alias("weight"))
    )


def cooccurrence(
    seq: DataFrame, k: int = 5, after_weight: float = 2.0, anchors: DataFrame | None = None
) -> DataFrame:
    """Top ``k`` other items per anchor; ``anchors`` (anchor) limits the work to those."""
    if anchors is not None:
        wanted = seq.select("visitorid", F.explode(F.array_distinct("item_seq")).alias("anchor"))
        hits = wanted.join(anchors, "anchor", "left_semi").select("visitorid").distinct()
        seq = seq.join(hits, "visitorid", "left_semi")
    weights = cooccurrence_weights(seq, after_weight)
    if anchors is not None:
        weights = weights.join(anchors, "anchor", "left_semi")
    best = Window.partitionBy("anchor").orderBy(F.desc("weight"), "other")
    return weights.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def anchor_sessions(seq: DataFrame) -> DataFrame:
    return (
        seq.select(F.explode(F.array_distinct("item_seq")).alias("anchor"))
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


def reco_confidence(pairs: DataFrame, seq: DataFrame) -> DataFrame:
    """Weight per session with the anchor, in percent up to 100, with its tier."""
    percent = F.least(F.lit(100.0), F.col("weight") / F.col("sessions") * 100)
    tier = F.when(percent > 70, "High").when(percent > 40, "Medium").otherwise("Low")
    return (
        pairs.join(anchor_sessions(seq), "anchor")
        .withColumn("confidence", percent)
        .withColumn("tier", tier)
    )


# tuning ---------------------------------------------------------------------


def evaluate_reco(train: DataFrame, test: DataFrame, c: RecoCandidate, k: int = DEFAULTS.top_k):
    model = transitions(train, c.window, c.decay, c.history)
    hist = leave_last_out(test, c.history)
    return hit_ndcg(topk_next(model, hist, popular_items(train, 2 * k), k, c.recency), k).first()


def tune_reco(seq: DataFrame, candidates: list[RecoCandidate]) -> tuple[list[dict], RecoCandidate]:
    """Held-out hit rate and NDCG of each candidate, and the best by NDCG.

    The refit of the best on all rows is scored too, as ``in_sample``.
    """
    seq = materialise(seq)
    results = []
    for number, c in enumerate(candidates):
        train, test = visitor_split(seq, c.train_share)
        row = evaluate_reco(train, test, c)
        results.append(
            {"candidate": number, "scored_on": "holdout", "hit_rate": row.hit_rate, "ndcg": row.ndcg, **asdict(c)}
        )
    best = max(range(len(candidates)), key=lambda i: (results[i]["ndcg"] or 0.0, -i))
    row = evaluate_reco(seq, seq, candidates[best])
    results.append(
        {
            "candidate": best,
            "scored_on": "in_sample",
            "hit_rate": row.hit_rate,
            "ndcg": row.ndcg,
            **asdict(candidates[best]),
        }
    )
    return results, candidates[best]


def by_item_id(df: DataFrame, items: DataFrame, *cols: str) -> DataFrame:
    """``df`` with the item indexes in ``cols`` replaced by item ids; ``items`` is the shared item dimension."""
    for c in cols:
        names = items.select(F.col("item_idx").alias(c), F.col("itemid").alias("_name"))
        df = df.join(names, c, "left").withColumn(c, F.col("_name")).drop("_name")
    return df


def item_recommendations(seq: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """(itemid, rank, recommended, weight, confidence, tier): what goes with each item, in item ids."""
    pairs = by_item_id(reco_confidence(cooccurrence(seq, k), seq), items, "anchor", "other")
    return pairs.select(
        F.col("anchor").alias("itemid"), "rank", F.col("other").alias("recommended"), "weight", "confidence", "tier"
    )


def training_curve(results: DataFrame) -> DataFrame:
    """Metrics per held-out candidate with the best so far; one row per candidate."""
    upto = Window.orderBy("candidate")
    return results.where(F.col("scored_on") == "holdout").select(
        F.col("candidate").alias("iteration"),
        "hit_rate",
        "ndcg",
        F.max("ndcg").over(upto).alias("best_ndcg"),
    )
