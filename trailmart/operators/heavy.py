"""The most frequent values without counting all values.

Every task keeps a bounded number of counters (Misra and Gries): when they overflow, the largest one that has to go is
taken off all. What a value may have lost is known, so after the tasks' counters are merged to one bounded set, an exact
count of those candidates either proves the answer or shows that more counters are needed. The shuffles carry
counters, not values: their size does not grow with the number of values.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = 1 << 12
MOST_COUNTERS = 1 << 18


def _cut(counts: pd.Series, counters: int) -> tuple[pd.Series, int]:
    """At most ``counters`` counters, and how much was taken off each."""
    if len(counts) <= counters:
        return counts, 0
    off = int(counts.nlargest(counters + 1).iloc[-1])
    counts = counts - off
    return counts[counts > 0], off


def summaries(df: DataFrame, col: str, counters: int) -> DataFrame:
    """(value, n, lost) of each task: its counters, and one row with a null value that says what each may have lost."""
    kind = df.schema[col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, lost = pd.Series(dtype="int64"), 0
        for batch in batches:
            held = held.add(batch[col].value_counts(), fill_value=0).astype("int64")
            held, off = _cut(held, counters)
            lost += off
        if len(held):
            yield pd.DataFrame({"value": held.index, "n": held.to_numpy(), "lost": 0})
        yield pd.DataFrame({"value": pd.Series([None], dtype="object"), "n": [0], "lost": [lost]})

    return df.where(F.col(col).isNotNull()).select(col).mapInPandas(run, f"value {kind}, n long, lost long")


def heavy_hitters(df: DataFrame, col: str, top: int, counters: int = COUNTERS, most: int = MOST_COUNTERS) -> DataFrame:
    """(col, n): the ``top`` most frequent values, larger count first, then smaller value. Exact; nulls do not count.

    If the counters do not prove the answer even at ``most`` of them, the values are too even and are all counted.
    """
    while counters <= most:
        seen = summaries(df, col, counters)
        sums = seen.groupBy("value").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")).persist()
        try:
            lost = sums.agg(F.coalesce(F.sum("lost"), F.lit(0))).first()[0]
            best = sums.where("value is not null").orderBy(F.desc("n"), "value").limit(counters + 1).collect()  # bounded
        finally:
            sums.unpersist()
        left_out = best[counters]["n"] if len(best) > counters else 0
        # A value that is no candidate occurs at most this often.
        bound = lost + left_out
        candidates = df.sparkSession.createDataFrame([(r["value"],) for r in best[:counters]], f"{col} {df.schema[col].dataType.simpleString()}")
        counted = df.join(F.broadcast(candidates), col, "left_semi").groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        answer = counted.orderBy(F.desc("n"), col).limit(top)
        rows = answer.collect()  # top rows
        if not bound or (len(rows) == top and rows[-1]["n"] > bound):
            return df.sparkSession.createDataFrame([tuple(r) for r in rows], answer.schema)
        counters *= 8
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(top)
