"""Events as a stream: cleaned and without copies, and cut into sessions.

State is bounded by the watermark: copies are recognised, and sessions stay open, for ``delay`` of event time. Rows later
than that are dropped by the state operators and counted. Sinks are Parquet files with a checkpoint in the shared
folder, so a restarted run goes on where the last one ended and every result is written once. Partial sessions
of a busy visitor are merged in each task before the shuffle where the session sets
``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import drop_missing, event_whitelist, parse_epoch_ms
from ..params import Params

DEFAULTS = Params()
DELAY = "1 day"


@dataclass
class Report:
    """What one run did: batches, rows read, rows dropped as late."""

    batches: int
    rows: int
    late: int


def read_stream(spark: SparkSession, folder: str, schema: str, files_at_once: int = 1000) -> DataFrame:
    """New Parquet files below ``folder``, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def clean_stream(raw: DataFrame, allowed: tuple[str, ...] = DEFAULTS.allowed_events, delay: str = DELAY) -> DataFrame:
    """``cleaning.clean_events`` row by row; a copy is dropped if it comes within ``delay`` of event time."""
    rows = drop_missing(event_whitelist(parse_epoch_ms(raw), allowed), ["visitorid"])
    return rows.withWatermark("timestamp", delay).dropDuplicates()


def session_stream(ev: DataFrame, gap_minutes: int = DEFAULTS.session_gap_minutes, delay: str = DELAY) -> DataFrame:
    """(visitorid, first, last, events) of every session that is over; a pause longer than the gap ends one.

    A window of Spark's ends at a pause of the gap itself, so a microsecond is added.
    """
    gap = f"{gap_minutes} minutes 1 microseconds"
    sessions = ev.withWatermark("timestamp", delay).groupBy(F.session_window("timestamp", gap).alias("_w"), "visitorid")
    return sessions.agg(F.count(F.lit(1)).alias("events")).select(
        "visitorid", F.col("_w.start").alias("first"), (F.col("_w.end") - F.expr(f"interval {gap}")).alias("last"), "events"
    )


def run_available(df: DataFrame, out: str, checkpoint: str) -> Report:
    """Process all files that are there, append the results to ``out``, and stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    return Report(len(progress), sum(p["numInputRows"] for p in progress), late)


def closing_row(ev: DataFrame, days: int = 3) -> DataFrame:
    """One row long after all others: it moves the watermark past every open session and stays open itself."""
    columns = {"visitorid": F.lit(-1), "timestamp": F.max("timestamp") + F.expr(f"interval {days} days")}
    kinds = {f.name: f.dataType for f in ev.schema}
    return ev.agg(*[columns.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
