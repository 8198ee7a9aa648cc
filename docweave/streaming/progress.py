"""Progress of runs from their activities' signals (run_id, activity_id, progress, weight, ts)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(signals: DataFrame, order: str = "ts", tie: str = "seq") -> DataFrame:
    """The last signal of each activity."""
    last = F.max_by(F.struct("progress", "weight"), F.struct(order, tie)).alias("s")
    return signals.groupBy("run_id", "activity_id").agg(last).select("run_id", "activity_id", "s.progress", "s.weight")


def totals(signals: DataFrame, order: str = "ts", tie: str = "seq") -> DataFrame:
    """Weighted progress and its maximum for each run."""
    last = latest(signals, order, tie)
    return last.groupBy("run_id").agg(F.sum(F.col("progress") * F.col("weight")).alias("progress"), F.sum("weight").alias("max_progress"))


def throttled(signals: DataFrame, interval_s: float = 30.0) -> DataFrame:
    """Signals that are sent on: the first of each activity, forced ones, and those ``interval_s`` after the last sent.

    One activity's signals are folded in order in one task.
    """
    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows, last, kept = rows.sort_values(["ts", "seq"]), None, []
        for ts, force in zip(rows["ts"], rows["force"], strict=True):
            send = bool(force) or last is None or (ts - last).total_seconds() >= interval_s
            last = ts if send else last
            kept.append(send)
        return rows[kept]

    return signals.groupBy("run_id", "activity_id").applyInPandas(fold, signals.schema)


def with_bounds(signals: DataFrame) -> DataFrame:
    """Adds the forced first (0.0) and last (1.0) signal of each activity."""
    ends = signals.groupBy("run_id", "activity_id").agg(F.min(F.struct("ts", "seq")).alias("a"), F.max(F.struct("ts", "seq")).alias("z"), F.first("weight").alias("weight"))
    make = lambda end, step, p: ends.select("run_id", "activity_id", F.lit(p).alias("progress"), "weight", F.col(f"{end}.ts").alias("ts"), (F.col(f"{end}.seq") + step).alias("seq"), F.lit(True).alias("force"))
    return signals.unionByName(make("a", -1, 0.0)).unionByName(make("z", 1, 1.0))


def stream_latest(signals: DataFrame, name: str):
    """Keeps each activity's last signal of a stream in a table in memory; returns the running query."""
    return latest(signals).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
