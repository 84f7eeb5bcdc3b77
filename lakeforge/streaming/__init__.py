"""Micro-batch loads and event-time windows; the window functions serve batch and stream alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..store import TableStore


def trigger(name: str) -> dict:
    """``batch``, ``once`` and ``availableNow`` drain what is there; ``continuous`` runs every five seconds."""
    if name in ("batch", "once", "availableNow"):
        return {"availableNow": True}
    if name == "continuous":
        return {"processingTime": "5 seconds"}
    raise ValueError(f"unknown trigger {name!r}")


def start(stream: DataFrame, store: TableStore, table: str, strategy: str, keys: list[str], checkpoint: str, when: str = "availableNow", chain: list[Callable[[DataFrame], DataFrame]] = (), **options) -> StreamingQuery:
    """Load each micro-batch by a strategy with its options. The batch id is in the commit, so a replayed batch changes nothing."""

    def load(batch: DataFrame, batch_id: int) -> None:
        for step in chain:
            batch = step(batch)
        store.load(table, strategy, batch, keys, f"{checkpoint}#{batch_id}", **options)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger(when)).start()


def windowed(df: DataFrame, time: str, length: str, slide: str | None = None, by: list[str] = (), late: str | None = None) -> DataFrame:
    """Rows by tumbling or sliding window and key; ``late`` bounds a stream's state."""
    df = df.withWatermark(time, late) if late else df
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return df.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def sessions(df: DataFrame, time: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    df = df.withWatermark(time, late) if late else df
    return df.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), *by, "n")
