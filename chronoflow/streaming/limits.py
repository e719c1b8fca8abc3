"""Keyed counters and caches over event streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def counted(stream: DataFrame, ts: str, key: str, window: str, late: str, limit: int) -> DataFrame:
    """start, key, n, over: events per key and tumbling window; windows close ``late`` after their end.

    Works on a stream (with a watermark) and on a table alike; partial counts are merged map-side.
    """
    rows = stream.withWatermark(ts, late) if stream.isStreaming else stream
    n = rows.groupBy(F.window(ts, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.col("w.start").alias("start"), key, "n", (F.col("n") > limit).alias("over"))


def cached(stream: DataFrame, ts: str, keys: list[str], ttl_seconds: int) -> DataFrame:
    """keys, ts, hit: whether an answer kept for a key was still fresh; a miss keeps a new one.

    State per key is one time stamp, dropped when it has been stale for the time to live.
    """
    names = ", ".join(f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values([ts, "event_id"])
        hits = []
        for at in rows[ts]:
            fresh = kept is not None and at.timestamp() - kept < ttl_seconds
            hits.append(fresh)
            if not fresh:
                kept = at.timestamp()
        state.update((kept,))
        state.setTimeoutTimestamp(int((max(kept, state.getCurrentWatermarkMs() / 1000) + 2 * ttl_seconds) * 1000))
        out = rows[[*keys, ts, "event_id"]].copy()
        out["hit"] = hits
        yield out

    rows = stream.withWatermark(ts, "1 hour").select(*keys, ts, "event_id")
    return rows.groupBy(*keys).applyInPandasWithState(run, f"{names}, {ts} timestamp, event_id bigint, hit boolean", "kept double", "append", GroupStateTimeout.EventTimeTimeout)


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there now into a Parquet table, then stop."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
