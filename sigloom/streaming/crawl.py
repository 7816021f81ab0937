"""The crawl state as a stream: the same rows as the batch upsert, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import state as st
from ..sinks import current, versioned

SEEN = "key string, first_seen timestamp, last_seen timestamp, content string, versions long"


def latest_by_key(stream: DataFrame, key: str, at: str, content: str, delay: str = "1 day", ttl_ms: int | None = None) -> DataFrame:
    """Per key, first and last time, latest content and number of distinct successive contents.

    Keyed state in the state store; updates within a micro-batch are applied in time order, a whole
    batch of a key at once, so that the result is that of the whole stream. ``delay`` bounds how late
    rows may come. With ``ttl_ms`` the state of a key is dropped once the watermark is that far
    beyond its last row; a row that comes later begins anew.
    """

    def step(k: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, last, content_, versions = state.get if state.exists else (None, None, None, 0)
        rows = pd.concat([f for f in frames if len(f)]).sort_values(["at", "content"], kind="stable")
        first = rows["at"].iloc[0] if first is None else min(first, rows["at"].iloc[0])
        rows = rows if last is None else rows[rows["at"] >= last]
        if len(rows):
            before = rows["content"].shift()
            before.iloc[0] = content_
            versions += int(((rows["content"] != before) & ~(rows["content"].isna() & before.isna())).sum())
            last, content_ = rows["at"].iloc[-1], rows["content"].iloc[-1]
        state.update((first, last, content_, versions))
        if ttl_ms is not None:
            state.setTimeoutTimestamp(max(int(pd.Timestamp(last).timestamp() * 1000), state.getCurrentWatermarkMs() + 1) + ttl_ms)
        yield pd.DataFrame({"key": [k[0]], "first_seen": [first], "last_seen": [last], "content": [content_], "versions": [versions]})

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(content).cast("string").alias("content"))
    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.EventTimeTimeout
    return (
        rows.withWatermark("at", delay)
        .groupBy("key")
        .applyInPandasWithState(step, SEEN, "first_seen timestamp, last_seen timestamp, content string, versions long", "update", timeout)
    )


def windowed_counts(stream: DataFrame, at: str, by: str, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Events per window and kind; rows later than ``delay`` are dropped."""
    rows = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    return rows.groupBy(F.window(at, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> None:
    """All that is there now, in micro-batches handed to ``each``; then stop. A restart goes on where it ended."""
    query = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upserting(path: str, now: Column) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts each micro-batch into the versioned state at ``path``.

    Idempotent: a batch that is run again reads the version before its own and writes its own anew.
    Only a state that has no version yet counts as empty; any other failed read is an error.
    """

    def each(batch: DataFrame, number: int) -> None:
        version = f"{number:012d}"
        old = current(batch.sparkSession, path, before=version)
        versioned(st.upsert(old if old is not None else batch.sparkSession.createDataFrame([], st.STATE), batch, now), path, version)

    return each


class ProgressLog(StreamingQueryListener):
    """Progress of streams as rows of a run's event log (see ``metrics.RunLog``)."""

    def __init__(self, log: Callable[..., None]):
        self.log = log

    def onQueryStarted(self, event) -> None:
        self.log("stream_started", id=str(event.id), name=event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.log("stream_progress", id=str(p.id), batch=p.batchId, rows=p.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log("stream_ended", id=str(event.id), error=event.exception)
