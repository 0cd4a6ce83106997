"""Streams: bounded file streams, exports that resume, run counters with state, sessions that expire."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from gristmill.session import ready_for_python
from gristmill.sources.sinks import append_new


def files(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", each: int = 1) -> DataFrame:
    """A stream of files, a few at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", each).format(kind).load(path)


def export_stream(rows: DataFrame, path: str, checkpoint: str, id_col: str = "id") -> StreamingQuery:
    """Append rows as they come, each id once; a restart goes on where the checkpoint is, and a repeated batch adds nothing."""
    put = lambda batch, _: append_new(batch, path, id_col)
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by key and tumbling window; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def sessions(events: DataFrame, key: str = "user_id", time: str = "ts", idle: str = "1 hour") -> DataFrame:
    """Sessions that end after an idle time: (key, start, end, n)."""
    s = events.groupBy(key, F.session_window(time, idle).alias("s")).agg(F.count("*").alias("n"))
    return s.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


STREAK_OUT, STREAK_STATE = "group_id long, event_id long, errors long, streak long", "errors long, streak long"


def _count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    errors, streak = state.get if state.exists else (0, 0)
    for pdf in batches:
        rows = []
        for i, bad in zip(*(pdf.sort_values(["ts", "event_id"])[c] for c in ("event_id", "bad"))):
            errors, streak = errors + int(bad), streak + 1 if bad else 0
            rows.append((key[0], i, errors, streak))
        yield pd.DataFrame(rows, columns=["group_id", "event_id", "errors", "streak"])
    state.update((errors, streak))


def run_counters(events: DataFrame) -> DataFrame:
    """Errors so far and errors in a row of each group (group_id, event_id, ts, bad), kept as state across batches."""
    ready_for_python(events.sparkSession)
    return events.groupBy("group_id").applyInPandasWithState(_count, STREAK_OUT, STREAK_STATE, "append", GroupStateTimeout.NoTimeout)


def _expire(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        n = state.get[0]
        state.remove()
        yield pd.DataFrame([(key[0], n)], columns=["session_id", "n"])
        return
    n = (state.get[0] if state.exists else 0) + sum(len(b) for b in batches)
    state.update((n,))
    state.setTimeoutDuration(3_600_000)
    yield pd.DataFrame([], columns=["session_id", "n"])


def expired_sessions(events: DataFrame) -> DataFrame:
    """(session_id, n) of sessions without an event for an hour of processing time."""
    ready_for_python(events.sparkSession)
    return events.groupBy("session_id").applyInPandasWithState(_expire, "session_id long, n long", "n long", "append", GroupStateTimeout.ProcessingTimeTimeout)
