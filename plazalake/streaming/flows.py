"""The incremental flows as Structured Streaming jobs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from plazalake.operators.load import latest_per_key
from plazalake.sources.versions import VersionedTable


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """First row of each key, across restarts. With an event time the state is bounded by ``late``."""
    if event_time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


def since(stream: DataFrame, event_time: str, start: str) -> DataFrame:
    return stream.filter(F.col(event_time) >= F.lit(start).cast("timestamp"))


def event_rate(stream: DataFrame, event_time: str, width: str = "10 minutes", step: str = "1 minute", late: str = "10 minutes", most: int = 3) -> DataFrame:
    """Events in each sliding window, with an alert above ``most``."""
    n = stream.withWatermark(event_time, late).groupBy(F.window(event_time, width, step)).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("alert", F.col("n") > most)


def sessions(stream: DataFrame, event_time: str, gap: str = "600 seconds", late: str = "10 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """Stretches of events less than ``gap`` apart; where one ends, its run has stalled."""
    return stream.withWatermark(event_time, late).groupBy(*keys, F.session_window(event_time, gap)).agg(F.count(F.lit(1)).alias("n"))


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and stop; a later run goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_versions(stream: DataFrame, table: VersionedTable, keys: Sequence[str], order: Sequence[str], checkpoint: str, keep_if_null: Sequence[str] = (), newest: str | None = None) -> DataStreamWriter:
    """A writer that upserts each micro-batch's latest row per key into a new version of ``table``. The
    checkpoint names the stream: its batches are committed once each, also when one is run again
    because the job died between the table's commit and the checkpoint's. With ``newest``, a batch
    that comes late does not write over newer rows."""

    def batch(df: DataFrame, epoch: int) -> None:
        latest = latest_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])
        table.upsert(latest, keys, keep_if_null, newest, stream=checkpoint, epoch=epoch)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def first_batch(writer: DataStreamWriter, wait_s: float = 300) -> StreamingQuery:
    """Run one micro-batch, as large as the source's rate limit allows, and stop."""
    query = writer.trigger(processingTime="3650 days").start()
    until = time.monotonic() + wait_s
    try:
        while query.lastProgress is None and query.isActive and time.monotonic() < until:
            time.sleep(0.05)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    return query


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """Key and value of each row that a stopped stream holds in its state; of own state that of a variable
    (for a list: a row an element)."""
    source = spark.read.format("statestore").option("operatorId", operator)
    if variable is None:
        return source.load(checkpoint).select("key", "value")
    found = source.option("stateVarName", variable).load(checkpoint)
    return found.select("key", F.col("value") if "value" in found.columns else F.col("list_element").alias("value"))


class Breaker(StatefulProcessor):
    """Opens after ``streak`` bad results in a row, or when none of the last ``memory`` was good. The state of
    a run that has ended goes after the time to live."""

    STREAK, MEMORY = 3, 40

    def __init__(self, live_ms: int | None):
        self.live_ms = live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.streak = handle.getValueState("streak", "n int", ttlDurationMs=self.live_ms)
        self.recent = handle.getListState("recent", "ok boolean", ttlDurationMs=self.live_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        streak = self.streak.get()[0] if self.streak.exists() else 0
        recent = [ok for (ok,) in self.recent.get()] if self.recent.exists() else []
        out = []
        # a key's rows of one micro-batch, in order
        for seq, ok in pd.concat(list(rows)).sort_values("seq")[["seq", "ok"]].itertuples(index=False):
            streak = 0 if ok else streak + 1
            recent = [*recent, bool(ok)][-self.MEMORY :]
            out.append((key[0], seq, streak, streak >= self.STREAK or (len(recent) == self.MEMORY and not any(recent))))
        self.streak.update((streak,))
        self.recent.put([(ok,) for ok in recent])
        yield pd.DataFrame(out, columns=["run_id", "seq", "streak", "open"])

    def close(self) -> None:
        pass


class Stall(StatefulProcessor):
    """An alert when a run has logged nothing for ``gap_ms`` of event time. With the alert the run's state
    ends; rows that by the watermark come too late to put an alert off count no more."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest = max(int(part["ms"].max()) for part in rows)
        if latest + self.gap_ms > timerValues.getCurrentWatermarkInMs():
            before = self.last.get()[0] if self.last.exists() else None
            if before is None or before < latest:
                if before is not None:
                    self.handle.deleteTimer(before + self.gap_ms)
                self.last.update((latest,))
                self.handle.registerTimer(latest + self.gap_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (latest,) = self.last.get()
        self.last.clear()
        yield pd.DataFrame({"run_id": [key[0]], "last_ms": [latest]})

    def close(self) -> None:
        pass


def stalled(log: DataFrame, event_time: str, gap_ms: int = 600_000, late: str = "1 minute") -> DataFrame:
    """(run_id, last_ms) of runs that log nothing for the gap, as soon as the watermark shows it. A run
    that goes on can stall again. Event time is a timestamp."""
    timed = log.withWatermark(event_time, late).select("run_id", event_time, F.unix_millis(event_time).alias("ms"))
    return timed.groupBy("run_id").transformWithStateInPandas(Stall(gap_ms), "run_id long, last_ms long", "Append", "EventTime")


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Own state needs this provider; the session's setting comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def breaker(results: DataFrame, live_ms: int | None = None) -> DataFrame:
    """State of the breaker after each result (run_id, seq, ok) of a stream. A run's rows of one
    micro-batch are ordered in memory: the source's rate limit bounds them. With ``live_ms``
    what is known of a run goes when it has had no result for so long by the clock; such a stream runs for
    ever unless batches without data are switched off, also when started with availableNow."""
    mode = "None" if live_ms is None else "ProcessingTime"
    return results.groupBy("run_id").transformWithStateInPandas(Breaker(live_ms), "run_id long, seq long, streak int, open boolean", "Append", mode)
