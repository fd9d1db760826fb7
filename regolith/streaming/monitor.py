"""Progress of running jobs, from the events they write: reports at set intervals, of a stream by keyed state and timers, or of a table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state with timers needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _measured(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (key, at and start in seconds, done) with rates and what remains, in whole numbers, as a job's owner reads them."""
    elapsed = F.col("at") - F.col("start")
    per_minute = F.expr("done * 60 DIV (at - start)")
    left = F.lit(int(total)) - F.col("done")
    return rows.filter(elapsed > 0).select(
        "key", F.timestamp_seconds("at").alias("at"), "done", per_minute.alias("per_minute"), (per_minute * 60).alias("per_hour"), left.cast("long").alias("remaining"),
        F.expr(f"({int(total)} - done) DIV nullif(done * 60 DIV (at - start), 0)").alias("eta_minutes"), F.expr(f"CAST(done * 100 DIV {int(total)} AS INT)").alias("percent"),
    )


def reports(events: DataFrame, key: str, time: str, total: int, interval: int, until: Column | None = None) -> DataFrame:
    """(key, at, done, per_minute, per_hour, remaining, eta_minutes, percent) of a table of events.

    A report is made for each job at each end of an interval (of so many seconds, from the epoch on) after its first event, up to ``until``
    (a constant; by default the last event's time), until it has ``total`` events: how many there are before that end, the rate since its first
    interval began, and what remains at that rate (null at a rate of 0 a minute). Intervals without events are reported too. Null keys and
    times are left out; an empty table gives none.
    """
    known = events.select(F.col(key).cast("string").alias("key"), F.unix_seconds(F.col(time).cast("timestamp")).alias("t")).filter("key IS NOT NULL AND t IS NOT NULL")
    step = F.lit(int(interval))
    counts = known.groupBy("key", F.floor(F.col("t") / step).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    end = known.agg(F.max("t").alias("end")) if until is None else known.limit(1).select(F.unix_seconds(until.cast("timestamp")).alias("end"))
    spans = counts.groupBy("key").agg(F.min("b").alias("first")).crossJoin(F.broadcast(end)).withColumn("last", F.floor(F.col("end") / step)).filter("first < last")
    ends = spans.select("key", (F.col("first") * step).alias("start"), F.explode(F.sequence(F.col("first") + 1, "last")).alias("e"))
    own = ends.join(counts.select("key", (F.col("b") + 1).alias("e"), "n"), ["key", "e"], "left")
    w = Window.partitionBy("key").orderBy("e")
    summed = own.withColumn("done", F.sum(F.coalesce("n", F.lit(0))).over(w)).withColumn("was", F.col("done") - F.coalesce("n", F.lit(0)))
    return _measured(summed.filter(F.col("was") < total).select("key", (F.col("e") * step).alias("at"), "start", "done"), total)


class _Progress(StatefulProcessor):
    """For each job: counts by interval that no report has taken yet, and its start, the next end of an interval and the events reported."""

    def __init__(self, total: int, interval: int):
        self.total, self.step = total, interval * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "b bigint", "n bigint")
        self.state = handle.getValueState("state", "start bigint, next bigint, done bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs()
        for part in rows:
            b = part["t"][part["t"] >= behind] // self.step
            for k, n in b.value_counts().items():
                k = (int(k),)
                self.counts.updateValue(k, ((self.counts.getValue(k)[0] if self.counts.containsKey(k) else 0) + int(n),))
            if len(b):
                first = int(b.min())
                if not self.state.exists():
                    self._wait((first * self.step, (first + 1) * self.step, 0))
                else:
                    start, at, done = self.state.get()
                    if done == 0 and first * self.step < start:  # an earlier event came later, before any report
                        self.handle.deleteTimer(at)
                        self._wait((first * self.step, (first + 1) * self.step, 0))
        yield from ()

    def _wait(self, state: tuple[int, int, int]) -> None:
        self.state.update(state)
        self.handle.registerTimer(state[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, at, done = self.state.get()
        out = []
        while at <= timerValues.getCurrentWatermarkInMs() and done < self.total:
            k = (at // self.step - 1,)
            if self.counts.containsKey(k):
                done += self.counts.getValue(k)[0]
                self.counts.removeKey(k)
            out.append((key[0], at // 1000, start // 1000, done))
            at += self.step
        self.state.update((start, at, done))
        if done < self.total:
            self.handle.registerTimer(at)
        yield pd.DataFrame(out, columns=["key", "at", "start", "done"])

    def close(self) -> None:
        pass


def monitor(events: DataFrame, key: str, time: str, total: int, interval: int, late: str = "10 minutes") -> DataFrame:
    """The ``reports`` of a stream of events, each made once the watermark, ``late`` behind the last event, has passed its end.

    A job's state is a count for each interval that is still open, and a timer at the next end: so jobs without new events are reported too, and a
    query that is stopped or killed goes on from its checkpoint without losing or repeating a report. Events behind the watermark
    are left out. The session's state store is set to one that keeps timers.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("ts")).filter("key IS NOT NULL AND ts IS NOT NULL")
    rows = rows.withWatermark("ts", late).withColumn("t", F.unix_millis("ts"))
    found = rows.groupBy("key").transformWithStateInPandas(_Progress(int(total), int(interval)), "key string, at bigint, start bigint, done bigint", "Append", "EventTime")
    return _measured(found, total)
