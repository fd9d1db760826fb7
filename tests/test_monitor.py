"""Reports of a stream equal those of its table, over stops, a crash and late events."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException

from regolith.streaming import monitor

ZERO = dt.datetime(2024, 1, 1)
SCHEMA = "job string, ts timestamp, note int"


def rows_of(df):
    return sorted((r.key, r.at, r.done, r.per_minute, r.per_hour, r.remaining, -1 if r.eta_minutes is None else r.eta_minutes, r.percent) for r in df.collect())


def plain(events, total, interval, until):
    out = []
    for job in {j for j, _ in events if j}:
        seconds = sorted(int((t - ZERO).total_seconds()) for j, t in events if j == job)
        start = seconds[0] // interval * interval
        at = start + interval
        while at <= until:
            done = sum(s < at for s in seconds)
            rate = done * 60 // (at - start)
            out.append((job, ZERO + dt.timedelta(seconds=at), done, rate, rate * 60, total - done, (total - done) // rate if rate else -1, done * 100 // total))
            if done >= total:
                break
            at += interval
    return sorted(out)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(2)
    out = []
    for minute in range(0, 180):
        for job, share in (("a", 0.9), ("b", 0.3 if minute < 60 else 0.0), ("c", 0.5 if minute > 40 else 0.0)):
            out += [(job, ZERO + dt.timedelta(minutes=minute, seconds=rng.randrange(60))) for _ in range(rng.randrange(3)) if rng.random() < share]
    return out


def test_reports(spark, events):
    df = spark.createDataFrame([(j, t, 0) for j, t in events] + [(None, ZERO, 0), ("a", None, 0)], SCHEMA)
    last = int((max(t for _, t in events) - ZERO).total_seconds())
    assert rows_of(monitor.reports(df, "job", "ts", 100, 600)) == plain(events, 100, 600, last)
    assert monitor.reports(df.limit(0), "job", "ts", 100, 600).count() == 0


def test_stream_goes_on_after_a_crash(spark, events, tmp_path):
    """Four files, one batch each; the sink fails in one batch after state has moved on, and the query is stopped and started again."""
    rng = random.Random(3)
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    shuffled = sorted(events, key=lambda e: e[1] + dt.timedelta(seconds=rng.randrange(500)))  # up to 500 s late: within the watermark
    size = -(-len(shuffled) // 4)
    parts = [shuffled[i : i + size] for i in range(0, len(shuffled), size)]
    stale = [("a", ZERO), ("b", ZERO + dt.timedelta(minutes=1))]  # hours late
    parts[3] = parts[3] + stale
    crash = {"at": None}

    def put(batch, n):
        if n == crash["at"]:
            crash["at"] = None
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{sink}/batch={n}")

    def run():
        live = spark.readStream.schema(SCHEMA).parquet(source)
        query = monitor.monitor(live, "job", "ts", 100, 600).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    for k, part in enumerate(parts):
        spark.createDataFrame([(j, t, k) for j, t in part], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if k == 2:
            import os

            crash["at"] = max(int(x.split("=")[1]) for x in os.listdir(sink)) + 1
            with pytest.raises(StreamingQueryException):
                run()
        run()
    mark = int((max(t for _, t in events) - ZERO).total_seconds()) - 600
    got = rows_of(spark.read.parquet(sink).drop("batch"))
    assert got == plain(events, 100, 600, mark // 600 * 600)
    assert {r[0] for r in got} == {"a", "b", "c"} and max(r[7] for r in got) >= 100
