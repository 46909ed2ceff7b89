"""Due events from timers (str_due_events): a route's travel date whose data expire without a newer scrape is reported when that time
has come, without any further input for it.

``transformWithStateInPandas`` in event time: the state of a route and date is its newest scrape and that scrape's expiry, for which a timer
is set; a newer scrape moves the timer. A timer fires once the watermark, the newest scrape time of all keys so far, has passed it.
A key silent for ``ttl_days`` loses its state. Rows older than the key's newest scrape change nothing.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from milesbase.streaming.jobs import _run_available_now

KEY = ["origin", "destination", "airline", "date"]
SCHEMA = "origin string, destination string, airline string, date date, t timestamp, due timestamp"
OUT = "origin string, destination string, airline string, date date, scraped_at_us long, due_at_us long"


def _us(ts) -> int:
    return int(pd.Timestamp(ts).value // 1000)


class DueRoutes(StatefulProcessor):
    """State: (newest scrape, its expiry) in microseconds; at most one timer per key."""

    def __init__(self, ttl_days: int) -> None:
        self.ttl_ms = ttl_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long, due long")

    def _watch(self, t: int, due: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((t, due))
        self.handle.registerTimer(-(-due // 1000))  # milliseconds, not before the expiry

    def _row(self, key, t: int, due: int) -> dict:
        return {**dict(zip(KEY, key)), "scraped_at_us": t, "due_at_us": due}

    def handleInputRows(self, key, rows, timerValues):
        new = sorted({(_us(t), _us(d)) for pdf in rows for t, d in zip(pdf["t"], pdf["due"])})
        now, found = self.last.get() if self.last.exists() else None, []
        for t, due in new:
            if now is not None and t <= now[0]:
                continue
            # the time had come before this scrape; a timer that had fired has left its due time at 0
            if now is not None and 0 < now[1] <= t:
                found.append(self._row(key, *now))
            now = (t, due)
        if now is not None and (not self.last.exists() or tuple(self.last.get()) != tuple(now)):
            self._watch(*now)
        yield pd.DataFrame(found, columns=[c.split(" ")[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        found = []
        if self.last.exists():
            t, due = self.last.get()
            if due > 0:
                found.append(self._row(key, t, due))
                self.last.update((t, 0))
                # the state itself goes later, by a second timer
                self.handle.registerTimer(-(-due // 1000) + self.ttl_ms)
            else:
                self.last.clear()
        yield pd.DataFrame(found, columns=[c.split(" ")[0] for c in OUT.split(", ")])

    def close(self) -> None:
        pass


def due_events(spark: SparkSession, landing: str, out: str, checkpoint: str, ttl_days: int = 30) -> DataFrame:
    """Take in what has landed since the last call (a restart resumes from the checkpoint) and return all due events so far."""
    stream = spark.readStream.schema(SCHEMA).parquet(landing).withWatermark("t", "0 seconds")
    events = stream.groupBy(*KEY).transformWithStateInPandas(DueRoutes(ttl_days), OUT, "Append", "EventTime")
    _run_available_now(events.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)
    us = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return spark.read.schema(OUT).parquet(out).select(*KEY, us("scraped_at_us").alias("scraped_at_utc"), us("due_at_us").alias("due_at_utc"))


def land_slice(df: DataFrame, landing: str) -> None:
    """One arrival of scrapes (route, date, t, due) as files of their own."""
    df.select(*KEY, F.col("t").cast("timestamp").alias("t"), F.col("due").cast("timestamp").alias("due")) \
      .write.mode("append").parquet(landing)
