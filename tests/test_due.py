"""Due events from timers: no input needed, restarts, repeated, equal-time and older scrapes."""

import datetime as dt
import os
import tempfile

from milesbase.streaming import due

DAY = dt.datetime(2024, 1, 29)


def _at(h):
    return DAY + dt.timedelta(hours=h)


def _land(spark, landing, *rows):
    df = spark.createDataFrame([("AAA", r, "AS", dt.date(2024, 2, 9), _at(t), _at(d)) for r, t, d in rows], due.SCHEMA)
    due.land_slice(df.coalesce(1), landing)


def test_due_events_with_timers_and_restarts(spark):
    base = tempfile.mkdtemp(prefix="due-", dir=spark.conf.get("spark.checkpoint.dir").rsplit("/", 1)[0])
    landing, out, ck = (os.path.join(base, x) for x in ("landing", "out", "ck"))

    def drain():
        got = due.due_events(spark, landing, out, ck, ttl_days=1).collect()
        return sorted((r["destination"], (r["scraped_at_utc"] - DAY).total_seconds() / 3600, (r["due_at_utc"] - DAY).total_seconds() / 3600) for r in got)

    # B is scraped again in time, C too late (reported by the rows themselves), D not again; equal rows count once
    _land(spark, landing, ("B", 0, 8), ("B", 4, 12), ("C", 0, 2), ("C", 3, 11), ("C", 3, 11), ("D", 1, 5), ("E", 4, 99))
    assert drain() == [("C", 0, 2)]
    # nothing new for D: its timer fires once others have moved the watermark past its expiry; an older scrape of B changes nothing
    _land(spark, landing, ("E", 10, 99), ("B", 2, 3))
    assert drain() == [("C", 0, 2), ("D", 1, 5)]
    assert drain() == [("C", 0, 2), ("D", 1, 5)]  # started again without input: not reported twice
    # D comes back after its event; B and C fire; D's state was kept
    _land(spark, landing, ("D", 20, 90), ("E", 30, 99))
    want = [("B", 4, 12), ("C", 0, 2), ("C", 3, 11), ("D", 1, 5)]
    assert drain() == want
    # a day after B's and C's events their states go, with no further event
    _land(spark, landing, ("E", 60, 99))
    assert drain() == want
