"""Stabbing join, coverage states and the expiry sweep against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from milesbase.operators import intervals, queue, reports

D0 = dt.date(2020, 1, 1)


def test_pieces_cover_each_day_once(spark):
    rng = random.Random(1)
    spans = [(0, 0), (31, 32), (5, 4), (0, 1023), (-40, 70), (1000, 1100), (17, 20_000)] + [(a := rng.randrange(-3000, 3000), a + rng.randrange(3000)) for _ in range(30)]
    df = spark.createDataFrame(spans, "lo int, hi int")
    for r in df.select("lo", "hi", intervals.pieces(F.col("lo"), F.col("hi")).alias("p")).collect():
        days = sorted(d for x in r.p for d in range(x.block * 32**x.level, (x.block + 1) * 32**x.level))
        assert days == list(range(r.lo, r.hi + 1))
        assert len(r.p) <= 124 + (r.hi - r.lo + 1) // 1024


def test_stabbed_equals_between(spark):
    rng = random.Random(2)
    day = lambda: D0 + dt.timedelta(days=rng.randrange(3000))
    points = [(rng.choice("ab"), rng.choice([None, day()])) for _ in range(200)]
    spans = [(rng.choice("abc"), i, rng.choice([None, day()]), rng.choice([None, day(), day()])) for i in range(60)]
    spans += [("a", 100, points[0][1] or D0, points[0][1] or D0), ("b", 101, dt.date(2021, 5, 5), dt.date(2021, 5, 4))]
    p = spark.createDataFrame(points, "k string, at date")
    s = spark.createDataFrame(spans, "k string, id int, b date, e date")
    got = sorted((r.k, r.at, r.id) for r in intervals.stabbed(p, s, ["k"], "at", "b", "e").collect())
    low, high = dt.date.min, dt.date.max
    want = sorted({(k, at, i) for k, at in points if at for j, i, b, e in spans if j == k and (b or low) <= at <= (e or high)})
    assert want and got == want
    plan = intervals.stabbed(p, s, ["k"], "at", "b", "e")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_states_of_touched_months_add_up(spark):
    rng = random.Random(3)
    rows = [(rng.choice("AB"), "C", "s", D0 + dt.timedelta(days=rng.choice([0, 30, 31, 58, 59, 365, rng.randrange(400)])), rng.choice(["economy", "first", "business"]),
             dt.datetime(2020, 1, 1, rng.randrange(24))) for _ in range(300)]
    f = spark.createDataFrame(rows, "origin string, destination string, source string, date date, cabin_class string, scraped_at_utc timestamp_ntz")
    old, new = f.where("scraped_at_utc < '2020-01-01 07:00:00'"), f.where("scraped_at_utc >= '2020-01-01 07:00:00'")
    merged = reports.coverage_of(reports.merged_states(reports.coverage_states(old), reports.coverage_states(new)))
    for r in merged.collect():
        mine = [x for x in rows if x[0] == r.origin]
        assert (r.flight_rows, r.dates_covered, r.cabins_seen) == (len(mine), len({x[3] for x in mine}), len({x[4] for x in mine}))
        assert (r.first_date, r.last_date, r.cabin_list) == (min(x[3] for x in mine), max(x[3] for x in mine), ",".join(sorted({x[4] for x in mine})))
        assert r.last_flight_scrape == max(x[5] for x in mine)


def test_sweep_equals_a_recount_at_each_time(spark):
    rng = random.Random(4)
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [(rng.choice("xy"), t(a := rng.randrange(2000)), t(a + rng.choice([0, -30, 60, 480, 1440]))) for _ in range(300)]
    df = spark.createDataFrame(rows, "source string, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")
    got = reports.freshness_series(df).collect()
    assert len(got) > 50
    for r in got:
        seen = [x for x in rows if x[0] == r.source and x[1] <= r.at_utc]
        assert r.rows == len(seen) and r.unexpired_rows == sum(x[2] > r.at_utc for x in seen)
        assert abs(r.newest_age_h - (r.at_utc - max(x[1] for x in seen)).total_seconds() / 3600) <= 0.0501


def test_due_list_has_no_cap(spark):
    rng = random.Random(5)
    now = dt.datetime(2024, 1, 31)
    rows = [(i, rng.choice(["AS", "DL"]), rng.choice(["HIGH", "MED", "LOW"]), now - dt.timedelta(hours=rng.randrange(-5, 50))) for i in range(500)]
    df = spark.createDataFrame(rows, "queue_id int, airline string, priority_tier string, next_scrape_at_utc timestamp_ntz")
    got = {r.queue_id: (r.due_rank, r.due_count) for r in queue.due_list(df, "2024-01-31 00:00:00").collect()}
    for a in ("AS", "DL"):
        due = sorted([r for r in rows if r[1] == a and r[3] <= now], key=lambda r: (["HIGH", "MED", "LOW"].index(r[2]), r[3], r[0]))
        assert [got[r[0]] for r in due] == [(i + 1, len(due)) for i in range(len(due))]
