"""Ordered scans, folds as monoids and pointer chains against plain Python, hot keys included."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from milesbase.operators import folds
from milesbase.operators.numbering import numbered, scanned

T0 = dt.datetime(2024, 1, 1)


def test_scan_equals_python(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "hot", "hot", "hot", "a", "b"]), rng.choice([None, i // 3]), i, rng.choice([None, i])) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o int, pos int, v int").repartition(7)
    got = {r.pos: (r.at, r.n, r.before) for r in scanned(df, ["g"], [F.col("o").desc(), "pos"], "at", "n", {"before": F.col("v")}).collect()}
    for g in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        seen = None
        for i, r in enumerate(mine):
            assert got[r[2]] == (i, len(mine), seen)
            seen = r[3] if r[3] is not None else seen
    assert sorted(r._pos for r in numbered(df, [], ["pos"], "_pos").collect()) == list(range(600))
    assert numbered(df.limit(0), ["g"], ["o"], "at").count() == 0


def interval(changes, lo, hi, step):
    x = float(lo)
    for c in changes:
        x = max(lo, min(hi, x * 0.5 if c else x + step))
    return x


def test_intervals_compose(spark):
    rng = random.Random(7)
    keys = {("A", "B", str(k)): [rng.random() < 0.4 for _ in range(rng.choice([1, 2, 7, 90]))] for k in range(20)}
    flags = spark.createDataFrame([(*k, T0 + dt.timedelta(hours=i), c) for k, x in keys.items() for i, c in enumerate(x)],
                                  "origin string, destination string, airline string, scraped_at_utc timestamp_ntz, changed boolean")
    bounds = spark.createDataFrame([(*k, 8 + i, 48, 6, 8.0 + i) for i, k in enumerate(keys)],
                                   "origin string, destination string, airline string, lo int, hi int, step int, start double")
    want = {k: (interval(x, 8 + i, 48, 6), len(x)) for i, (k, x) in enumerate(keys.items())}
    for block in (2, 3, 256):
        got = {tuple(r[:3]): (r.interval_h, r.scrapes) for r in folds.interval_fold(flags, bounds, block=block).collect()}
        assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
    # stored states of the first scrapes, extended by those of the rest
    early = F.col("scraped_at_utc") < F.lit(T0 + dt.timedelta(hours=5))
    old, new = (folds.interval_states(flags.where(c), bounds) for c in (early, ~early))
    both = folds.composed(old, new, folds.ROUTE, "state", folds.interval_then).join(bounds, folds.ROUTE)
    for r in both.select(*folds.ROUTE, folds.interval_after(F.col("state"), F.col("start")).alias("x"), "state.n").collect():
        assert abs(r.x - want[tuple(r[:3])][0]) < 1e-9 and r.n == want[tuple(r[:3])][1]


def replay(rows):
    """(t, m, e) in order -> last applied row and number of writes."""
    cur, writes = rows[0], 1
    for r in rows[1:]:
        if r[1] != cur[1] or cur[2] <= r[0]:
            cur, writes = r, writes + 1
    return (*cur, writes)


def test_replay_matches_python(spark):
    rng = random.Random(3)
    logs = {}
    for k in range(40):
        log = set()
        for _ in range(rng.choice([1, 2, 5, 60])):
            t = rng.randrange(200)
            log.add((t, rng.choice([None, 1, 2]), t + rng.choice([8, 24, 48, 0, -3])))
        logs[f"k{k}"] = sorted(log, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    at = lambda h: T0 + dt.timedelta(hours=h)
    rows = [(k, at(t), m, at(e)) for k, log in logs.items() for t, m, e in log]
    df = spark.createDataFrame(rows + rows[:30], "key string, scraped_at_utc timestamp_ntz, points int, expires_at_utc timestamp_ntz").repartition(5)
    want = {k: (at(w[0]), w[1], at(w[2]), w[3]) for k, log in logs.items() for w in [replay(log)]}
    for block in (0, 5, 256):
        rows = folds.merge_replay(df, ["key"], ["points"], order=["points"], block=block).collect()
        assert {r.key: (r.scraped_at_utc, r.points, r.expires_at_utc, r.writes) for r in rows} == want


def test_a_key_with_a_million_rows(spark):
    n = 1_000_000
    i = F.col("id")
    m = (F.floor(i / 37) % 5).cast("int")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id, 0)")
    log = spark.range(n).select(F.lit("hot").alias("key"), at.alias("scraped_at_utc"), m.alias("points"),
                                (at + F.expr("make_dt_interval(0, 8 + 16 * cast(id % 3 as int), 0, 0)")).alias("expires_at_utc"))
    r = folds.merge_replay(log, ["key"], ["points"], order=["points"]).collect()
    want = replay([(j, j // 37 % 5, j + 60 * (8 + 16 * (j % 3))) for j in range(n)])
    assert len(r) == 1 and (r[0].points, r[0].writes, r[0].scraped_at_utc) == (want[1], want[3], T0 + dt.timedelta(minutes=want[0]))

    route = {"origin": "A", "destination": "B", "airline": "C"}
    flags = spark.range(n).select(*[F.lit(v).alias(k) for k, v in route.items()], at.alias("scraped_at_utc"), (F.xxhash64("id") % 3 == 0).alias("changed"))
    bounds = spark.createDataFrame([(*route.values(), 8, 48, 6, 8.0)], "origin string, destination string, airline string, lo int, hi int, step int, start double")
    got = folds.interval_fold(flags, bounds).first()
    changes = np.array([x.changed for x in flags.orderBy("scraped_at_utc").select("changed").toLocalIterator()])
    assert got.scrapes == n and abs(got.interval_h - interval(changes, 8, 48, 6)) < 1e-9
