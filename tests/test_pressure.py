"""Run outcome under a time budget, with queue pressure."""

import datetime as dt

from pyspark.sql import functions as F

from milesbase.operators import reports

T = dt.datetime(2024, 1, 30)


def _runs(spark, rows):
    rows = [(run, seq, T + dt.timedelta(seconds=s), o, "ZZZ", out, n) for run, seq, s, o, out, n in rows]
    return spark.createDataFrame(rows, "run_id long, seq long, ts timestamp_ntz, origin string, dest string, outcome string, records int")


def _due(spark, *origins):
    return spark.createDataFrame([(o, "ZZZ", "DL") for o in origins], "origin string, dest string, airline string")


def test_stopped_early_and_fill_ratio(spark):
    runs = _runs(spark, [
        # run 1: B is begun in time and finished late, C is never begun
        (1, 1, 0, "A", "ok", 3), (1, 2, 50, "B", "ok", 2), (1, 3, 150, "B", "empty", 0), (1, 4, 160, "C", "error", 0),
        # run 2: a block ends the run before the budget does
        (2, 5, 0, "A", "ok", 1), (2, 6, 10, "B", "blocked", 0), (2, 7, 200, "C", "ok", 9),
        # run 3: all in time; one error, no progress
        (3, 8, 0, "Q", "error", 0),
        # run 4: the block lies behind the budget and never happens
        (4, 9, 0, "A", "ok", 4), (4, 10, 100, "B", "blocked", 0)])
    out = reports.run_pressure(runs, _due(spark, "A", "B", "C", "D", "E", "F", "G", "H"), 100, F.lit("DL"))
    got = {r["run_id"]: r.asDict() for r in out.collect()}
    pick = lambda i, *c: tuple(got[i][x] for x in c)
    assert pick(1, "status", "stopped_early", "blocked", "records", "errors", "routes_scraped") == ("partial", True, False, 5, 0, 2)
    assert pick(2, "status", "stopped_early", "blocked", "records", "routes_scraped") == ("blocked", False, True, 1, 1)
    assert pick(3, "status", "stopped_early", "errors") == ("failed", False, 1)
    assert pick(4, "status", "stopped_early", "blocked", "records") == ("partial", True, False, 4)
    cols = ("due_routes", "queue_selected_routes", "queue_left_due_estimate", "queue_fill_ratio")
    assert pick(1, *cols) == (8, 3, 5, 0.38)  # 0.375, half to even
    assert pick(3, *cols) == (8, 0, 8, 0.0)


def test_no_due_routes_gives_no_ratio(spark):
    out = reports.run_pressure(_runs(spark, [(1, 1, 0, "A", "ok", 3)]), _due(spark), 100, F.lit("DL")).collect()[0]
    assert (out["due_routes"], out["queue_fill_ratio"], out["status"]) == (0, None, "healthy")
