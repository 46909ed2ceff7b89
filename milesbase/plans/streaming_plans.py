"""Streaming plans: each lands its input as key-partitioned files, drains it with
an availableNow stream and returns the final table; the oracle is the batch result."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from milesbase.operators.numbering import stored
from milesbase.plans import domain as D
from milesbase.plans import queue_plans as QP
from milesbase.plans.registry import query
from milesbase.sources.fixtures import AS_OF
from milesbase.streaming import due, jobs


@query("str_merge", """
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, points_cost, cash_cost, stops,
 available_seats, dep_min, duration_minutes, scraped_at_utc, expires_at_utc, source FROM flights""", D.FLIGHTS_CTE)
def str_merge(spark, sf_dir):
    """Award observations streamed in micro-batches into the keyed table, partitioned by date; each reads and writes the
    dates it touches. Final state = batch merge."""
    L = D.lk(spark, sf_dir)
    base = jobs.job_dir(spark, "str_merge")
    batch = D.award_batch(L)
    jobs.land(batch, os.path.join(base, "landing"), ["date"])
    table = jobs.merge_stream(spark, os.path.join(base, "landing"), batch.schema, os.path.join(base, "table"),
                              os.path.join(base, "checkpoint"), D.AWARD_KEY, D.AWARD_MERGED, D.AWARD_STAMPS,
                              D.AWARD_ORDER, AS_OF, keep_cols=D.AWARD_KEEP, files_per_trigger=4, partition_by="date")
    return table.current().select(*D.AWARD_KEY, *D.AWARD_MATERIAL, *D.AWARD_STAMPS, "source")


@query("str_freshness", f"""
SELECT source, count(*) AS rows, max(scraped_at_utc) AS newest_scrape,
 count(*) FILTER (WHERE expires_at_utc > TIMESTAMP '{AS_OF}') AS unexpired_rows,
 round(epoch(TIMESTAMP '{AS_OF}' - max(scraped_at_utc)) / 3600.0, 1) AS newest_age_h
FROM award_batch GROUP BY source""", D.AWARD_BATCH_CTE)
def str_freshness(spark, sf_dir):
    """Per-source freshness as a stateful streaming aggregation over landed observations."""
    L = D.lk(spark, sf_dir)
    base = jobs.job_dir(spark, "str_freshness")
    batch = D.award_batch(L)
    jobs.land(batch, os.path.join(base, "landing"), D.AWARD_KEY)
    return jobs.freshness_stream(spark, os.path.join(base, "landing"), batch.schema, os.path.join(base, "out"),
                                 os.path.join(base, "checkpoint"), AS_OF)


def _route_events(L):
    """Scrape events (cheapest points per cabin) and block events per route, with cadence bounds."""
    sc = QP._scrapes(L)
    routes = sc.select("origin", "destination", "airline").distinct()
    scr = sc.select("origin", "destination", "airline", F.col("scraped_at_utc").alias("t"), F.lit(False).alias("blocked"),
                    "economy", "premium_economy", "business", "first")
    blocks = L.fx_attempt.filter(F.col("outcome") == "blocked").select("origin", F.col("dest").alias("destination"), F.col("ts").alias("t"))
    blk = routes.join(blocks, ["origin", "destination"]).select(
        "origin", "destination", "airline", "t", F.lit(True).alias("blocked"),
        *[F.lit(None).cast("int").alias(c) for c in ("economy", "premium_economy", "business", "first")])
    ev = scr.unionByName(blk)
    b = QP._bounds(L, routes).select("origin", "destination", "airline", "lo", "hi", "step")
    return ev.join(b, ["origin", "destination", "airline"])


@query("str_route_state", QP.MARK_SCRAPED_SQL, QP._SCRAPES_CTE)
def str_route_state(spark, sf_dir):
    """Route state (rate, interval, next scrape) kept by applyInPandasWithState; equals the batch
    fold when a key's events arrive in order (late rows go to a side table, never to state)."""
    L = D.lk(spark, sf_dir)
    base = jobs.job_dir(spark, "str_route_state")
    ev = _route_events(L).select(*[c.split(" ")[0] for c in jobs.EVENT_SCHEMA.split(", ")])
    jobs.land(ev, os.path.join(base, "landing"), jobs.ROUTE_KEY)
    return jobs.route_state_stream(spark, os.path.join(base, "landing"), os.path.join(base, "out"),
                                   os.path.join(base, "checkpoint"))


@query("str_due_events", """
WITH s AS (SELECT origin, destination, airline, date, scraped_at_utc, max(expires_at_utc) AS due_at_utc FROM award_batch GROUP BY ALL),
n AS (SELECT *, lead(scraped_at_utc) OVER (PARTITION BY origin, destination, airline, date ORDER BY scraped_at_utc) AS nxt,
 max(scraped_at_utc) OVER () AS seen FROM s)
SELECT origin, destination, airline, date, scraped_at_utc, due_at_utc FROM n WHERE due_at_utc <= nxt OR (nxt IS NULL AND due_at_utc <= seen)""",
       D.AWARD_BATCH_CTE)
def str_due_events(spark, sf_dir):
    """Travel dates of routes whose data expired without a newer scrape, reported by event-time timers; the scrapes land day by day, and the job is
    started again for each day."""
    base = jobs.job_dir(spark, "str_due_events")
    s = D.award_batch(D.lk(spark, sf_dir)).groupBy(*due.KEY, F.col("scraped_at_utc").alias("t")).agg(F.max("expires_at_utc").alias("due"))
    s = stored(s, "scrapes")
    days = [r["d"] for r in s.select(F.to_date("t").alias("d")).distinct().orderBy("d").collect()]  # one row per day landed
    out = None
    for day in days:
        due.land_slice(s.filter(F.to_date("t") == F.lit(day)), os.path.join(base, "landing"))
        out = due.due_events(spark, os.path.join(base, "landing"), os.path.join(base, "out"), os.path.join(base, "checkpoint"))
    return out
