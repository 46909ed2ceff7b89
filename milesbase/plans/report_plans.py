"""Reports, validation and first/last-wins plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import merge, quality, reports
from milesbase.plans import domain as D
from milesbase.plans.registry import query
from milesbase.sources.fixtures import AS_OF, AS_OF_DATE

_COV_SQL = """
WITH pr AS (SELECT origin, destination AS dest, source, count(*) AS flight_rows, count(DISTINCT date) AS dates_covered,
  count(DISTINCT cabin_class) AS cabins_seen, array_to_string(list_sort(list_distinct(list(cabin_class))), ',') AS cabin_list,
  min(date) AS first_date, max(date) AS last_date, max(scraped_at_utc) AS last_flight_scrape
  FROM flights WHERE date >= DATE '2024-01-31' GROUP BY origin, destination, source)
SELECT q.queue_id, q.origin, q.dest, q.airline, q.priority_tier, q.search_count, q.last_scraped_at_utc AS last_scraped_at,
 q.next_scrape_at_utc AS next_scrape_at, coalesce(pr.flight_rows, 0) AS flight_rows, coalesce(pr.dates_covered, 0) AS dates_covered,
 coalesce(pr.cabins_seen, 0) AS cabins_seen, pr.cabin_list, pr.first_date, pr.last_date, pr.last_flight_scrape
FROM queue q LEFT JOIN pr ON pr.origin = q.origin AND pr.dest = q.dest AND pr.source = q.source"""

_COV_COLS = ["queue_id", "origin", "dest", "airline", "priority_tier", "search_count", "last_scraped_at",
             "next_scrape_at", "flight_rows", "dates_covered", "cabins_seen", "cabin_list", "first_date",
             "last_date", "last_flight_scrape"]


def _coverage(spark, sf_dir):
    L = D.lk(spark, sf_dir)
    q = D.queue(L).withColumnRenamed("last_scraped_at_utc", "last_scraped_at") \
                  .withColumnRenamed("next_scrape_at_utc", "next_scrape_at")
    return reports.route_coverage(q, D.flights_table(L), AS_OF_DATE).select(*_COV_COLS)


@query("agg_route_coverage", _COV_SQL, D.FLIGHTS_CTE + "," + D.QUEUE_CTE)
def agg_route_coverage(spark, sf_dir):
    """Per queue row: future flights of its own provider, zero-data rows kept, cabin list sorted."""
    return _coverage(spark, sf_dir)


@query("top_gaps", f"""
SELECT * FROM ({_COV_SQL}) c ORDER BY flight_rows, CASE priority_tier WHEN 'HIGH' THEN 1 WHEN 'MED' THEN 2 ELSE 3 END, queue_id""", D.FLIGHTS_CTE + "," + D.QUEUE_CTE)
def top_gaps(spark, sf_dir):
    """All queue rows, worst covered first: fewest rows, then HIGH, MED, others."""
    c = _coverage(spark, sf_dir)
    return c.orderBy(F.col("flight_rows"), X.tier_rank("priority_tier"), F.col("queue_id"))


@query("jn_queue_flights", """
SELECT q.queue_id, f.date, f.cabin_class, f.airline AS flight_airline, f.raw_flight_number
FROM (SELECT * FROM queue QUALIFY row_number() OVER (PARTITION BY origin, dest, airline ORDER BY queue_id) = 1) q LEFT JOIN flights f ON f.origin = q.origin AND f.destination = q.dest AND f.date >= DATE '2024-01-31'
 AND f.source = q.source""", D.FLIGHTS_CTE + "," + D.QUEUE_CTE)
def jn_queue_flights(spark, sf_dir):
    """Keyed queue (origin, dest, airline) LEFT JOIN future flights with the source filter in ON: empty routes survive."""
    L = D.lk(spark, sf_dir)
    f = D.flights_table(L).filter(F.col("date") >= F.lit(AS_OF_DATE).cast("date")).select(
        "origin", F.col("destination").alias("dest"), "source", "date", "cabin_class",
        F.col("airline").alias("flight_airline"), "raw_flight_number")
    q = merge.first_per_key(D.queue(L), ["origin", "dest", "airline"], ["queue_id"])
    return q.select("queue_id", "origin", "dest", "source").join(f, ["origin", "dest", "source"], "left") \
        .select("queue_id", "date", "cabin_class", "flight_airline", "raw_flight_number")


@query("agg_cabin_distribution", """
SELECT source, cabin_class, count(*) AS rows, count(DISTINCT origin || '-' || destination) AS routes, count(DISTINCT date) AS dates
FROM flights WHERE date >= DATE '2024-01-31' GROUP BY source, cabin_class""", D.FLIGHTS_CTE)
def agg_cabin_distribution(spark, sf_dir):
    """Per source and cabin: rows, distinct routes and distinct dates of future-dated flights."""
    return reports.cabin_distribution(D.flights_table(D.lk(spark, sf_dir)), AS_OF_DATE)


@query("agg_freshness", """
SELECT source, count(*) AS rows, max(scraped_at_utc) AS newest_scrape,
 count(*) FILTER (WHERE expires_at_utc > TIMESTAMP '2024-01-31 00:00:00') AS unexpired_rows,
 round(epoch(TIMESTAMP '2024-01-31 00:00:00' - max(scraped_at_utc)) / 3600.0, 1) AS newest_age_h
FROM flights GROUP BY source""", D.FLIGHTS_CTE)
def agg_freshness(spark, sf_dir):
    """Per source: rows, newest scrape and its age in hours (1 dp), unexpired rows."""
    return reports.freshness(D.flights_table(D.lk(spark, sf_dir)), AS_OF)


@query("agg_cheapest_by_cabin", """
SELECT origin, destination, airline, scraped_at_utc,
 min(points_cost) FILTER (WHERE cabin_class = 'economy') AS economy,
 min(points_cost) FILTER (WHERE cabin_class = 'premium_economy') AS premium_economy,
 min(points_cost) FILTER (WHERE cabin_class = 'business') AS business,
 min(points_cost) FILTER (WHERE cabin_class = 'first') AS first
FROM award_batch WHERE points_cost IS NOT NULL GROUP BY origin, destination, airline, scraped_at_utc""", D.AWARD_BATCH_CTE)
def agg_cheapest_by_cabin(spark, sf_dir):
    """One scrape = (route, program carrier, scrape time)."""
    return reports.cheapest_by_cabin(D.award_batch(D.lk(spark, sf_dir)),
                                     ["origin", "destination", "airline", "scraped_at_utc"])


_RUN_CTE = """
rb AS (SELECT run_id, arg_min(origin, seq) AS b_origin, arg_min(dest, seq) AS b_dest, min(seq) AS b_seq FROM fx_attempt WHERE outcome = 'blocked' GROUP BY run_id),
ra AS (SELECT x.*, rb.b_seq, rb.b_origin, rb.b_dest FROM fx_attempt x LEFT JOIN rb USING (run_id) WHERE rb.b_seq IS NULL OR x.seq < rb.b_seq),
runs AS (SELECT run_id, count(*) FILTER (WHERE outcome = 'blocked') AS nb FROM fx_attempt GROUP BY run_id)"""


@query("agg_run_outcome", """
WITH pr AS (SELECT run_id, origin, dest, bool_and(NOT coalesce(b_seq IS NOT NULL AND origin = b_origin AND dest = b_dest, false)) AS counted,
  sum(records) AS records, count(*) FILTER (WHERE outcome = 'error') AS errors,
  count(*) FILTER (WHERE outcome IN ('ok', 'empty')) AS prog FROM ra GROUP BY run_id, origin, dest),
pru AS (SELECT run_id, sum(records) AS records, sum(errors) AS errors, count(*) FILTER (WHERE counted) AS routes_scraped,
  count(*) FILTER (WHERE counted AND prog > 0) AS routes_with_progress, count(*) FILTER (WHERE counted AND records = 0) AS routes_zero
  FROM pr GROUP BY run_id),
o AS (SELECT runs.run_id, runs.nb > 0 AS blocked, CAST(coalesce(records, 0) AS BIGINT) AS records, CAST(coalesce(errors, 0) AS BIGINT) AS errors,
  CAST(coalesce(routes_scraped, 0) AS BIGINT) AS routes_scraped, CAST(coalesce(routes_with_progress, 0) AS BIGINT) AS routes_with_progress,
  CAST(coalesce(routes_zero, 0) AS BIGINT) AS routes_zero FROM runs LEFT JOIN pru USING (run_id))
SELECT *, CASE WHEN blocked THEN 'blocked' WHEN errors > 0 AND routes_with_progress = 0 THEN 'failed'
 WHEN errors > 0 THEN 'partial' ELSE 'healthy' END AS status FROM o""", _RUN_CTE)
def agg_run_outcome(spark, sf_dir):
    """Run status truth table over the attempt log (run = user)."""
    return reports.run_outcome(D.lk(spark, sf_dir).fx_attempt)


RUN_BUDGET_S = 5 * 86_400  # the log's runs take weeks
_RUN_AIRLINE = {0: "AS", 1: "DL", 2: "B6", 3: "TK", 4: "EY"}
_RUN_AIRLINE_SQL = "CASE run_id % 6 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _RUN_AIRLINE.items()) + " ELSE 'WN' END"


@query("agg_run_pressure", f"""
WITH rt AS (SELECT run_id, origin, dest, min(ts) AS t, min(min(ts)) OVER (PARTITION BY run_id) AS t0 FROM fx_attempt GROUP BY run_id, origin, dest),
rr AS (SELECT *, epoch_us(t) - epoch_us(t0) < {RUN_BUDGET_S * 1_000_000} AS reached, {_RUN_AIRLINE_SQL} AS airline FROM rt),
att AS (SELECT x.* FROM fx_attempt x JOIN rr USING (run_id, origin, dest) WHERE reached),
bl AS (SELECT run_id, min(seq) AS b_seq, arg_min(origin, seq) AS bo, arg_min(dest, seq) AS bd FROM att WHERE outcome = 'blocked' GROUP BY run_id),
pr AS (SELECT att.run_id, origin, dest, bool_or(origin = bo AND dest = bd) IS TRUE AS is_blocked, sum(records) AS records,
  count(*) FILTER (WHERE outcome = 'error') AS errors, count(*) FILTER (WHERE outcome IN ('ok', 'empty')) AS prog
  FROM att LEFT JOIN bl ON bl.run_id = att.run_id WHERE b_seq IS NULL OR seq < b_seq GROUP BY att.run_id, origin, dest),
pu AS (SELECT run_id, sum(records) AS records, sum(errors) AS errors, count(*) FILTER (WHERE NOT is_blocked) AS routes_scraped,
  count(*) FILTER (WHERE NOT is_blocked AND prog > 0) AS routes_with_progress, count(*) FILTER (WHERE NOT is_blocked AND records = 0) AS routes_zero FROM pr GROUP BY run_id),
du AS (SELECT DISTINCT origin, dest, airline FROM fx_queue WHERE next_scrape_at_utc <= TIMESTAMP '{AS_OF}'),
dn AS (SELECT airline, count(*) AS due_routes FROM du GROUP BY airline),
gv AS (SELECT run_id, any_value(airline) AS airline, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM du WHERE du.origin = rr.origin AND du.dest = rr.dest AND du.airline = rr.airline)) AS queue_selected_routes,
  count(*) FILTER (WHERE NOT reached) AS left_n FROM rr GROUP BY run_id),
o AS (SELECT gv.run_id, gv.airline, bl.run_id IS NOT NULL AS blocked, left_n > 0 AND bl.run_id IS NULL AS stopped_early,
  CAST(coalesce(records, 0) AS BIGINT) AS records, CAST(coalesce(errors, 0) AS BIGINT) AS errors, coalesce(routes_scraped, 0) AS routes_scraped,
  coalesce(routes_with_progress, 0) AS routes_with_progress, coalesce(routes_zero, 0) AS routes_zero, coalesce(due_routes, 0) AS due_routes, queue_selected_routes
  FROM gv LEFT JOIN bl USING (run_id) LEFT JOIN pu USING (run_id) LEFT JOIN dn ON dn.airline = gv.airline)
SELECT *, CASE WHEN blocked THEN 'blocked' WHEN errors > 0 AND routes_with_progress = 0 THEN 'failed' WHEN errors > 0 OR stopped_early THEN 'partial' ELSE 'healthy' END AS status,
 greatest(due_routes - queue_selected_routes, 0) AS queue_left_due_estimate,
 CASE WHEN due_routes > 0 THEN round_even(queue_selected_routes / due_routes, 2) END AS queue_fill_ratio FROM o""")
def agg_run_pressure(spark, sf_dir):
    """agg_run_outcome under a time budget (stopped early) with queue pressure: due routes of the run's airline, those given to it,
    those left due, fill ratio."""
    L = D.lk(spark, sf_dir)
    due = L.fx_queue.filter(F.col("next_scrape_at_utc") <= F.lit(AS_OF).cast("timestamp_ntz")).select("origin", "dest", "airline").distinct()
    return reports.run_pressure(L.fx_attempt, due, RUN_BUDGET_S, X.case_map(F.pmod("run_id", F.lit(6)), _RUN_AIRLINE, "WN"))


@query("agg_cash_run", """
SELECT runs.run_id, CAST(coalesce(a.units, 0) AS BIGINT) AS units, CAST(coalesce(a.fares, 0) AS BIGINT) AS fares,
 CAST(coalesce(a.zero, 0) AS BIGINT) AS zero, CAST(coalesce(a.failed, 0) AS BIGINT) AS failed, runs.nb > 0 AS blocked
FROM runs LEFT JOIN (SELECT run_id, count(*) AS units, sum(records) AS fares, count(*) FILTER (WHERE outcome = 'empty') AS zero,
 count(*) FILTER (WHERE outcome = 'error') AS failed FROM ra GROUP BY run_id) a USING (run_id)""", _RUN_CTE)
def agg_cash_run(spark, sf_dir):
    """Per cash run: units attempted, fares, zero-yield and failed units, blocked flag (nothing after the first block)."""
    return reports.cash_run(D.lk(spark, sf_dir).fx_attempt)


# ------------------------------------------------------------------ validation
_REASON_SQL = """CASE WHEN NOT (length(origin) = 3 AND origin = upper(origin) AND origin <> lower(origin)) THEN 'invalid_origin'
  WHEN NOT (length(destination) = 3 AND destination = upper(destination) AND destination <> lower(destination)) THEN 'invalid_destination'
  WHEN origin = destination THEN 'same_route' WHEN DATE '2024-01-31' - date > 1 THEN 'date_past'
  WHEN DATE '2024-01-31' - date = 1 THEN 'date_rolled' WHEN points_cost <= 0 THEN 'points_nonpositive' END"""


@query("flt_validate", f"""
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, scraped_at_utc, points_cost, {_REASON_SQL} AS reject_reason
FROM fx_award""")
def flt_validate(spark, sf_dir):
    """Every award observation with its first failing rule (null = accepted)."""
    a = D.lk(spark, sf_dir).fx_award
    return quality.with_reject_reason(a, AS_OF_DATE).select(*D.AWARD_KEY, "scraped_at_utc", "points_cost", "reject_reason")


@query("agg_reject_summary", f"""
SELECT airline, count(*) AS total, count(*) FILTER (WHERE ({_REASON_SQL}) IS NOT NULL) AS dropped,
 count(*) FILTER (WHERE DATE '2024-01-31' - date = 1) AS rolled,
 (count(*) FILTER (WHERE ({_REASON_SQL}) IS NOT NULL) > 0 AND count(*) FILTER (WHERE DATE '2024-01-31' - date = 1) = count(*) FILTER (WHERE ({_REASON_SQL}) IS NOT NULL)) AS housekeeping_only
FROM fx_award GROUP BY airline""")
def agg_reject_summary(spark, sf_dir):
    """Per airline: rows, rejected rows, rolled-over dates and the housekeeping-only flag."""
    return quality.reject_summary(D.lk(spark, sf_dir).fx_award, AS_OF_DATE, by=["airline"])


@query("flt_record_invariants", """
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, scraped_at_utc,
 CASE WHEN length(origin) <> 3 THEN 'bad_origin' WHEN length(destination) <> 3 THEN 'bad_destination'
  WHEN coalesce(length(source), 0) = 0 THEN 'no_source' WHEN points_cost <= 0 THEN 'points_nonpositive'
  WHEN cabin_class NOT IN ('economy', 'premium_economy', 'business', 'first') THEN 'bad_cabin'
  WHEN expires_at_utc <= scraped_at_utc THEN 'expiry_not_after_scrape' END AS reject_reason
FROM (SELECT *, scraped_at_utc + INTERVAL '1' HOUR * CASE tier WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 ELSE 48 END AS expires_at_utc,
  CASE airline WHEN 'AS' THEN 'alaska' WHEN 'DL' THEN 'delta' WHEN 'B6' THEN 'jetblue' WHEN 'TK' THEN 'turkish' WHEN 'EY' THEN 'etihad' WHEN 'WN' THEN 'southwest' END AS source
  FROM fx_award) a""")
def flt_record_invariants(spark, sf_dir):
    """Constructor invariants of an award record, as a reject reason per row."""
    a = D.lk(spark, sf_dir).fx_award
    a = a.withColumn("expires_at_utc", X.expiry()).withColumn("source", X.case_map("airline", D.AIRLINE_SOURCE))
    return quality.check_invariants(a, quality.award_invariant_rules()).select(
        *D.AWARD_KEY, "scraped_at_utc", "reject_reason")


@query("flt_cash_invariants", """
SELECT origin, destination, date, airline, cabin_class, flight_number, scraped_at_utc,
 CASE WHEN coalesce(length(origin) <> 3 OR length(destination) <> 3, true) THEN 'bad_iata' WHEN coalesce(flight_number, '') = '' THEN 'no_flight_number'
  WHEN cash_price IS NULL OR cash_price <= 0 THEN 'price_nonpositive'
  WHEN coalesce(cabin_class NOT IN ('economy', 'premium_economy', 'business', 'first'), true) THEN 'bad_cabin'
  WHEN coalesce(expires_at_utc <= scraped_at_utc, true) THEN 'expiry_not_after_scrape' END AS reject_reason
FROM fx_cash""")
def flt_cash_invariants(spark, sf_dir):
    """Constructor invariants of a cash record, as a reject reason per row (every fixture fare has the default source)."""
    c = D.lk(spark, sf_dir).fx_cash.withColumn("source", F.lit(D.CASH_SOURCE))
    return quality.check_invariants(c, quality.cash_invariant_rules()).select(*D.CASH_KEY, "scraped_at_utc", "reject_reason")


@query("flt_check_constraints", """
SELECT 'flights' AS table_name, 'points_positive' AS constraint_name, count(*) FILTER (WHERE NOT (points_cost > 0)) AS violations FROM fx_award
UNION ALL SELECT 'flights', 'cabin_enum', count(*) FILTER (WHERE cabin_class NOT IN ('economy', 'premium_economy', 'business', 'first')) FROM fx_award
UNION ALL SELECT 'cash_fares', 'cash_positive', count(*) FILTER (WHERE NOT (cash_price > 0)) FROM fx_cash
UNION ALL SELECT 'transfer_bonuses', 'bonus_positive', count(*) FILTER (WHERE NOT (bonus_pct > 0)) FROM fx_bonus
UNION ALL SELECT 'transfer_bonuses', 'bonus_interval', count(*) FILTER (WHERE ends_at < starts_at) FROM fx_bonus""")
def flt_check_constraints(spark, sf_dir):
    """Violations of each table CHECK (points > 0, cabin enum, cash > 0, bonus > 0, interval order)."""
    L = D.lk(spark, sf_dir)
    return reports.check_constraint_violations(L.fx_award, L.fx_cash, L.fx_bonus)


@query("flt_changed", """
SELECT b.origin, b.destination, b.date, b.airline, b.cabin_class, b.raw_flight_number, b.scraped_at_utc,
 (b.points_cost IS DISTINCT FROM f.points_cost OR b.cash_cost IS DISTINCT FROM f.cash_cost OR b.stops IS DISTINCT FROM f.stops
  OR b.available_seats IS DISTINCT FROM f.available_seats OR b.dep_min IS DISTINCT FROM f.dep_min
  OR b.duration_minutes IS DISTINCT FROM f.duration_minutes) AS changed
FROM award_batch b JOIN flights f USING (origin, destination, date, airline, cabin_class, raw_flight_number)""", D.FLIGHTS_CTE)
def flt_changed(spark, sf_dir):
    """Each observation vs the stored row: NULL-safe difference over the material columns only."""
    L = D.lk(spark, sf_dir)
    b = D.award_batch(L).select(*D.AWARD_KEY, "scraped_at_utc", *[F.col(c).alias(f"n_{c}") for c in D.AWARD_MATERIAL])
    f = D.flights_table(L).select(*D.AWARD_KEY, *[F.col(c).alias(f"o_{c}") for c in D.AWARD_MATERIAL])
    return b.join(f, D.AWARD_KEY).select(*D.AWARD_KEY, "scraped_at_utc",
                                         X.changed("n_", "o_", D.AWARD_MATERIAL).alias("changed"))


# ------------------------------------------------------------------ first / last wins, retention
_MAT = ", ".join(D.AWARD_MATERIAL)
_ORD = "scraped_at_utc, points_cost, cash_cost, stops, available_seats, dep_min, duration_minutes, tier"


@query("win_first_wins", f"""
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, {_MAT}, scraped_at_utc FROM award_batch
QUALIFY row_number() OVER (PARTITION BY origin, destination, date, airline, cabin_class, raw_flight_number ORDER BY {_ORD}) = 1""",
       D.AWARD_BATCH_CTE)
def win_first_wins(spark, sf_dir):
    """First observation per key in arrival order (min_by, partial-aggregated)."""
    b = D.award_batch(D.lk(spark, sf_dir))
    return merge.first_per_key(b, D.AWARD_KEY, D.AWARD_ORDER, D.AWARD_MATERIAL + ["scraped_at_utc"])


@query("win_last_wins", f"""
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, {_MAT}, scraped_at_utc FROM award_batch
QUALIFY row_number() OVER (PARTITION BY origin, destination, date, airline, cabin_class, raw_flight_number ORDER BY scraped_at_utc DESC, points_cost DESC, cash_cost DESC, stops DESC, available_seats DESC, dep_min DESC, duration_minutes DESC, tier DESC) = 1""",
       D.AWARD_BATCH_CTE)
def win_last_wins(spark, sf_dir):
    """Last observation per key (max_by); the run-start stamp form is snk_flights_merge."""
    b = D.award_batch(D.lk(spark, sf_dir))
    return merge.latest_per_key(b, D.AWARD_KEY, D.AWARD_ORDER, D.AWARD_MATERIAL + ["scraped_at_utc"])


def _retained(df):
    return df.filter(F.col("date") >= F.date_sub(F.lit(AS_OF_DATE).cast("date"), 1))


@query("snk_retention", """
SELECT * FROM fx_cash WHERE date >= DATE '2024-01-30'""")
def snk_retention(spark, sf_dir):
    """Keep rows dated yesterday (UTC, relative to as_of) or later."""
    return _retained(D.lk(spark, sf_dir).fx_cash)


@query("snk_retention_flights", """
SELECT * FROM fx_award WHERE date >= DATE '2024-01-30'""")
def snk_retention_flights(spark, sf_dir):
    """The flights half of snk_retention, over award rows of any date (the merged table holds none that is past)."""
    return _retained(D.lk(spark, sf_dir).fx_award)


@query("agg_coverage_merged", """
SELECT origin, destination, source, count(*) AS flight_rows, count(DISTINCT date) AS dates_covered, count(DISTINCT cabin_class) AS cabins_seen,
 array_to_string(list_sort(list_distinct(list(cabin_class))), ',') AS cabin_list, min(date) AS first_date, max(date) AS last_date,
 max(scraped_at_utc) AS last_flight_scrape
FROM flights GROUP BY origin, destination, source""", D.FLIGHTS_CTE)
def agg_coverage_merged(spark, sf_dir):
    """Route coverage from mergeable states: those of the rows stored earlier and those of later rows, put together without a second
    look at rows; equals the full recount."""
    f = D.flights_table(D.lk(spark, sf_dir))
    early = F.col("scraped_at_utc") < F.lit(D.STORED_BEFORE).cast("timestamp_ntz")
    return reports.coverage_of(reports.merged_states(reports.coverage_states(f.filter(early)), reports.coverage_states(f.filter(~early))))


@query("agg_freshness_series", """
WITH o AS (SELECT source, scraped_at_utc AS s, expires_at_utc AS e FROM award_batch),
up AS (SELECT *, to_timestamp(ceil(epoch(s) / 3600.0) * 3600)::TIMESTAMP AS su, to_timestamp(ceil(epoch(e) / 3600.0) * 3600)::TIMESTAMP AS eu FROM o),
steps AS (SELECT DISTINCT source, su AS at_utc FROM up UNION SELECT DISTINCT source, eu FROM up)
SELECT t.source, t.at_utc, count(*) AS rows, count(*) FILTER (WHERE e > t.at_utc) AS unexpired_rows,
 round(epoch(t.at_utc - max(s)) / 3600.0, 1) AS newest_age_h
FROM steps t JOIN up ON up.source = t.source AND up.s <= t.at_utc GROUP BY t.source, t.at_utc""", D.AWARD_BATCH_CTE)
def agg_freshness_series(spark, sf_dir):
    """Freshness of each source at every hour in which something was seen or expired, by an expiry sweep."""
    return reports.freshness_series(D.award_batch(D.lk(spark, sf_dir)))
