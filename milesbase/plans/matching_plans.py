"""Cash matching and cash work-queue plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import cash_queue as CQ
from milesbase.operators import matching, merge, text_parse
from milesbase.plans import domain as D
from milesbase.plans.registry import query
from milesbase.sources.dims import CABINS, CASH_TTL_HOURS
from milesbase.sources.dims import METROS
from milesbase.sources.fixtures import AS_OF, AS_OF_DATE

_FARES_CTE = D.FLIGHTS_CTE + """,
fares AS (SELECT *, CASE carrier WHEN 'Alaska' THEN 'AS' WHEN 'Delta' THEN 'DL' WHEN 'JetBlue' THEN 'B6' WHEN 'Turkish Airlines' THEN 'TK'
  WHEN 'Etihad' THEN 'EY' WHEN 'Southwest' THEN 'WN' END AS airline FROM fx_fare),
cand AS (SELECT origin, destination, date, cabin_class, airline, raw_flight_number AS flight_number, dep_min AS award_min FROM flights
  WHERE stops = 0 AND raw_flight_number IS NOT NULL AND raw_flight_number <> 'UNKNOWN' AND dep_min IS NOT NULL
  AND expires_at_utc > TIMESTAMP '2024-01-31 00:00:00' AND origin IN (SELECT iata FROM dim_airport WHERE tz IS NOT NULL)),
pairs AS (SELECT fa.fare_id, fa.origin, fa.destination, fa.date, fa.cabin_class, fa.airline, fa.price, c.flight_number,
  abs(c.award_min - fa.dep_min) AS dist FROM fares fa JOIN cand c ON c.origin = fa.origin AND c.destination = fa.destination
  AND c.date = fa.date AND c.cabin_class = fa.cabin_class AND c.airline = fa.airline AND abs(c.award_min - fa.dep_min) <= 10
  WHERE fa.nonstop AND fa.airline IS NOT NULL),
nearest AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY fare_id ORDER BY dist, flight_number) = 1),
per_flight AS (SELECT origin, destination, date, airline, cabin_class, flight_number, price AS cash_price FROM nearest
  QUALIFY row_number() OVER (PARTITION BY origin, destination, date, cabin_class, flight_number ORDER BY price, fare_id) = 1),
anchor AS (SELECT origin, destination, date, '__OD__' AS airline, cabin_class, '__OD__' AS flight_number, min(price) AS cash_price
  FROM fx_fare GROUP BY origin, destination, date, cabin_class),
fare_batch AS (SELECT *, 'USD' AS currency, 'meta_search' AS source, TIMESTAMP '2024-01-31 00:00:00' AS scraped_at_utc,
  TIMESTAMP '2024-01-31 00:00:00' + INTERVAL 72 HOUR AS expires_at_utc FROM (SELECT * FROM per_flight UNION ALL SELECT * FROM anchor) u)"""


def _candidates(L):
    return matching.match_candidates(D.flights_table(L), L.dim_airport, AS_OF)


@query("jn_nearest_fare", """
SELECT fare_id, origin, destination, date, cabin_class, airline, flight_number, price FROM nearest""", _FARES_CTE)
def jn_nearest_fare(spark, sf_dir):
    """Every nonstop mapped fare -> nearest award flight within 10 min (bucketed band join)."""
    L = D.lk(spark, sf_dir)
    return matching.nearest_fares(L.fx_fare, _candidates(L))


@query("agg_od_anchor", """SELECT * FROM anchor""", _FARES_CTE)
def agg_od_anchor(spark, sf_dir):
    """Cheapest price over all fares of a (route, date, cabin) unit as the __OD__ anchor row."""
    return matching.od_anchor(D.lk(spark, sf_dir).fx_fare)


@query("set_fare_union", """SELECT * FROM fare_batch""", _FARES_CTE)
def set_fare_union(spark, sf_dir):
    """Cheapest matched fare per flight plus O&D anchors, stamped at as_of with the cash TTL."""
    L = D.lk(spark, sf_dir)
    return matching.fare_batch(L.fx_fare, _candidates(L), AS_OF, CASH_TTL_HOURS)


@query("snk_cash_merge", """
WITH cur AS (SELECT *, 'USD' AS currency, 'meta_search' AS source FROM fx_cash)
SELECT origin, destination, date, airline, cabin_class, flight_number,
 CASE WHEN b.origin IS NULL THEN c.cash_price ELSE b.cash_price END AS cash_price,
 CASE WHEN b.origin IS NULL THEN c.currency ELSE b.currency END AS currency,
 CASE WHEN b.origin IS NULL THEN c.source ELSE b.source END AS source,
 CASE WHEN b.origin IS NULL THEN c.scraped_at_utc WHEN c.origin IS NULL THEN b.scraped_at_utc
  WHEN c.cash_price IS NOT DISTINCT FROM b.cash_price AND c.currency IS NOT DISTINCT FROM b.currency AND c.source IS NOT DISTINCT FROM b.source
   AND c.expires_at_utc > TIMESTAMP '2024-01-31 00:00:00' THEN c.scraped_at_utc ELSE b.scraped_at_utc END AS scraped_at_utc,
 CASE WHEN b.origin IS NULL THEN c.expires_at_utc WHEN c.origin IS NULL THEN b.expires_at_utc
  WHEN c.cash_price IS NOT DISTINCT FROM b.cash_price AND c.currency IS NOT DISTINCT FROM b.currency AND c.source IS NOT DISTINCT FROM b.source
   AND c.expires_at_utc > TIMESTAMP '2024-01-31 00:00:00' THEN c.expires_at_utc ELSE b.expires_at_utc END AS expires_at_utc
FROM cur c FULL OUTER JOIN fare_batch b USING (origin, destination, date, airline, cabin_class, flight_number)""", _FARES_CTE)
def snk_cash_merge(spark, sf_dir):
    """Upsert the new fare batch into the cash table: material = price, currency, source."""
    L = D.lk(spark, sf_dir)
    cur = L.fx_cash.withColumn("currency", F.lit("USD")).withColumn("source", F.lit("meta_search"))
    batch = matching.fare_batch(L.fx_fare, _candidates(L), AS_OF, CASH_TTL_HOURS)
    return merge.conditional_merge(cur, batch, D.CASH_KEY, ["cash_price", "currency", "source"],
                                   ["scraped_at_utc", "expires_at_utc"], ["scraped_at_utc"], AS_OF)


# ------------------------------------------------------------------ cash work queue
_UNITS_SQL = """SELECT DISTINCT origin, destination, date, cabin_class FROM flights
 WHERE stops = 0 AND expires_at_utc > TIMESTAMP '2024-01-31 00:00:00' AND raw_flight_number IS NOT NULL
 AND raw_flight_number <> 'UNKNOWN' AND date BETWEEN DATE '2024-01-31' AND DATE '2024-01-31' + 30"""
_QUEUE_CTES = D.FLIGHTS_CTE + "," + D.CASH_ATTEMPTS_CTE + f""",
units AS ({_UNITS_SQL}),
demand AS (SELECT origin, dest, sum(decayed_demand) AS demand FROM fx_queue GROUP BY origin, dest),
elig AS (SELECT u.* FROM units u WHERE NOT EXISTS (SELECT 1 FROM fx_cash c WHERE c.origin = u.origin AND c.destination = u.destination
  AND c.date = u.date AND c.cabin_class = u.cabin_class AND c.scraped_at_utc > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR)
  AND NOT EXISTS (SELECT 1 FROM coverage cc WHERE cc.origin = u.origin AND cc.destination = u.destination AND cc.date = u.date
  AND cc.cabin = u.cabin_class AND cc.fare_count = 0 AND cc.next_probe_utc > TIMESTAMP '2024-01-31 00:00:00'))"""


def _units(L):
    return CQ.distinct_units(D.flights_table(L), AS_OF, AS_OF_DATE, cabins=CABINS)


@query("set_distinct_units", _UNITS_SQL, D.FLIGHTS_CTE)
def set_distinct_units(spark, sf_dir):
    """Distinct (route, date, cabin) units with nonstop, unexpired, real-flight rows in the next 30 days."""
    return _units(D.lk(spark, sf_dir))


@query("agg_demand_sum", "SELECT * FROM demand", _QUEUE_CTES)
def agg_demand_sum(spark, sf_dir):
    """Decayed demand per route summed over airlines."""
    return CQ.demand_sum(D.lk(spark, sf_dir).fx_queue)


@query("snk_negative_memory", "SELECT * FROM coverage", _QUEUE_CTES)
def snk_negative_memory(spark, sf_dir):
    """Cash coverage memory: last attempt per unit; zero yield defers the next probe 3 days."""
    return CQ.negative_memory(D.cash_attempts(D.lk(spark, sf_dir)))


@query("jn_anti_fresh_cash", """
SELECT u.* FROM units u WHERE NOT EXISTS (SELECT 1 FROM fx_cash c WHERE c.origin = u.origin AND c.destination = u.destination
  AND c.date = u.date AND c.cabin_class = u.cabin_class AND c.scraped_at_utc > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR)""",
       _QUEUE_CTES)
def jn_anti_fresh_cash(spark, sf_dir):
    """Cash units without a fare scraped within the cash TTL (left anti join; anchors count)."""
    L = D.lk(spark, sf_dir)
    ts = F.lit(AS_OF).cast("timestamp_ntz")
    fresh = L.fx_cash.filter(F.col("scraped_at_utc") > ts - X.hours(F.lit(CASH_TTL_HOURS))).select(*CQ.UNIT)
    return _units(L).join(fresh, CQ.UNIT, "left_anti")


@query("jn_anti_zero_memory", "SELECT * FROM elig", _QUEUE_CTES)
def jn_anti_zero_memory(spark, sf_dir):
    """Units without fresh cash AND without a zero-yield memory that is not yet due."""
    L = D.lk(spark, sf_dir)
    cov = CQ.negative_memory(D.cash_attempts(L))
    return CQ.eligible_units(_units(L), L.fx_cash, cov, AS_OF, CASH_TTL_HOURS)


@query("jn_demand_coverage", """
SELECT e.*, d.demand, cc.last_attempt_utc FROM elig e LEFT JOIN demand d ON d.origin = e.origin AND d.dest = e.destination
LEFT JOIN coverage cc ON cc.origin = e.origin AND cc.destination = e.destination AND cc.date = e.date AND cc.cabin = e.cabin_class""",
       _QUEUE_CTES)
def jn_demand_coverage(spark, sf_dir):
    """Eligible units LEFT JOIN route demand LEFT JOIN coverage memory."""
    L = D.lk(spark, sf_dir)
    cov = CQ.negative_memory(D.cash_attempts(L))
    e = CQ.eligible_units(_units(L), L.fx_cash, cov, AS_OF, CASH_TTL_HOURS)
    return CQ.with_demand_coverage(e, CQ.demand_sum(L.fx_queue), cov)


_PINNED_SQL = f"""WITH m(token, airport) AS (VALUES {", ".join(f"('{k}', '{a}')" for k, v in METROS.items() for a in v)}),
 p(o, d) AS (VALUES {", ".join(f"('{o}', '{d}')" for o, d in CQ.CASH_PINNED_ROUTES)}),
 x AS (SELECT coalesce(mo.airport, o) AS o, coalesce(md.airport, d) AS d FROM p LEFT JOIN m mo ON mo.token = o LEFT JOIN m md ON md.token = d)
 SELECT o || '-' || d FROM x WHERE o <> d UNION SELECT d || '-' || o FROM x WHERE o <> d"""
_SHARD_SQL = "CAST('0x' || substr(md5(origin || '-' || destination), 1, 15) AS BIGINT) % 4"


@query("top_cash_units", f"""
SELECT * FROM (SELECT {_SHARD_SQL} AS shard,
 row_number() OVER (PARTITION BY {_SHARD_SQL} ORDER BY CASE WHEN origin || '-' || destination IN ({_PINNED_SQL}) THEN 0 ELSE 1 END,
  coalesce(last_attempt_utc, TIMESTAMP '1970-01-01 00:00:00'), coalesce(demand, 0) DESC, date, origin, destination, cabin_class) AS rank,
 origin, destination, date, cabin_class
 FROM (SELECT e.*, d.demand, cc.last_attempt_utc FROM elig e LEFT JOIN demand d ON d.origin = e.origin AND d.dest = e.destination
  LEFT JOIN coverage cc ON cc.origin = e.origin AND cc.destination = e.destination AND cc.date = e.date AND cc.cabin = e.cabin_class) x)
WHERE rank <= 200""", _QUEUE_CTES)
def top_cash_units(spark, sf_dir):
    """Top 200 units of each of 4 shards, all shards in one plan."""
    L = D.lk(spark, sf_dir)
    cov = CQ.negative_memory(D.cash_attempts(L))
    e = CQ.eligible_units(_units(L), L.fx_cash, cov, AS_OF, CASH_TTL_HOURS)
    u = CQ.with_demand_coverage(e, CQ.demand_sum(L.fx_queue), cov)
    return CQ.rank_cash_units(u, CQ.pinned_keys(spark), 4, 200)


@query("set_pinned_keys", f"""
SELECT DISTINCT origin, destination, origin || '-' || destination IN ({_PINNED_SQL}) AS pinned FROM flights""", D.FLIGHTS_CTE)
def set_pinned_keys(spark, sf_dir):
    """Every served route flagged by the pinned set (pairs and their reverses)."""
    L = D.lk(spark, sf_dir)
    r = D.flights_table(L).select("origin", "destination").distinct().withColumn("route_key", CQ.route_key())
    p = F.broadcast(CQ.pinned_keys(spark).withColumn("pinned", F.lit(True)))
    return r.join(p, "route_key", "left").select("origin", "destination", F.coalesce("pinned", F.lit(False)).alias("pinned"))


@query("fn_route_key", """SELECT DISTINCT origin, destination, origin || '-' || destination AS route_key FROM flights""",
       D.FLIGHTS_CTE)
def fn_route_key(spark, sf_dir):
    """Route key 'O-D' for every served route."""
    return D.flights_table(D.lk(spark, sf_dir)).select("origin", "destination").distinct().withColumn("route_key", CQ.route_key())


@query("fn_shard", f"""SELECT DISTINCT origin, destination, {_SHARD_SQL} AS shard FROM flights""", D.FLIGHTS_CTE)
def fn_shard(spark, sf_dir):
    """Route -> shard of 4 (md5 prefix); every route lands on exactly one shard."""
    r = D.flights_table(D.lk(spark, sf_dir)).select("origin", "destination").distinct()
    return r.withColumn("shard", CQ.shard_of(CQ.route_key(), 4))


# ------------------------------------------------------------------ zones and clock text
@query("jn_airport_tz", """
SELECT f.origin, f.destination, f.date, f.airline, f.cabin_class, f.raw_flight_number, a.tz
FROM flights f JOIN dim_airport a ON a.iata = f.origin WHERE a.tz IS NOT NULL""", D.FLIGHTS_CTE)
def jn_airport_tz(spark, sf_dir):
    """Attach the origin's zone (broadcast dimension); unmapped origins drop out."""
    L = D.lk(spark, sf_dir)
    z = F.broadcast(L.dim_airport.filter(F.col("tz").isNotNull()).select(F.col("iata").alias("origin"), "tz"))
    return D.flights_table(L).join(z, "origin").select(*D.AWARD_KEY, "tz")


_LOCAL_SQL = "CAST(f.date AS TIMESTAMP) + INTERVAL 1 MINUTE * f.dep_min"


def _local_instants(L):
    z = F.broadcast(L.dim_airport.filter(F.col("tz").isNotNull()).select(F.col("iata").alias("origin"), "tz"))
    f = D.flights_table(L).join(z, "origin")
    local = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("dep_min"))
    return f.withColumn("dep_local", local).withColumn(
        "dep_utc", F.convert_timezone(F.col("tz"), F.lit("UTC"), F.col("dep_local")))


@query("fn_local_to_instant", f"""
SELECT f.origin, f.destination, f.date, f.airline, f.cabin_class, f.raw_flight_number,
 {_LOCAL_SQL} - INTERVAL 1 MINUTE * a.off_min AS dep_utc
FROM flights f JOIN dim_airport a ON a.iata = f.origin WHERE a.tz IS NOT NULL""", D.FLIGHTS_CTE)
def fn_local_to_instant(spark, sf_dir):
    """Origin-local wall clock + airport zone -> UTC instant (naive UTC)."""
    return _local_instants(D.lk(spark, sf_dir)).select(*D.AWARD_KEY, "dep_utc")


@query("fn_instant_to_hhmm", f"""
SELECT f.origin, f.destination, f.date, f.airline, f.cabin_class, f.raw_flight_number,
 strftime({_LOCAL_SQL}, '%H:%M') AS dep_hhmm, f.dep_min AS dep_minutes
FROM flights f JOIN dim_airport a ON a.iata = f.origin WHERE a.tz IS NOT NULL""", D.FLIGHTS_CTE)
def fn_instant_to_hhmm(spark, sf_dir):
    """Instant -> origin-local 'HH:MM' (and back to minutes: fn_hhmm_minutes)."""
    f = _local_instants(D.lk(spark, sf_dir))
    hhmm = F.date_format(F.convert_timezone(F.lit("UTC"), F.col("tz"), F.col("dep_utc")), "HH:mm")
    return f.select(*D.AWARD_KEY, hhmm.alias("dep_hhmm"), text_parse.hhmm_minutes(hhmm).alias("dep_minutes"))


# ------------------------------------------------------------------ cash list labels
def _labels(L):
    """Accessibility labels as the fare list renders them, plus a bare price chip per fare."""
    f = L.fx_fare
    h, m = X.idiv("dep_min", F.lit(60)), F.pmod(F.col("dep_min"), F.lit(60))
    h12 = F.pmod(h + 11, F.lit(12)) + 1
    ampm = F.when(h >= 12, "PM").otherwise("AM")
    stops = F.when(F.col("nonstop"), F.lit("Nonstop")).otherwise(F.lit("1 stop"))
    label = F.concat(F.lit("From "), F.format_number(F.col("price").cast("double"), 0), F.lit(" US dollars. "),
                     stops, F.lit(" flight with "), F.col("carrier"), F.lit(". Leaves "), F.col("origin"),
                     F.lit(" at "), h12.cast("string"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"), F.lit(" "), ampm,
                     F.lit(" on "), F.date_format("date", "EEEE, MMMM d"), F.lit("."))
    chip = F.concat(F.format_number(F.col("price").cast("double"), 0), F.lit(" US dollars"))
    return f.select("fare_id", F.explode(F.array(label, chip)).alias("label"))


@query("nrm_fare_labels", """
SELECT fare_id, carrier, lpad(CAST(dep_min // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(dep_min % 60 AS VARCHAR), 2, '0') AS dep_hhmm,
 CAST(price AS DOUBLE) AS price, nonstop FROM fx_fare""")
def nrm_fare_labels(spark, sf_dir):
    """Parse fare-list labels (price, stops + carrier, 12-hour departure); chips are dropped."""
    return text_parse.parse_fare_labels(_labels(D.lk(spark, sf_dir)))
