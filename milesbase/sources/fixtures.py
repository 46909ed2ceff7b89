"""Derived domain views over the driver tables (FIXTURES.md section C).

The SQL texts are fixed values: they define the test domain (awards, fares,
queue, ...) as functions of the TPC-H-ish tables, and run unchanged on Spark and
DuckDB. ``{name}`` marks a relation: on Spark it is bound to a DataFrame through
``spark.sql(text, name=df)`` (no global temp views, so several scale factors can
live in one session); for DuckDB the braces are dropped and the views are
inlined as CTEs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from milesbase.sources.tables import TABLES, read_table

AS_OF = "2024-01-31 00:00:00"
AS_OF_DATE = "2024-01-31"

# --- fixed values: fixture definitions (FIXTURES.md C), in dependency order ---
FIXTURE_SQL: dict[str, str] = {
    "dim_airport": """
SELECT * FROM (VALUES (0, 'SEA', 'America/Los_Angeles', -480), (1, 'JFK', 'America/New_York', -300), (2, 'LAX', 'America/Los_Angeles', -480), (3, 'BOS', 'America/New_York', -300), (4, 'ORD', 'America/Chicago', -360), (5, 'DEN', 'America/Denver', -420), (6, 'ATL', 'America/New_York', -300), (7, 'SFO', 'America/Los_Angeles', -480), (8, 'IST', 'Europe/Istanbul', 180), (9, 'AUH', 'Asia/Dubai', 240), (10, 'LHR', 'Europe/London', 0), (11, 'CDG', 'Europe/Paris', 60), (12, 'HND', 'Asia/Tokyo', 540), (13, 'SYD', 'Australia/Sydney', 660), (14, 'ANC', 'America/Anchorage', -540), (15, 'HNL', 'Pacific/Honolulu', -600), (16, 'PHX', 'America/Phoenix', -420), (17, 'DFW', 'America/Chicago', -360), (18, 'MIA', 'America/New_York', -300), (19, 'ICN', 'Asia/Seoul', 540), (20, 'AMS', 'Europe/Amsterdam', 60), (21, 'DUB', 'Europe/Dublin', 0), (22, 'PDX', 'America/Los_Angeles', -480), (23, 'MSP', 'America/Chicago', -360), (24, 'XXX', CAST(NULL AS STRING), CAST(NULL AS INT))) AS t(idx, iata, tz, off_min)
""",
    "fx_award": """
SELECT o.iata AS origin, d.iata AS destination, DATE '2024-01-28' + CAST(x.l_orderkey % 40 AS INT) AS date,
 CASE x.fn % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END AS airline, CAST(x.pts AS INT) AS points_cost, CAST(x.l_tax AS DECIMAL(8,2)) AS cash_cost,
 CAST(CASE WHEN x.fn % 5 = 0 THEN 1 ELSE 0 END AS INT) AS stops,
 CASE x.l_linenumber % 4 WHEN 0 THEN 'economy' WHEN 1 THEN 'business' WHEN 2 THEN 'premium_economy' ELSE 'first' END AS cabin_class,
 CASE WHEN x.l_returnflag = 'N' THEN -1 ELSE CAST(x.l_quantity AS INT) % 9 + 1 END AS available_seats,
 CASE WHEN x.fn = 11 THEN 'UNKNOWN' ELSE concat(CASE x.fn % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END, ' ', CAST(100 + x.fn AS STRING)) END AS raw_flight_number,
 TIMESTAMP_NTZ '2024-01-30 23:00:00' - INTERVAL '1' HOUR * CAST((x.l_orderkey * 7 + x.l_partkey * 13 + x.l_linenumber) % 96 AS INT) AS scraped_at_utc,
 CASE x.r % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MED' ELSE 'LOW' END AS tier,
 CAST((x.fn * 97 + x.r * 31) % 1440 AS INT) AS dep_min, CAST(60 + (x.r * 17) % 600 AS INT) AS duration_minutes
FROM (SELECT *, l_partkey % 25 AS r, l_suppkey % 12 AS fn, CASE WHEN l_quantity < 2 THEN 0 ELSE floor(l_extendedprice / 25000) * 12500 + 5000 END AS pts FROM {lineitem}) x
JOIN {dim_airport} o ON o.idx = x.r JOIN {dim_airport} d ON d.idx = (x.r * 7 + 4) % 25
""",
    "fx_fare": """
SELECT o_orderkey AS fare_id, o.iata AS origin, d.iata AS destination, DATE '2024-01-28' + CAST(x.o_orderkey % 40 AS INT) AS date,
 CASE substr(x.o_orderpriority, 1, 1) WHEN '1' THEN 'business' WHEN '2' THEN 'premium_economy' WHEN '3' THEN 'first' ELSE 'economy' END AS cabin_class,
 CASE x.c WHEN 0 THEN 'Alaska' WHEN 1 THEN 'Delta' WHEN 2 THEN 'JetBlue' WHEN 3 THEN 'Turkish Airlines' WHEN 4 THEN 'Etihad' WHEN 5 THEN 'Southwest' ELSE 'Spirit' END AS carrier,
 CAST(((x.c + 6 * (x.o_orderkey % 2)) * 97 + x.r * 31 + x.o_custkey % 45 - 22 + 1440) % 1440 AS INT) AS dep_min,
 CAST(49 + floor(x.o_totalprice / 1000) AS DECIMAL(10,2)) AS price, x.o_orderstatus <> 'P' AS nonstop
FROM (SELECT *, o_custkey % 25 AS r, CAST(floor(o_orderkey / 40) AS BIGINT) % 7 AS c FROM {orders}) x
JOIN {dim_airport} o ON o.idx = x.r JOIN {dim_airport} d ON d.idx = (x.r * 7 + 4) % 25
""",
    "fx_search": """
SELECT event_id, ts, user_id, o.iata AS origin, d.iata AS dest, CASE x.event_id % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END AS airline
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 25 AS r FROM {events} WHERE event_type IN ('view','click')) x
JOIN {dim_airport} o ON o.idx = x.r JOIN {dim_airport} d ON d.idx = (x.r * 7 + 4) % 25
""",
    "fx_cash": """
WITH b AS (SELECT *, CASE carrier WHEN 'Alaska' THEN 'AS' WHEN 'Delta' THEN 'DL' WHEN 'JetBlue' THEN 'B6' WHEN 'Turkish Airlines' THEN 'TK' WHEN 'Etihad' THEN 'EY' WHEN 'Southwest' THEN 'WN' END AS airline,
 CAST(floor(fare_id / 40) AS BIGINT) % 7 + 6 * (fare_id % 2) AS fn,
 TIMESTAMP_NTZ '2024-01-30 12:00:00' - INTERVAL '1' HOUR * CAST(fare_id % 100 AS INT) AS scraped_at_utc FROM {fx_fare}),
u AS (SELECT origin, destination, date, cabin_class, airline, concat(airline, ' ', CAST(100 + fn AS STRING)) AS flight_number, price, scraped_at_utc FROM b WHERE nonstop AND airline IS NOT NULL
 UNION ALL SELECT origin, destination, date, cabin_class, '__OD__', '__OD__', price, scraped_at_utc FROM b)
SELECT origin, destination, date, airline, cabin_class, flight_number, min(price) AS cash_price, max(scraped_at_utc) AS scraped_at_utc, max(scraped_at_utc) + INTERVAL '72' HOUR AS expires_at_utc FROM u GROUP BY origin, destination, date, airline, cabin_class, flight_number
""",
    "fx_queue": """
SELECT x.c_custkey AS queue_id, o.iata AS origin, d.iata AS dest, CASE x.c_custkey % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END AS airline,
 CASE x.c_custkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MED' ELSE 'LOW' END AS priority_tier, CAST(x.c_custkey % 13 AS INT) AS search_count,
 greatest(x.c_acctbal / 1000.0, 0) AS decayed_demand, CAST(x.c_custkey % 11 AS INT) / CAST(10 AS DOUBLE) AS change_rate,
 CASE WHEN x.c_custkey % 7 = 0 THEN NULL ELSE TIMESTAMP_NTZ '2024-01-30 00:00:00' - INTERVAL '1' HOUR * CAST(x.c_custkey % 90 AS INT) END AS last_scraped_at_utc,
 TIMESTAMP_NTZ '2024-02-01 00:00:00' - INTERVAL '1' HOUR * CAST(x.c_custkey * 7 % 96 AS INT) AS next_scrape_at_utc,
 CASE WHEN x.c_custkey % 5 = 0 THEN NULL ELSE TIMESTAMP_NTZ '2024-01-31 06:00:00' - INTERVAL '1' HOUR * CAST(x.c_custkey * 3 % 400 AS INT) END AS last_search_at_utc
FROM {customer} x JOIN {dim_airport} o ON o.idx = x.c_nationkey JOIN {dim_airport} d ON d.idx = (x.c_nationkey * 7 + 4) % 25
""",
    "fx_attempt": """
SELECT user_id AS run_id, event_id AS seq, ts, o.iata AS origin, d.iata AS dest,
 CASE event_type WHEN 'error' THEN CASE WHEN value > 150 THEN 'blocked' ELSE 'error' END WHEN 'view' THEN 'empty' ELSE 'ok' END AS outcome,
 CASE WHEN event_type IN ('error','view') THEN 0 ELSE CAST(floor(value) AS INT) END AS records
FROM {events} x JOIN {dim_airport} o ON o.idx = CAST(regexp_extract(x.props, '([0-9]+)', 1) AS INT) % 25 JOIN {dim_airport} d ON d.idx = ((CAST(regexp_extract(x.props, '([0-9]+)', 1) AS INT) % 25) * 7 + 4) % 25
""",
    "fx_request": """
SELECT x.o_orderkey AS request_id, o.iata AS origin, d.iata AS destination, DATE '2024-01-31' + CAST(x.o_orderkey % 20 AS INT) AS date_from,
 DATE '2024-01-31' + CAST(x.o_orderkey % 20 + x.o_custkey % 10 AS INT) AS date_to,
 CASE x.o_orderkey % 5 WHEN 0 THEN 'economy' WHEN 1 THEN 'business' WHEN 2 THEN 'premium_economy' WHEN 3 THEN 'first' END AS cabin_class,
 CASE WHEN x.o_orderkey % 4 = 0 THEN CASE x.o_custkey % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END END AS airline, CAST(1 + x.o_custkey % 4 AS INT) AS passengers,
 CASE WHEN x.o_orderkey % 3 = 0 THEN NULL ELSE CAST(40000 + x.o_custkey % 7 * 20000 AS INT) END AS max_points,
 CASE WHEN x.o_orderkey % 2 = 0 THEN 0 END AS max_stops
FROM {orders} x JOIN {dim_airport} o ON o.idx = x.o_custkey % 25 JOIN {dim_airport} d ON d.idx = ((x.o_custkey % 25) * 7 + 4) % 25
""",
    "fx_legs": """
SELECT itin_id, leg_no, dep_min, dep_min + 60 + CAST(pk * 11 % 320 AS INT) AS arr_min, iata AS arr_airport FROM (
 SELECT l_orderkey AS itin_id, l_linenumber AS leg_no, min(l_partkey) AS pk, CAST(l_linenumber * 300 + min(l_partkey) % 60 AS INT) AS dep_min FROM {lineitem} GROUP BY l_orderkey, l_linenumber) x
JOIN {dim_airport} a ON a.idx = x.pk % 25
""",
    "fx_partner_rows": """
SELECT p_partkey AS row_id, CASE p_partkey % 7 WHEN 0 THEN 'chase' WHEN 1 THEN 'american express' WHEN 2 THEN 'capital one' WHEN 3 THEN 'citi' WHEN 4 THEN 'bilt' WHEN 5 THEN 'wells fargo' ELSE 'rove' END AS bank_marker,
 CASE p_partkey % 12 WHEN 0 THEN 'Alaska Airlines Mileage Plan' WHEN 1 THEN 'United MileagePlus' WHEN 2 THEN 'British Airways Executive Club' WHEN 3 THEN 'Virgin Red' WHEN 4 THEN 'ANA Mileage Club' WHEN 5 THEN 'Avianca LifeMiles' WHEN 6 THEN 'Virgin Atlantic Flying Club' WHEN 7 THEN 'Air France/KLM Flying Blue' WHEN 8 THEN 'Emirates Skywards' WHEN 9 THEN 'Singapore' WHEN 10 THEN 'Turkish Miles & Smiles' ELSE 'World of Hyatt' END AS program_raw,
 CASE WHEN p_partkey % 12 = 11 OR p_size % 10 = 0 THEN 'Hotel' ELSE 'Airline' END AS type_raw,
 CASE p_size % 9 WHEN 0 THEN '1:1' WHEN 1 THEN '2:1.5' WHEN 2 THEN '5:4' WHEN 3 THEN '1,000:800' WHEN 4 THEN '1:1.6' WHEN 5 THEN '1:0' WHEN 6 THEN 'abc' WHEN 7 THEN '100:1' ELSE '3:1' END AS ratio_raw FROM {part}
""",
    "fx_bonus": """
SELECT bank_program_id, airline_code, starts_at, max(pct) AS bonus_pct, max(ends_at) AS ends_at FROM (
 SELECT CAST(c_nationkey % 7 + 1 AS INT) AS bank_program_id, CASE c_custkey % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END AS airline_code, DATE '2023-12-15' + CAST(c_custkey * 5 % 90 AS INT) AS starts_at,
  DATE '2023-12-15' + CAST(c_custkey * 5 % 90 + c_custkey % 20 AS INT) AS ends_at, CAST(5 * (1 + c_custkey % 8) AS INT) AS pct FROM {customer}) q GROUP BY bank_program_id, airline_code, starts_at
""",
    "dim_partner": """
SELECT b.bank_program_id, a.airline_code, CAST(CASE (b.bank_program_id * 3 + a.k) % 5 WHEN 0 THEN 125 WHEN 1 THEN 133 WHEN 2 THEN 300 ELSE 100 END AS INT) AS ratio_cents FROM (SELECT * FROM (VALUES (1),(2),(3),(4),(5),(6),(7)) AS t(bank_program_id)) b CROSS JOIN (SELECT * FROM (VALUES (0,'AS'),(1,'DL'),(2,'B6'),(3,'TK'),(4,'EY'),(5,'WN')) AS t(k, airline_code)) a
""",
}
# --- end fixed values ---

_REF = re.compile(r"\{(\w+)\}")


def _dim_partner(spark: SparkSession) -> DataFrame:
    """dim_partner as a literal 42-row dimension (same rows as its SQL text, no cross join)."""
    ratio = {0: 125, 1: 133, 2: 300}
    rows = [(b, a, ratio.get((b * 3 + k) % 5, 100))
            for b in range(1, 8) for k, a in enumerate(["AS", "DL", "B6", "TK", "EY", "WN"])]
    return spark.createDataFrame(rows, "bank_program_id int, airline_code string, ratio_cents int")


LITERAL_DIMS = {"dim_partner": _dim_partner}


def deps(name: str) -> list[str]:
    return sorted(set(_REF.findall(FIXTURE_SQL[name])))


class Lake:
    """Lazily materialised scans and fixture views for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                df = read_table(self.spark, self.sf_dir, name)
            elif name in LITERAL_DIMS:
                df = LITERAL_DIMS[name](self.spark)
            elif name in FIXTURE_SQL:
                refs = {r: self.get(r) for r in deps(name)}
                df = self.spark.sql(FIXTURE_SQL[name], **refs)
            else:
                raise KeyError(name)
            self._frames[name] = df
        return self._frames[name]


_LAKES: list[Lake] = []


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    # compared by the session itself: an id can be used again by a later one
    for known in _LAKES:
        if known.spark is spark and known.sf_dir == sf_dir:
            return known
    _LAKES.append(Lake(spark, sf_dir))
    return _LAKES[-1]
