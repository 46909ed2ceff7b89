"""What to collect next for cash: units, negative memory, shard and ranking
(set_distinct_units, jn_anti_fresh_cash, jn_anti_zero_memory, jn_demand_coverage,
agg_demand_sum, set_pinned_keys, fn_route_key / fn_shard, top_cash_units,
snk_negative_memory).

All units of all shards are ranked in one plan; ``row_number() <= limit``
per shard becomes a WindowGroupLimit, so each map task ships at most
``limit`` rows per shard to the final sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.sources.dims import METROS
from milesbase.sources.dims import UNKNOWN_FLIGHT

UNIT = ["origin", "destination", "date", "cabin_class"]
CASH_ZERO_REPROBE_DAYS = 3
SCRAPE_DAYS_AHEAD = 30

# --- fixed values: hub routes always refreshed first (airports or metro tokens) ---
CASH_PINNED_ROUTES = [
    ("SEA", "MSP"), ("SEA", "NYC"), ("PDX", "NYC"), ("SFO", "NYC"), ("LAX_METRO", "NYC"), ("SEA", "HND"), ("SFO", "HND"), ("LAX", "HND"), ("LAX", "NRT"), ("SFO", "HKG"),
    ("LAX", "SYD"), ("LAX", "TPE"), ("SEA", "LHR"), ("DTW", "ICN"), ("JFK", "CDG"), ("DTW", "AMS"),
    ("JFK", "DUB"), ("BOS", "DUB"), ("SEA", "FRA"), ("SEA", "KEF"), ("JFK", "FCO"), ("SEA", "FCO"),
    ("SEA", "BCN"), ("JFK", "OPO"), ("BOS", "MAD"), ("BOS", "BCN"), ("BOS", "MXP"),
]
# --- end fixed values ---


def route_key(o="origin", d="destination"):
    """fn_route_key: 'O-D'."""
    return F.concat_ws("-", X.col(o), X.col(d))


def shard_of(key, shard_count: int):
    """fn_shard: stable, total and disjoint; md5 prefix (60 bits) mod n. n = 1 short-circuits."""
    if shard_count <= 1:
        return F.lit(0).cast("bigint")
    h = F.conv(F.substring(F.md5(X.col(key)), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(shard_count).cast("bigint"))


def pinned_keys(spark: SparkSession, pairs=CASH_PINNED_ROUTES) -> DataFrame:
    """set_pinned_keys: pinned pairs with metro tokens expanded to their airports, and their reverses, as 'O-D' keys
    (bounded by the literal lists, broadcast)."""
    metros = spark.createDataFrame([(k, list(v)) for k, v in METROS.items()], "token string, airports array<string>")
    side = lambda c: F.explode(F.coalesce(F.col("airports"), F.array(c)))
    p = spark.createDataFrame(list(pairs), "o string, d string")
    p = p.join(metros.withColumnRenamed("token", "o"), "o", "left").select(side("o").alias("o"), "d")
    p = p.join(metros.withColumnRenamed("token", "d"), "d", "left").select("o", side("d").alias("d")).filter("o <> d")
    return p.union(p.select("d", "o")).select(route_key("o", "d").alias("route_key")).distinct()


def distinct_units(flights: DataFrame, as_of, as_of_date, days_ahead=SCRAPE_DAYS_AHEAD, cabins=None) -> DataFrame:
    """set_distinct_units: nonstop, unexpired, real flight number, date in [d, d + n]."""
    d0 = F.lit(as_of_date).cast("date")
    f = flights.filter((F.col("stops") == 0) & (F.col("expires_at_utc") > F.lit(as_of).cast("timestamp_ntz"))
                       & F.col("raw_flight_number").isNotNull() & (F.col("raw_flight_number") != UNKNOWN_FLIGHT)
                       & F.col("date").between(d0, F.date_add(d0, days_ahead)))
    if cabins:
        f = f.filter(F.col("cabin_class").isin(*cabins))
    return f.select(*UNIT).distinct()


def demand_sum(queue: DataFrame) -> DataFrame:
    """agg_demand_sum: demand per route summed over airlines (aggregated before any join)."""
    return queue.groupBy("origin", "dest").agg(F.sum("decayed_demand").alias("demand"))


def negative_memory(attempts: DataFrame, reprobe_days=CASH_ZERO_REPROBE_DAYS) -> DataFrame:
    """snk_negative_memory: last attempt per unit wins; a zero-yield attempt pushes the next
    probe out by ``reprobe_days``, any fares make it eligible at once. Keys upper-cased."""
    a = attempts.select(F.upper("origin").alias("origin"), F.upper("destination").alias("destination"),
                        "date", "cabin", "attempt_utc", "seq", "fare_count")
    last = a.groupBy("origin", "destination", "date", "cabin").agg(
        F.max_by(F.struct("attempt_utc", "fare_count"), F.struct("attempt_utc", "seq")).alias("l"))
    nxt = F.when(F.col("l.fare_count") == 0,
                 F.col("l.attempt_utc") + F.make_dt_interval(F.lit(reprobe_days))).otherwise(F.col("l.attempt_utc"))
    return last.select("origin", "destination", "date", "cabin", F.col("l.attempt_utc").alias("last_attempt_utc"),
                       F.col("l.fare_count").alias("fare_count"), nxt.alias("next_probe_utc"))


def eligible_units(units: DataFrame, cash: DataFrame, coverage: DataFrame, as_of, ttl_hours: int) -> DataFrame:
    """jn_anti_fresh_cash + jn_anti_zero_memory: drop units with cash scraped within the TTL
    (any fare row, the __OD__ anchor included) or a zero-yield memory not yet due."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    fresh_cash = cash.filter(F.col("scraped_at_utc") > ts - X.hours(F.lit(ttl_hours))).select(*UNIT)
    zero = coverage.filter((F.col("fare_count") == 0) & (F.col("next_probe_utc") > ts)) \
                   .select("origin", "destination", "date", F.col("cabin").alias("cabin_class"))
    return units.join(fresh_cash, UNIT, "left_anti").join(zero, UNIT, "left_anti")


def with_demand_coverage(units: DataFrame, demand: DataFrame, coverage: DataFrame) -> DataFrame:
    """jn_demand_coverage: units LEFT JOIN route demand LEFT JOIN coverage memory."""
    d = demand.select("origin", F.col("dest").alias("destination"), "demand")
    c = coverage.select("origin", "destination", "date", F.col("cabin").alias("cabin_class"), "last_attempt_utc")
    return units.join(d, ["origin", "destination"], "left").join(c, UNIT, "left")


def rank_cash_units(units: DataFrame, pinned: DataFrame, shard_count: int, limit: int) -> DataFrame:
    """top_cash_units for every shard: pinned first, oldest attempt (null = 1970), demand desc,
    date, origin, destination, cabin (the cabin makes ties deterministic)."""
    u = units.withColumn("route_key", route_key())
    u = u.join(F.broadcast(pinned.withColumn("pinned", F.lit(True))), "route_key", "left")
    u = u.withColumn("shard", shard_of("route_key", shard_count))
    w = Window.partitionBy("shard").orderBy(
        F.when(F.col("pinned"), 0).otherwise(1),
        F.coalesce("last_attempt_utc", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")),
        F.coalesce("demand", F.lit(0.0)).desc(), "date", "origin", "destination", "cabin_class")
    return u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit) \
            .select("shard", F.col("rank").cast("bigint").alias("rank"), *UNIT)
