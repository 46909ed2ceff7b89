"""Cash-fare to award-flight matching (jn_nearest_fare, agg_od_anchor, set_fare_union).

Nearest-departure matching is a band join. Instead of a nested loop within a
(route, date, cabin, carrier) group, both sides get a time bucket of width
``tolerance``: an award flight sits in bucket ``dep div tol``, a fare probes
its own bucket and the two neighbours. The join is then a plain equi-join on
the five keys plus the bucket, with ``|delta| <= tol`` as a residual, so a hot
(route, date) group is spread over up to 1440/tol keys and the candidate set
per fare stays bounded by the flights within the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.sources.dims import CARRIER_TO_IATA, CASH_SOURCE, MATCH_TOLERANCE_MIN, OD_SENTINEL, UNKNOWN_FLIGHT

UNIT = ["origin", "destination", "date", "cabin_class"]


def match_candidates(flights: DataFrame, airports: DataFrame, as_of) -> DataFrame:
    """Award rows eligible for matching: nonstop, real flight number, known departure,
    unexpired, and an origin with a known zone (unmapped origins never match)."""
    zones = F.broadcast(airports.filter(F.col("tz").isNotNull()).select(F.col("iata").alias("origin")))
    f = flights.filter((F.col("stops") == 0) & F.col("raw_flight_number").isNotNull()
                       & (F.col("raw_flight_number") != UNKNOWN_FLIGHT) & F.col("dep_min").isNotNull()
                       & (F.col("expires_at_utc") > F.lit(as_of).cast("timestamp_ntz")))
    return f.join(zones, "origin", "left_semi").select(
        *UNIT, "airline", F.col("raw_flight_number").alias("flight_number"), F.col("dep_min").alias("award_min"))


def map_carrier(fares: DataFrame) -> DataFrame:
    return fares.withColumn("airline", X.case_map("carrier", CARRIER_TO_IATA))


def nearest_fares(fares: DataFrame, candidates: DataFrame, tolerance=MATCH_TOLERANCE_MIN) -> DataFrame:
    """Each nonstop, mapped fare -> its nearest award flight (ties: lowest flight number)."""
    fr = map_carrier(fares).filter(F.col("nonstop") & F.col("airline").isNotNull())
    fr = fr.withColumn("bucket", F.explode(F.array(*[X.idiv("dep_min", F.lit(tolerance)) + d for d in (-1, 0, 1)])))
    cand = candidates.withColumn("bucket", X.idiv("award_min", F.lit(tolerance)))
    pairs = fr.join(cand, [*UNIT, "airline", "bucket"]).withColumn("dist", F.abs(F.col("award_min") - F.col("dep_min")))
    pairs = pairs.filter(F.col("dist") <= tolerance)
    best = pairs.groupBy("fare_id").agg(
        F.min_by(F.struct(*UNIT, "airline", "flight_number", "price"),
                 F.struct("dist", "flight_number")).alias("m"))
    return best.select("fare_id", "m.*")


def cheapest_per_flight(matched: DataFrame) -> DataFrame:
    """Cheapest matched fare per (unit, flight number); equal prices keep the first fare."""
    g = matched.groupBy(*UNIT, "flight_number").agg(
        F.min_by(F.struct("airline", "price"), F.struct("price", "fare_id")).alias("m"))
    return g.select(*UNIT, "m.airline", "flight_number", F.col("m.price").alias("cash_price"))


def od_anchor(fares: DataFrame) -> DataFrame:
    """Cheapest price over every fare of a unit (any carrier, any stops) as the __OD__ row."""
    return fares.groupBy(*UNIT).agg(F.min("price").alias("cash_price")).select(
        *UNIT, F.lit(OD_SENTINEL).alias("airline"), F.lit(OD_SENTINEL).alias("flight_number"), "cash_price")


def fare_batch(fares: DataFrame, candidates: DataFrame, as_of, ttl_hours: int) -> DataFrame:
    """set_fare_union: matched per-flight rows plus O&D anchors, stamped at ``as_of``."""
    per_flight = cheapest_per_flight(nearest_fares(fares, candidates))
    rows = per_flight.unionByName(od_anchor(fares))
    ts = F.lit(as_of).cast("timestamp_ntz")
    return rows.select("origin", "destination", "date", "airline", "cabin_class", "flight_number", "cash_price",
                       F.lit("USD").alias("currency"), F.lit(CASH_SOURCE).alias("source"),
                       ts.alias("scraped_at_utc"), (ts + X.hours(F.lit(ttl_hours))).alias("expires_at_utc"))
