"""The merge over every material column, and the times, aircraft and layovers that the flatteners add to records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from milesbase.operators import flatten as FL
from milesbase.plans import domain as D
from milesbase.plans import record_plans as R

T0, T1 = dt.datetime(2024, 1, 30, 6), dt.datetime(2024, 1, 30, 9)
TYPES = {"source": "string", "points_cost": "int", "cash_cost": "decimal(8,2)", "stops": "int", "available_seats": "int",
         "partner_airline": "string", "departure_time_local": "timestamp_ntz", "arrival_time_local": "timestamp_ntz",
         "duration_minutes": "int", "aircraft_type": "string", "is_saver": "boolean", "fare_class": "string",
         "layover_airports": "string", "layover_duration_minutes": "int", "next_day_arrival": "boolean", "mixed_cabin": "boolean"}
BEFORE = {"source": "a", "points_cost": 1, "cash_cost": 1, "stops": 0, "available_seats": 1, "partner_airline": None,
          "departure_time_local": T0, "arrival_time_local": None, "duration_minutes": 5, "aircraft_type": "320", "is_saver": False,
          "fare_class": "Y", "layover_airports": None, "layover_duration_minutes": None, "next_day_arrival": False, "mixed_cabin": False}
AFTER = {"source": "b", "points_cost": 2, "cash_cost": 2, "stops": 1, "available_seats": None, "partner_airline": "AA",
         "departure_time_local": T1, "arrival_time_local": T1, "duration_minutes": None, "aircraft_type": None, "is_saver": True,
         "fare_class": "J", "layover_airports": "BOS", "layover_duration_minutes": 45, "next_day_arrival": True, "mixed_cabin": True}


def _rows(spark, changed):
    """One key for each material column (and one unchanged), ``changed``: with that column's new value."""
    from decimal import Decimal
    fix = lambda c, v: Decimal(v) if c == "cash_cost" and v is not None else v
    rows = []
    for k in [*R.MATERIAL, "none"]:
        vals = [fix(c, AFTER[c] if changed and c == k else BEFORE[c]) for c in R.MATERIAL]
        t = T1 if changed else T0
        rows.append(("AAA", "BBB", dt.date(2024, 2, 9), "AS", "first", k, *vals, t, t + dt.timedelta(hours=48), "new" if changed else "old"))
    schema = ("origin string, destination string, date date, airline string, cabin_class string, raw_flight_number string, "
              + ", ".join(f"{c} {TYPES[c]}" for c in R.MATERIAL) + ", scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz, program string")
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("strategy", ["window", "aggregate"])
def test_a_change_in_any_material_column_is_an_update(spark, strategy):
    spark.conf.set("milesbase.merge.strategy", strategy)
    try:
        merged = R.merge_records(R.merge_records(None, _rows(spark, False)), _rows(spark, True))
        got = {r["raw_flight_number"]: r.asDict() for r in merged.collect()}
    finally:
        spark.conf.unset("milesbase.merge.strategy")
    assert set(got) == {*R.MATERIAL, "none"}
    for k in R.MATERIAL:
        want = AFTER[k]
        assert got[k][k] == want, k
        assert got[k]["scraped_at_utc"] == T1, k
        assert all(got[k][c] == BEFORE[c] for c in R.MATERIAL if c != k)
    assert got["none"]["scraped_at_utc"] == T0  # unexpired and unchanged: not stamped again
    assert {r["program"] for r in got.values()} == {"old"}  # set at insert only


def _bronze(spark, payload):
    return spark.createDataFrame([("BOS", "LHR", dt.date(2024, 2, 9), T0, json.dumps(payload))],
                                 "origin string, destination string, travel_date date, scraped_at_utc timestamp_ntz, payload string")


def _airports(spark, *known):
    return spark.createDataFrame([(a, "America/New_York" if a == "BOS" else "Europe/London") for a in known] or [("ZZZ", "UTC")],
                                 "iata string, tz string")


def _details(df):
    return [tuple(r) for r in df.select(*FL.DETAIL_COLS).collect()]


def test_etihad_clocks_need_a_known_zone(spark):
    card = {"depTime": "9:05", "arrTime": "bad 25", "dayDiff": "+1", "duration": "7h", "nonstop": True, "flightNumbers": ["EY 1"],
            "cabins": [{"cabin": "Economy", "miles": 100, "cashCents": 100}]}
    good = {**card, "arrTime": "06:40", "flightNumbers": ["EY 2"]}
    both = FL.flatten_etihad(_bronze(spark, {"cards": [good]}), _airports(spark, "BOS", "LHR"), details=True)
    assert _details(both) == [(dt.datetime(2024, 2, 9, 9, 5), dt.datetime(2024, 2, 10, 6, 40), None, None, False)]
    odd = FL.flatten_etihad(_bronze(spark, {"cards": [card]}), _airports(spark, "LHR"), details=True)
    assert _details(odd) == [(None, None, None, None, False)]
    assert FL.flatten_etihad(_bronze(spark, {"cards": [card]})).columns and set(
        FL.flatten_etihad(_bronze(spark, {"cards": [card]})).columns) == set(FL.RECORD_COLS)


def test_delta_aircraft_falls_back_and_layovers_add_up(spark):
    wait = lambda h, m: {"destinationAirportCode": "JFK", "layoverDuration": {"dayCnt": 0, "hourCnt": h, "minuteCnt": m}}
    legs = [{"aircraft": {"fleetTypeCode": "", "subFleetTypeCode": "32B-with-a-long-name"}, "layover": wait(1, 5)},
            {"aircraft": {"fleetTypeCode": "739"}, "layover": wait(0, 40)}, {"aircraft": None, "layover": None}]
    price = {"totalFarePrice": {"milesEquivalentPrice": {"mileCnt": 900}, "currencyEquivalentPrice": {"roundedCurrencyAmt": 6}}}
    fare = {"brandByFlightLegs": [{"brandId": "MAIN", "cosCode": "X"}, {"brandId": "CFIRST"}], "farePrice": price}
    item = {"retailItems": [{"retailItemMetaData": {"fareInformation": [fare]}}]}
    trip = {"scheduledDepartureLocalTs": "2024-02-09T08:00:00", "scheduledArrivalLocalTs": "2024-02-09T23:10:00",
            "flightSegment": [{"marketingCarrier": {"carrierCode": "DL", "carrierNum": "7"}, "flightLeg": legs}]}
    payload = {"data": {"gqlSearchOffers": {"gqlOffersSets": [{"trips": [trip], "offers": [{"offerItems": [item]}]}]}}}
    got = FL.flatten_delta(_bronze(spark, payload), _airports(spark, "BOS"), details=True)
    assert _details(got) == [(dt.datetime(2024, 2, 9, 8), None, "32B-with-a", 105, True)]


def test_southwest_times_are_local_to_each_airport(spark):
    pid = "WGA|Y,K,BOS,DEN,2024-02-09T22:00-05:00,2024-02-09T23:30-07:00,WN,WN,12,7M8|Y,K,DEN,LHR,2024-02-10T00:15-07:00,2024-02-10T14:00+00:00,WN,WN,13,73H"
    fp = {"availabilityStatus": "AVAILABLE", "fare": {"totalFare": {"value": "5000"}, "totalTaxesAndFees": {"value": "5.6"}}, "productId": pid}
    payload = {"data": {"searchResults": {"airProducts": [{"details": [{"totalDuration": 1, "fareProducts": {"ADULT": {"WGA": fp}}}]}]}}}
    got = FL.flatten_southwest(_bronze(spark, payload), details=True)
    assert _details(got) == [(dt.datetime(2024, 2, 9, 22), dt.datetime(2024, 2, 10, 14), "7M8", 45, False)]


def test_records_keep_only_valid_rows(spark):
    """Every provider's records carry all merged columns."""
    import __spark_entry__ as E
    recs = R.provider_records(D.lk(spark, E.SMOKE_DIR))
    assert set(recs.columns) == {*D.AWARD_KEY, *R.MATERIAL, "scraped_at_utc", "expires_at_utc", "program"}
    assert recs.filter(F.col("points_cost") <= 0).count() == 0


def test_a_providers_responses_are_not_merged_into_few_tasks(spark):
    """A provider's items are few bytes and a lot of parsing: its responses keep the shuffle's number of partitions."""
    import __spark_entry__ as E
    from milesbase.plans import flatten_plans as FP
    made = FP.responses(D.lk(spark, E.SMOKE_DIR), "AS")
    tasks = made.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("flatten, parses", [
    (lambda b, z: FL.flatten_turkish(b, z, details=True), 1), (lambda b, z: FL.flatten_southwest(b, details=True), 1),
    (lambda b, z: FL.flatten_delta(b, z, details=True), 3),  # the payload, then a price as a list or as an object
    (lambda b, z: FL.flatten_alaska(b, details=True), 9)], ids=["turkish", "southwest", "delta", "alaska"])
def test_filters_on_records_repeat_no_parsing(spark, flatten, parses):
    from milesbase.operators import quality
    recs = quality.filter_valid(flatten(_bronze(spark, {}), _airports(spark, "BOS", "LHR")), "2024-01-31")
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == parses
    assert not [x for x in plan.splitlines() if "Filter" in x and ("from_json(" in x or "transform(" in x or "aggregate(" in x)]
    assert recs.count() == 0
