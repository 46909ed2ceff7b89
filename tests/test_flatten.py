"""Flattening rules on hand-written payloads (one landed response per row)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from milesbase.operators import flatten as FL

D0 = dt.date(2024, 2, 1)
T0 = dt.datetime(2024, 1, 30, 12)


def bronze(spark, payload, origin="SEA", dest="JFK"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame([(origin, dest, D0, T0, text)],
                                 "origin string, destination string, travel_date date, scraped_at_utc timestamp_ntz, payload string")


def airports(spark):
    return spark.createDataFrame([("SEA", "America/Los_Angeles"), ("JFK", "America/New_York"), ("XXX", None)],
                                 "iata string, tz string")


def test_brand_rules_first_token_wins(spark):
    cases = {"DELTA_ONE": "business", "CD1": "business", "CDPS": "premium_economy", "PREMIUM SELECT": "premium_economy",
             "CDCP": "economy", "CFIRST": "first", "BMAIN": "economy", "BASIC": "economy", "ZZZ": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "b string")
    got = {r.b: r.c for r in df.select("b", FL.brand_to_cabin(F.col("b")).alias("c")).collect()}
    assert got == cases


def test_most_premium(spark):
    df = spark.createDataFrame([(["economy", "first"],), (["premium_economy", "business", "first"],), ([],)], "c array<string>")
    got = [r.m for r in df.select(FL.most_premium(F.col("c")).alias("m")).collect()]
    assert got == ["first", "business", None]


def test_etihad_cards(spark):
    payload = {"cards": [
        {"depTime": "08:05", "arrTime": "06:10", "dayDiff": "+1", "duration": "12h 40m", "nonstop": True,
         "flightNumbers": ["EY 12"], "cabins": [{"cabin": "Economy", "miles": 40000, "cashCents": 12345},
                                                {"cabin": "Residence", "miles": 9}, {"cabin": "Business", "miles": 0}]},
        {"flightNumbers": ["EY 12"], "nonstop": True, "cabins": [{"cabin": "economy", "miles": 1}]},  # dup: first wins
        {"flightNumbers": [], "nonstop": False, "duration": "13h", "cabins": [{"cabin": "premium", "miles": 5}]},
        None]}
    got = {(r.raw_flight_number, r.cabin_class): r for r in FL.flatten_etihad(bronze(spark, payload)).collect()}
    assert set(got) == {("EY 12", "economy"), ("UNKNOWN", "premium_economy")}
    e = got[("EY 12", "economy")]
    assert (e.points_cost, float(e.cash_cost), e.duration_minutes, e.next_day_arrival, e.stops) == (40000, 123.45, 760, True, 0)
    u = got[("UNKNOWN", "premium_economy")]
    assert (u.stops, u.duration_minutes, float(u.cash_cost)) == (1, 780, 0.0)


def _tk_option(fc_num, key="ECONOMY", cur="MILE", amount=30000, seats=4):
    return {"segmentList": [{"flightCode": {"airlineCode": "TK", "flightNumber": fc_num},
                             "departureDateTime": "01-02-2024 10:00", "arrivalDateTime": "01-02-2024 20:00",
                             "arrivalAirportCode": "JFK", "carrierAirline": "TK"}],
            "fareCategory": {key: {"bookingPriceInfoList": [{"brandCode": "EF", "referencePassengerFare": {
                "totalFare": {"currencyCode": cur, "amount": amount}}}]}},
            "lastSeatCount": seats}


def _tk(options, success=True):
    return {"success": success, "data": {"originDestinationInformationList": [{"originDestinationOptionList": options}]}}


def test_turkish_rules(spark):
    ok = FL.flatten_turkish(bronze(spark, _tk([_tk_option("0012"), _tk_option("0013", cur="TRY"),
                                               _tk_option("0014", key="LOUNGE")]), "SEA", "JFK"), airports(spark)).collect()
    assert [(r.raw_flight_number, r.points_cost, r.fare_class) for r in ok] == [("TK 12", 30000, "EF")]
    assert ok[0].duration_minutes == 7 * 60  # 10:00 at SEA (18:00Z) -> 20:00 at JFK (01:00Z): 7 h as instants
    assert FL.flatten_turkish(bronze(spark, _tk([_tk_option("12")], success=False)), airports(spark)).count() == 0
    bad = _tk_option("15")
    bad["fareCategory"] = {}
    assert FL.flatten_turkish(bronze(spark, _tk([_tk_option("12"), bad])), airports(spark)).count() == 0
    assert FL.flatten_turkish(bronze(spark, "not json"), airports(spark)).count() == 0


def test_jetblue_offers(spark):
    seg = {"flightInfo": {"marketingAirlineCode": "B6", "marketingFlightNumber": "101", "operatingAirlineCode": "B6"},
           "arrival": {"airport": "JFK"}}
    offer = lambda **kw: {"soldOut": False, "cabinClass": "ECONOMY", "brand": {"brandId": "AN"},
                          "price": [{"currency": "USD", "amount": 5.6}, {"currency": "FFCURRENCY", "amount": 12000}], **kw}
    payload = {"data": {"searchResults": [{"productOffers": [{
        "originAndDestination": [{"departure": {"date": "2024-02-01T06:00:00"}, "arrival": {"date": "2024-02-01T14:30:00"},
                                  "stops": 0, "totalDuration": 330, "flightSegments": [seg]}],
        "offers": [offer(), offer(soldOut=True), offer(cabinClass="LOUNGE"),
                   offer(price=[{"currency": "USD", "amount": 10}])]}]}]}}
    got = FL.flatten_jetblue(bronze(spark, payload), airports(spark)).collect()
    assert [(r.raw_flight_number, r.points_cost, float(r.cash_cost), r.is_saver, r.available_seats) for r in got] == \
        [("B6 101", 12000, 5.6, True, -1)]


def test_southwest_cheapest_available_and_packed_legs(spark):
    seg1 = "Y,K,SEA,DEN,2024-02-01T06:00-08:00,2024-02-01T09:30-07:00,WN,WN,1234,7M8"
    seg2 = "Y,K,DEN,JFK,2024-02-01T10:15-07:00,2024-02-01T16:00-05:00,WN,WN,567,73H"
    fams = {"BUS": {"availabilityStatus": "UNAVAILABLE", "fare": {"totalFare": {"value": "1000"}}, "productId": "BUS|" + seg1},
            "WGA": {"availabilityStatus": "AVAILABLE", "fare": {"totalFare": {"value": "9000"}, "totalTaxesAndFees": {"value": "5.60"}},
                    "productId": "WGA|" + seg1 + "|" + seg2 + "|short,seg"},
            "ANY": {"availabilityStatus": "AVAILABLE", "fare": {"totalFare": {"value": "15000"}}, "productId": "ANY|" + seg1}}
    payload = {"data": {"searchResults": {"airProducts": [{"details": [
        {"totalDuration": 420, "nextDay": False, "fareProducts": {"ADULT": fams}},
        {"totalDuration": 100, "fareProducts": {"ADULT": {"X": {"availabilityStatus": "AVAILABLE",
                                                                "fare": {"totalFare": {"value": "0"}}}}}}]}]}}}
    got = FL.flatten_southwest(bronze(spark, payload)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.points_cost, float(r.cash_cost), r.stops, r.raw_flight_number, r.layover_airports, r.is_saver) == \
        (9000, 5.6, 1, "WN 1234+WN 567", "DEN", True)


def test_alaska_flat_array_references(spark):
    flat = [{"rows": 1}, [2], {"segments": 3, "solutions": 9, "totalDuration": 14},
            [4], {"publishingCarrier": 5, "displayCarrier": 8, "arrivalDateTime": 13},
            {"carrierCode": 6, "flightNumber": 7}, "AS", 12, {"carrierCode": 6},
            {"SAVER_MAIN": 10, "REFUNDABLE_FIRST": -1, "UPGRADE": 10}, {"atmosPoints": 11, "grandTotal": 15, "seatsRemaining": 16},
            7500, 0, "2024-02-02T01:00:00-05:00", 330, 5.6, 3]
    payload = {"chunks": [{"type": "data", "data": [{"x": 1}]}, {"type": "chunk", "data": flat}]}
    got = FL.flatten_alaska(bronze(spark, payload)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.raw_flight_number, r.cabin_class, r.points_cost, float(r.cash_cost), r.available_seats, r.is_saver,
            r.duration_minutes, r.next_day_arrival) == ("AS 12", "economy", 7500, 5.6, 3, True, 330, True)


def test_delta_list_or_object_price(spark):
    price = {"totalFarePrice": {"milesEquivalentPrice": {"mileCnt": 25000}, "currencyEquivalentPrice": {"roundedCurrencyAmt": 5.6}}}

    def offer_set(fare_price, dominant):
        return {"trips": [{"stopCnt": 0, "totalTripTime": {"hourCnt": 5, "minuteCnt": 30},
                           "flightSegment": [{"marketingCarrier": {"carrierCode": "DL", "carrierNum": "1"}, "flightLeg": [{}]}]}],
                "offers": [{"additionalOfferProperties": {"fareType": "AWARD", "dominantSegmentBrandId": dominant},
                            "offerItems": [{"retailItems": [{"retailItemMetaData": {"fareInformation": [
                                {"brandByFlightLegs": [{"brandId": "MAIN", "cosCode": "X"}], "farePrice": fare_price}]}}]}]}]}

    payload = {"data": {"gqlSearchOffers": {"gqlOffersSets": [offer_set(json.dumps([price]), "DELTA_ONE"),
                                                              offer_set(json.dumps(price), None)]}}}
    got = sorted((r.cabin_class, r.points_cost, r.duration_minutes, r.is_saver)
                 for r in FL.flatten_delta(bronze(spark, payload), airports(spark)).collect())
    assert got == [("business", 25000, 330, True), ("economy", 25000, 330, True)]


def test_one_response_whatever_its_size(spark):
    """A response has one identity: first wins over all its cards, however many there are."""
    card = {"flightNumbers": ["EY 1"], "nonstop": True, "cabins": [{"cabin": "Economy", "miles": 100, "cashCents": 5}]}
    cards = [dict(card, flightNumbers=[f"EY {i % 70}"], cabins=[{"cabin": "Economy", "miles": 100 + i, "cashCents": 5}]) for i in range(400)]
    got = {r.raw_flight_number: r.points_cost for r in FL.flatten_etihad(bronze(spark, {"cards": cards})).collect()}
    assert got == {f"EY {i}": 100 + i for i in range(70)}


def test_values_out_of_range_do_not_fail_the_job(spark):
    def cards(**over):
        cab = {"cabin": "Economy", "miles": 100, "cashCents": 500} | {k: v for k, v in over.items() if k in ("miles", "cashCents")}
        return {"cards": [{"flightNumbers": ["EY 1"], "nonstop": True, "duration": over.get("duration", "1h"), "dayDiff": over.get("dayDiff", "+1"), "cabins": [cab]},
                          {"flightNumbers": ["EY 2"], "nonstop": True, "cabins": [{"cabin": "First", "miles": 7, "cashCents": 0}]}]}

    def flights(payload):
        return sorted((r.raw_flight_number, r.duration_minutes) for r in FL.flatten_etihad(bronze(spark, payload)).collect())

    assert flights(cards(cashCents=10**11)) == [("EY 2", None)]
    assert flights(cards(miles=3 * 10**9)) == [("EY 2", None)]
    assert flights(cards(duration="99999999999h")) == [("EY 1", None), ("EY 2", None)]
    assert flights(cards(dayDiff="99999999999")) == [("EY 1", 60), ("EY 2", None)]


def test_long_product_ids_keep_every_segment(spark):
    seg = "x,Y,SEA,{d},2024-02-01T08:00-08:00,2024-02-01T09:00-08:00,a,b,{n},737"
    text = "WGA|" + "|".join(seg.format(d="DEN", n=i) for i in range(1500))
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.size(FL.product_segments(F.col("t")))).first()[0] == 1500


def test_unreadable_payloads_are_quarantined(spark):
    texts = [None, "  ", '{"cards": [', "not json", '{"error": 1}', '{"cards": []}', '{"cards": null}']
    df = spark.createDataFrame([("SEA", "JFK", D0, T0, t) for t in texts],
                               "origin string, destination string, travel_date date, scraped_at_utc timestamp_ntz, payload string")
    got = [(r.payload, r.reason) for r in FL.quarantined(df, "$.cards").collect()]
    assert got == [(None, "missing"), ("  ", "missing"), ('{"cards": [', "malformed"), ("not json", "malformed"), ('{"error": 1}', "unexpected_shape")]
    assert FL.flatten_etihad(df).count() == 0
