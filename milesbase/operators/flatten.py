"""Provider payload flattening (nrm_*): landed JSON responses -> award records.

Input is a bronze table ``(origin, destination, travel_date, scraped_at_utc,
payload STRING)``, one row per landed response. Each flattener parses with an
explicit ``from_json`` schema (a malformed payload parses to null and yields
no rows instead of failing the job; ``quarantined`` lists it with a reason). Landed
numbers and dates are cast with try_cast: one that does not fit becomes null, and a
record without a valid price in points or money is dropped, never the job. It walks the nesting with ``posexplode`` so
positions become arrival ordinals, and expresses every per-field rule as a
column expression. Per-response "first record wins" dedupes are ``min_by``
over the ordinal, grouped by response and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.operators.text_parse import day_offset, duration_text

RECORD_COLS = ["origin", "destination", "date", "airline", "source", "points_cost", "cash_cost", "cabin_class",
               "stops", "available_seats", "raw_flight_number", "partner_airline", "duration_minutes", "is_saver",
               "fare_class", "layover_airports", "next_day_arrival", "scraped_at_utc"]
# what the served table holds beyond these: each flattener adds them with ``details``
DETAIL_COLS = ["departure_time_local", "arrival_time_local", "aircraft_type", "layover_duration_minutes", "mixed_cabin"]
RESPONSE = ["origin", "destination", "travel_date", "scraped_at_utc"]  # one landed response

# --- fixed values: provider cabin vocabularies and markers ---
ETIHAD_CABINS = {"economy": "economy", "premiumeconomy": "premium_economy", "premium economy": "premium_economy",
                 "premium": "premium_economy", "business": "business", "first": "first"}
TURKISH_CABINS = {"ECONOMY": "economy", "PREMIUMECONOMY": "premium_economy", "PREMIUM_ECONOMY": "premium_economy",
                  "PREMIUM": "premium_economy", "BUSINESS": "business", "FIRST": "first"}
JETBLUE_CABINS = {"ECONOMY": "economy", "BUSINESS": "business", "PREMIUM": "premium_economy", "FIRST": "first"}
SOUTHWEST_SAVER_PREFIXES = ("WGA", "PLU")
JETBLUE_POINTS_CURRENCY = "FFCURRENCY"
JETBLUE_SAVER_BRAND = "AN"
TURKISH_MILES_CURRENCY = "MILE"
HHMM_RE = r"(\d{1,2}):(\d{2})"
# --- end fixed values ---


def lookup(mapping: dict, key: Column) -> Column:
    """Literal dictionary lookup (bounded vocabularies only); unknown keys -> null."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def _record(df: DataFrame, airline: str, source: str, keep=(), **cols) -> DataFrame:
    base = {
        "origin": F.upper("origin"), "destination": F.upper("destination"), "date": F.col("travel_date"),
        "airline": F.lit(airline), "source": F.lit(source), "scraped_at_utc": F.col("scraped_at_utc"),
        "partner_airline": F.lit(None).cast("string"), "duration_minutes": F.lit(None).cast("int"),
        "is_saver": F.lit(False), "fare_class": F.lit(None).cast("string"),
        "layover_airports": F.lit(None).cast("string"), "next_day_arrival": F.lit(False),
        "available_seats": F.lit(-1),
    }
    base.update(cols)
    casts = {"cash_cost": "decimal(8,2)", "points_cost": "int", "stops": "int", "available_seats": "int",
             "duration_minutes": "int"}
    recs = df.select(*[(base[c].try_cast(casts[c]) if c in casts else base[c]).alias(c) for c in RECORD_COLS], *keep)
    return recs.filter(F.col("points_cost").isNotNull() & F.col("cash_cost").isNotNull() & F.col("stops").isNotNull())


def _details(wanted: bool, departure, arrival, aircraft=None, layover_minutes=None, mixed=None) -> list[Column]:
    """DETAIL_COLS for ``_record``: local wall clocks at the two airports, aircraft code, minutes between legs."""
    if not wanted:
        return []
    none = F.lit(None)
    aircraft = none.cast("string") if aircraft is None else F.when(F.length(aircraft) > 0, F.substring(aircraft, 1, 10))
    minutes = none if layover_minutes is None else layover_minutes
    return [departure.cast("timestamp_ntz").alias("departure_time_local"), arrival.cast("timestamp_ntz").alias("arrival_time_local"),
            aircraft.alias("aircraft_type"), minutes.cast("int").alias("layover_duration_minutes"),
            (F.lit(False) if mixed is None else mixed).alias("mixed_cabin")]


def _sum(minutes: Column) -> Column:
    """Sum of an array of minutes; null when it is null or empty."""
    return F.when(F.size(minutes) > 0, F.aggregate(minutes, F.lit(0).cast("bigint"), lambda a, b: a + b))


def _wall_clock(iso: Column) -> Column:
    """The local clock of an ISO time with offset, to the minute."""
    return F.try_to_timestamp(F.substring(iso, 1, 16), F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz")


def with_zone(df: DataFrame, airports: DataFrame) -> DataFrame:
    """Zones ``_otz`` and ``_dtz`` of a response's airports (a bounded dimension; null where unknown)."""
    z = airports.select("iata", "tz")
    return df.join(F.broadcast(z.withColumnRenamed("iata", "_o").withColumnRenamed("tz", "_otz")), F.upper(df["origin"]) == F.col("_o"), "left") \
             .join(F.broadcast(z.withColumnRenamed("iata", "_d").withColumnRenamed("tz", "_dtz")), F.upper(df["destination"]) == F.col("_d"), "left")


def first_wins(recs: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """win_first_wins inside one payload: first record per (flight number, cabin) in payload order."""
    key = ["origin", "destination", "date", "scraped_at_utc", "raw_flight_number", "cabin_class"]
    cols = [c for c in recs.columns if c != ordinal]
    vals = [c for c in cols if c not in key]
    g = recs.groupBy(*key).agg(F.min_by(F.struct(*vals), F.col(ordinal)).alias("_v"))
    return g.select(*key, "_v.*").select(*cols)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column worked out once a row. Spark pushes filters below the select of the columns they read, with
    a copy of the expression for each condition; a generator's output stays where it is."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _clocks(df: DataFrame, departure: Column, arrival: Column) -> tuple[DataFrame, Column, Column]:
    """``df`` with the local times of a trip read once; the duration, the next-day flag and the details each name them."""
    return _once(df, "_clock", F.struct(departure.alias("dep"), arrival.alias("arr"))), F.col("_clock.dep"), F.col("_clock.arr")


def quarantined(bronze: DataFrame, root: str) -> DataFrame:
    """Responses that no flattener can read, with a reason: ``missing`` (null or blank payload),
    ``malformed`` (not JSON) or ``unexpected_shape`` (nothing at the JSON path ``root`` that holds the offers)."""
    v = F.try_parse_json("payload")
    reason = (F.when(F.coalesce(F.trim("payload"), F.lit("")) == "", "missing").when(v.isNull(), "malformed")
              .when(F.try_variant_get(v, root, "variant").isNull(), "unexpected_shape"))
    return bronze.withColumn("reason", reason).filter(F.col("reason").isNotNull())


# ------------------------------------------------------------------ Etihad: cards[] x cabins[]
ETIHAD_SCHEMA = ("struct<cards: array<struct<depTime: string, arrTime: string, origin: string, dest: string, "
                 "dayDiff: string, duration: string, nonstop: boolean, flightNumbers: array<string>, "
                 "cabins: array<struct<cabin: string, miles: bigint, cashCents: bigint>>>>>")


def flatten_etihad(bronze: DataFrame, airports: DataFrame | None = None, details: bool = False) -> DataFrame:
    """nrm_etihad: one record per (card x priced cabin). Stops from the flight numbers, else the
    nonstop flag; '+N' arrival badge; partner = a carrier other than EY; first (flight, cabin) wins. ``details`` need the
    airports: a clock at an airport without a known zone is dropped."""
    p = bronze.withColumn("_p", F.from_json("payload", ETIHAD_SCHEMA))
    c = p.select(*RESPONSE, F.posexplode(F.coalesce(F.col("_p.cards"), F.array())).alias("card_pos", "card"))
    fns = F.filter(F.transform(F.coalesce(F.col("card.flightNumbers"), F.array().cast("array<string>")), lambda n: F.trim(n)),
                   lambda n: n != "")
    c = c.withColumn("_fns", fns)
    carriers = F.transform("_fns", lambda n: F.regexp_extract(n, r"^([A-Z0-9]{2})\b", 1))
    c = c.select("*",
                 F.when(F.size("_fns") > 0, F.array_join("_fns", "+")).otherwise(F.lit("UNKNOWN")).alias("_raw_fn"),
                 F.when(F.size("_fns") > 0, F.size("_fns") - 1)
                  .otherwise(F.when(F.col("card.nonstop"), 0).otherwise(1)).alias("_stops"),
                 F.get(F.filter(carriers, lambda x: (x != "") & (x != "EY")), 0).alias("_partner"),
                 duration_text(F.col("card.duration")).alias("_dur"),
                 day_offset(F.col("card.dayDiff")).alias("_off"))
    k = c.select("*", F.posexplode(F.coalesce(F.col("card.cabins"), F.array())).alias("cab_pos", "cab"))
    k = k.withColumn("_cabin", lookup(ETIHAD_CABINS, F.lower(F.trim(F.coalesce("cab.cabin", F.lit(""))))))
    k = k.filter(F.col("_cabin").isNotNull() & (F.col("cab.miles") > 0))
    cash = F.coalesce(F.round(F.col("cab.cashCents") / 100.0, 2), F.lit(0.0))
    if details:
        k = with_zone(k, airports)
    number = lambda c, i: F.regexp_extract(c, HHMM_RE, i).try_cast("int")
    clock = lambda tz, day, c: F.when(F.col(tz).isNotNull() & c.rlike(HHMM_RE), F.try_make_timestamp_ntz(
        F.year(day), F.month(day), F.day(day), number(c, 1), number(c, 2), F.lit(0)))
    more = _details(details, clock("_otz", F.col("travel_date"), F.col("card.depTime")),
                    clock("_dtz", F.date_add("travel_date", F.coalesce("_off", F.lit(0)).cast("int")), F.col("card.arrTime")))
    recs = _record(k, "EY", "etihad", keep=[F.struct("card_pos", "cab_pos").alias("_ord"), *more],
                   points_cost=F.col("cab.miles"), cash_cost=cash, cabin_class=F.col("_cabin"), stops=F.col("_stops"),
                   raw_flight_number=F.col("_raw_fn"), partner_airline=F.col("_partner"),
                   duration_minutes=F.col("_dur"), next_day_arrival=F.col("_off") > 0)
    return first_wins(recs)


# ------------------------------------------------------------------ Turkish: options[] x fareCategory map
_TK_SEG = ("struct<flightCode: struct<airlineCode: string, flightNumber: string>, departureDateTime: string, "
           "arrivalDateTime: string, arrivalAirportCode: string, equipmentCode: string, carrierAirline: string>")
_TK_FARE = ("struct<bookingPriceInfoList: array<struct<brandCode: string, referencePassengerFare: struct<totalFare: "
            "struct<currencyCode: string, amount: double>>>>>")
TURKISH_SCHEMA = (f"struct<success: boolean, data: struct<originDestinationInformationList: array<struct<"
                  f"originDestinationOptionList: array<struct<segmentList: array<{_TK_SEG}>, "
                  f"fareCategory: map<string, {_TK_FARE}>, lastSeatCount: bigint>>>>>>")


def turkish_payload_ok(p: Column) -> Column:
    """Whole-response guard: success not false, an options list, and every option with
    segments and a non-empty fare map (one malformed option rejects the response)."""
    opts = F.get(p["data"]["originDestinationInformationList"], 0)["originDestinationOptionList"]
    bad = F.exists(opts, lambda o: o.isNull() | (F.coalesce(F.size(o["segmentList"]), F.lit(0)) <= 0)
                   | (F.coalesce(F.size(o["fareCategory"]), F.lit(0)) <= 0))
    return p.isNotNull() & ~F.coalesce(p["success"] == F.lit(False), F.lit(False)) & opts.isNotNull() & ~bad


def flatten_turkish(bronze: DataFrame, airports: DataFrame, details: bool = False) -> DataFrame:
    """nrm_turkish: one record per (option x priced cabin); miles only; 'DD-MM-YYYY HH:MM' local
    times at airport zones; flight numbers lose leading zeros; first (flight, cabin) wins."""
    p = bronze.withColumn("_p", F.from_json("payload", TURKISH_SCHEMA))
    opts = F.get(F.col("_p.data.originDestinationInformationList"), 0)["originDestinationOptionList"]
    # a condition, not a filter: that would parse the payload again for each of its parts
    o = p.select(*RESPONSE, F.posexplode(F.when(turkish_payload_ok(F.col("_p")), opts)).alias("opt_pos", "opt"))
    segs = F.col("opt.segmentList")
    nums = F.filter(F.transform(segs, lambda s: F.when(
        s["flightCode"]["airlineCode"].isNotNull() & (s["flightCode"]["airlineCode"] != "") & s["flightCode"]["flightNumber"].isNotNull(),
        F.concat(s["flightCode"]["airlineCode"], F.lit(" "),
                 F.coalesce(s["flightCode"]["flightNumber"].try_cast("int").cast("string"), s["flightCode"]["flightNumber"])))),
        lambda n: n.isNotNull())
    lay = F.filter(F.transform(F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0))), lambda s: s["arrivalAirportCode"]),
                   lambda a: a.isNotNull())
    carriers = F.filter(F.transform(segs, lambda s: s["carrierAirline"]), lambda c: c.isNotNull() & (c != "") & (c != "TK"))
    z = airports.select("iata", "tz")
    o = o.join(F.broadcast(z.withColumnRenamed("iata", "_o").withColumnRenamed("tz", "_otz")), F.upper(o["origin"]) == F.col("_o"), "left") \
         .join(F.broadcast(z.withColumnRenamed("iata", "_d").withColumnRenamed("tz", "_dtz")), F.upper(o["destination"]) == F.col("_d"), "left")
    dep_local = F.try_to_timestamp(F.trim(F.get(segs, 0)["departureDateTime"]), F.lit("dd-MM-yyyy HH:mm")).cast("timestamp_ntz")
    arr_local = F.try_to_timestamp(F.trim(F.element_at(segs, -1)["arrivalDateTime"]), F.lit("dd-MM-yyyy HH:mm")).cast("timestamp_ntz")
    o, dep_local, arr_local = _clocks(o, dep_local, arr_local)
    dep = F.when(F.col("_otz").isNotNull(), F.convert_timezone(F.col("_otz"), F.lit("UTC"), dep_local))
    arr = F.when(F.col("_dtz").isNotNull(), F.convert_timezone(F.col("_dtz"), F.lit("UTC"), arr_local))
    d = F.timestamp_diff("MINUTE", dep, arr)
    seats = F.col("opt.lastSeatCount")
    o = o.select("*", F.when(F.size(nums) > 0, F.array_join(nums, "+")).otherwise(F.lit("UNKNOWN")).alias("_raw_fn"),
                 F.greatest(F.size(segs) - 1, F.lit(0)).alias("_stops"),
                 F.when(F.size(lay) > 0, F.array_join(lay, ",")).alias("_lay"),
                 F.get(carriers, 0).alias("_partner"), F.when(d > 0, d).alias("_dur"),
                 (F.coalesce(F.to_date(arr_local) > F.col("travel_date"), F.lit(False)) & arr.isNotNull()).alias("_next_day"),
                 F.when(seats >= 0, seats).otherwise(F.lit(-1)).alias("_seats"))
    f = o.select("*", F.posexplode(F.map_entries("opt.fareCategory")).alias("fare_pos", "fare"))
    f = f.withColumn("_cabin", lookup(TURKISH_CABINS, F.upper(F.col("fare.key"))))
    bpi = F.get(F.col("fare.value.bookingPriceInfoList"), 0)
    total = bpi["referencePassengerFare"]["totalFare"]
    f = f.withColumn("_miles", F.when((total["currencyCode"] == TURKISH_MILES_CURRENCY) & (total["amount"] > 0),
                                      total["amount"].try_cast("long")))
    f = f.filter(F.col("_cabin").isNotNull() & F.col("_miles").isNotNull())
    brand = bpi["brandCode"]
    more = _details(details, F.when(F.col("_otz").isNotNull(), dep_local), F.when(F.col("_dtz").isNotNull(), arr_local),
                    F.get(segs, 0)["equipmentCode"])
    recs = _record(f, "TK", "turkish", keep=[F.struct("opt_pos", "fare_pos").alias("_ord"), *more],
                   points_cost=F.col("_miles"), cash_cost=F.lit(0.0), cabin_class=F.col("_cabin"),
                   stops=F.col("_stops"), available_seats=F.col("_seats"), raw_flight_number=F.col("_raw_fn"),
                   partner_airline=F.col("_partner"), duration_minutes=F.col("_dur"),
                   fare_class=F.when(F.length(brand) > 0, F.substring(brand, 1, 10)),
                   layover_airports=F.col("_lay"), next_day_arrival=F.col("_next_day"))
    return first_wins(recs)


# ------------------------------------------------------------------ JetBlue: productOffers[] x offers[]
_JB_SEG = ("struct<flightInfo: struct<marketingAirlineCode: string, marketingFlightNumber: string, "
           "operatingAirlineCode: string>, aircraftCode: string, arrival: struct<airport: string>, layoverDuration: bigint>")
JETBLUE_SCHEMA = (f"struct<data: struct<searchResults: array<struct<productOffers: array<struct<"
                  f"originAndDestination: array<struct<departure: struct<date: string>, arrival: struct<date: string>, "
                  f"stops: bigint, totalDuration: bigint, flightSegments: array<{_JB_SEG}>>>, "
                  f"offers: array<struct<soldOut: boolean, price: array<struct<currency: string, amount: double>>, "
                  f"cabinClass: string, seatsRemaining: struct<count: bigint>, offerSegmentInfo: array<struct<bookingClass: string>>, "
                  f"brand: struct<brandId: string>>>>>>>>>")


def price_by_currency(prices: Column, currency: str) -> Column:
    """fn_price_by_currency: amount of the first entry in ``currency`` with a numeric amount."""
    return F.get(F.filter(prices, lambda e: (e["currency"] == currency) & e["amount"].isNotNull()), 0)["amount"]


def flatten_jetblue(bronze: DataFrame, airports: DataFrame, details: bool = False) -> DataFrame:
    """nrm_jetblue: one record per bookable offer with a points price; sold-out offers, offers
    without points and unknown cabins are skipped; ISO local times at airport zones."""
    p = bronze.withColumn("_p", F.from_json("payload", JETBLUE_SCHEMA))
    r = p.select(*RESPONSE, F.posexplode(F.coalesce(F.col("_p.data.searchResults"), F.array())).alias("res_pos", "res"))
    r = r.select(*RESPONSE, "res_pos", F.posexplode(F.coalesce(F.col("res.productOffers"), F.array())).alias("prod_pos", "prod"))
    it = F.get(F.col("prod.originAndDestination"), 0)
    segs = it["flightSegments"]
    r = r.filter(it.isNotNull() & (F.coalesce(F.size(segs), F.lit(0)) > 0))
    nums = F.filter(F.transform(segs, lambda s: F.when(
        s["flightInfo"]["marketingAirlineCode"].isNotNull() & (s["flightInfo"]["marketingAirlineCode"] != "")
        & s["flightInfo"]["marketingFlightNumber"].isNotNull(),
        F.concat(s["flightInfo"]["marketingAirlineCode"], F.lit(" "), s["flightInfo"]["marketingFlightNumber"]))),
        lambda n: n.isNotNull())
    inner = F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0)))
    lay = F.filter(F.transform(inner, lambda s: F.upper(s["arrival"]["airport"])), lambda a: F.length(a) == 3)
    lay_mins = F.filter(F.transform(inner, lambda s: s["layoverDuration"]), lambda m: m > 0)
    ops = F.filter(F.transform(segs, lambda s: s["flightInfo"]["operatingAirlineCode"]),
                   lambda c: c.isNotNull() & (c != "") & (c != "B6"))
    z = airports.select("iata", "tz")
    r = r.join(F.broadcast(z.withColumnRenamed("iata", "_o").withColumnRenamed("tz", "_otz")), F.upper(r["origin"]) == F.col("_o"), "left") \
         .join(F.broadcast(z.withColumnRenamed("iata", "_d").withColumnRenamed("tz", "_dtz")), F.upper(r["destination"]) == F.col("_d"), "left")
    dep_l = F.try_to_timestamp(it["departure"]["date"], F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    arr_l = F.try_to_timestamp(it["arrival"]["date"], F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    r, dep_l, arr_l = _clocks(r, dep_l, arr_l)
    dep = F.when(F.col("_otz").isNotNull(), F.convert_timezone(F.col("_otz"), F.lit("UTC"), dep_l))
    arr = F.when(F.col("_dtz").isNotNull(), F.convert_timezone(F.col("_dtz"), F.lit("UTC"), arr_l))
    dur = F.when(it["totalDuration"] > 0, it["totalDuration"]).otherwise(F.timestamp_diff("MINUTE", dep, arr))
    r = r.select("*", F.when(F.size(nums) > 0, F.array_join(nums, "+")).otherwise(F.lit("UNKNOWN")).alias("_raw_fn"),
                 F.when(it["stops"] >= 0, it["stops"]).otherwise(F.greatest(F.size(segs) - 1, F.lit(0))).alias("_stops"),
                 F.when(F.size(lay) > 0, F.array_join(lay, ",")).alias("_lay"), F.get(ops, 0).alias("_partner"),
                 dur.alias("_dur"), (arr.isNotNull() & F.coalesce(F.to_date(arr_l) > F.col("travel_date"), F.lit(False))).alias("_nd"),
                 F.when(F.size(lay_mins) > 0, F.aggregate(lay_mins, F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("_lay_min"))
    o = r.select("*", F.posexplode(F.coalesce(F.col("prod.offers"), F.array())).alias("off_pos", "off"))
    pts = price_by_currency(F.col("off.price"), JETBLUE_POINTS_CURRENCY)
    cash = price_by_currency(F.col("off.price"), "USD")
    o = o.withColumn("_cabin", lookup(JETBLUE_CABINS, F.upper(F.col("off.cabinClass"))))
    o = o.filter(~F.coalesce(F.col("off.soldOut"), F.lit(False)) & (pts > 0) & F.col("_cabin").isNotNull())
    bc = F.get(F.col("off.offerSegmentInfo"), 0)["bookingClass"]
    craft = F.get(F.filter(F.transform(segs, lambda s: s["aircraftCode"]), lambda a: F.length(a) > 0), 0)
    more = _details(details, F.when(F.col("_otz").isNotNull(), dep_l), F.when(F.col("_dtz").isNotNull(), arr_l), craft, F.col("_lay_min"))
    recs = _record(o, "B6", "jetblue", keep=more, points_cost=pts.try_cast("long"), cash_cost=F.coalesce(cash, F.lit(0.0)),
                   cabin_class=F.col("_cabin"), stops=F.col("_stops"),
                   available_seats=F.coalesce(F.col("off.seatsRemaining.count"), F.lit(-1)),
                   raw_flight_number=F.col("_raw_fn"), partner_airline=F.col("_partner"), duration_minutes=F.col("_dur"),
                   is_saver=F.coalesce(F.col("off.brand.brandId") == JETBLUE_SAVER_BRAND, F.lit(False)),
                   fare_class=F.when(F.length(bc) > 0, F.substring(bc, 1, 10)), layover_airports=F.col("_lay"),
                   next_day_arrival=F.col("_nd"))
    return recs


# ------------------------------------------------------------------ Southwest: details[] x fare families
_WN_FP = ("struct<availabilityStatus: string, fare: struct<totalFare: struct<value: string>, "
          "totalTaxesAndFees: struct<value: string>>, productId: string>")
SOUTHWEST_SCHEMA = (f"struct<data: struct<searchResults: struct<airProducts: array<struct<details: array<struct<"
                    f"totalDuration: bigint, nextDay: boolean, fareProducts: struct<ADULT: map<string, {_WN_FP}>>>>>>>>>")


def cheapest_available(families: Column) -> Column:
    """agg_cheapest_available: AVAILABLE family with points > 0 and the fewest points; the first
    family in payload order wins ties. Returns struct(family, points, fp) or null."""
    entries = F.transform(F.map_entries(families), lambda e, i: F.struct(
        e["key"].alias("family"), F.floor(e["value"]["fare"]["totalFare"]["value"].try_cast("double")).try_cast("long").alias("points"),
        i.alias("pos"), e["value"].alias("fp")))
    ok = F.filter(entries, lambda e: (e["fp"]["availabilityStatus"] == "AVAILABLE") & (e["points"] > 0))
    best = F.aggregate(ok, F.lit(None).cast("struct<family:string,points:bigint,pos:int,fp:" + _WN_FP + ">"),
                       lambda acc, e: F.when(acc.isNull() | (e["points"] < acc["points"]), e).otherwise(acc))
    return best


def product_segments(product_id: Column) -> Column:
    """Decode '<FAMILY>|f,f,...(10)|...' into segment structs; segments with < 10 fields are skipped."""
    fields = F.split(product_id, r"\|")
    chunks = F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0)))
    parts = F.transform(chunks, lambda c: F.split(c, ","))
    full = F.filter(parts, lambda f: F.size(f) >= 10)
    return F.transform(full, lambda f: F.struct(
        f[1].alias("booking_class"), f[3].alias("dest"), f[4].alias("depart"), f[5].alias("arrive"),
        f[8].alias("flight_num"), f[9].alias("aircraft")))


def flatten_southwest(bronze: DataFrame, details: bool = False) -> DataFrame:
    """nrm_southwest: one economy record per itinerary detail, priced by its cheapest available
    fare family; legs decoded from the packed productId; saver families by prefix."""
    p = bronze.withColumn("_p", F.from_json("payload", SOUTHWEST_SCHEMA))
    a = p.select(*RESPONSE, F.posexplode(F.coalesce(F.col("_p.data.searchResults.airProducts"), F.array())).alias("ap_pos", "ap"))
    d = a.select(*RESPONSE, "ap_pos", F.posexplode(F.coalesce(F.col("ap.details"), F.array())).alias("det_pos", "det"))
    d = _once(d, "_best", cheapest_available(F.coalesce(F.col("det.fareProducts.ADULT"),
                                                        F.create_map().cast("map<string," + _WN_FP + ">"))))
    d = d.filter(F.col("_best").isNotNull())
    d = _once(d, "_segs", product_segments(F.col("_best.fp.productId"))).filter(F.size("_segs") > 0)
    segs = F.col("_segs")
    inner = F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0)))
    lay = F.filter(F.transform(inner, lambda s: s["dest"]), lambda x: F.length(x) == 3)
    at = lambda t: F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mmXXX"))
    gaps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(segs) - 1, F.lit(1))), lambda i: F.when(
        F.size(segs) > 1, F.timestamp_diff("MINUTE", at(F.element_at(segs, i)["arrive"]), at(F.element_at(segs, i + 1)["depart"]))))
    known = F.filter(gaps, lambda g: g.isNotNull())
    lay_min = F.when(F.size(segs) > 1, F.aggregate(known, F.lit(None).cast("bigint"), lambda x, y: F.coalesce(x, F.lit(0)) + y))
    taxes = F.col("_best.fp.fare.totalTaxesAndFees.value").try_cast("double")
    fam = F.upper(F.col("_best.family"))
    bc = F.get(segs, 0)["booking_class"]
    more = _details(details, _wall_clock(F.get(segs, 0)["depart"]), _wall_clock(F.element_at(segs, -1)["arrive"]), F.get(segs, 0)["aircraft"], F.col("_lay_min"))
    recs = _record(d.withColumn("_lay_min", lay_min), "WN", "southwest", keep=more,
                   points_cost=F.col("_best.points"), cash_cost=F.coalesce(taxes, F.lit(0.0)),
                   cabin_class=F.lit("economy"), stops=F.size(segs) - 1,
                   raw_flight_number=F.array_join(F.transform(segs, lambda s: F.concat(F.lit("WN "), s["flight_num"])), "+"),
                   duration_minutes=F.col("det.totalDuration"),
                   is_saver=fam.startswith(SOUTHWEST_SAVER_PREFIXES[0]) | fam.startswith(SOUTHWEST_SAVER_PREFIXES[1]),
                   fare_class=F.when(F.length(bc) > 0, F.substring(bc, 1, 10)),
                   layover_airports=F.when(F.size(lay) > 0, F.array_join(lay, ",")),
                   next_day_arrival=F.coalesce(F.col("det.nextDay"), F.lit(False)))
    return recs


# ------------------------------------------------------------------ Delta: offer sets x offers x fare information
# --- fixed values: brand id -> cabin, first matching substring wins (in this order) ---
DELTA_CABIN_RULES = [
    ("DELTA_ONE", "business"), ("DELTAONE", "business"), ("DELTA ONE", "business"), ("CD1", "business"),
    ("AFST", "business"), ("BUSINESS", "business"), ("CDPS", "premium_economy"), ("PREMIUM_SELECT", "premium_economy"),
    ("PREMIUM SELECT", "premium_economy"), ("AFPE", "premium_economy"), ("PREMIUM", "premium_economy"),
    ("COMFORT", "economy"), ("DCP", "economy"), ("FIRST", "first"), ("BASIC", "economy"), ("MAIN", "economy"),
    ("ECONOMY", "economy"),
]
CABIN_RANK = {"business": 4, "first": 3, "premium_economy": 2, "economy": 1}
# --- end fixed values ---

_DHM = "struct<dayCnt: bigint, hourCnt: bigint, minuteCnt: bigint>"
_DL_PRICE = "struct<totalFarePrice: struct<milesEquivalentPrice: struct<mileCnt: double>, currencyEquivalentPrice: struct<roundedCurrencyAmt: double>>>"
_DL_CARRIER = "struct<carrierCode: string, carrierNum: string>"
_DL_LEG = (f"struct<marketingCarrier: {_DL_CARRIER}, operatingCarrier: {_DL_CARRIER}, aircraft: struct<fleetTypeCode: string, "
           f"subFleetTypeCode: string>, layover: struct<destinationAirportCode: string, layoverDuration: {_DHM}>>")
DELTA_SCHEMA = (f"struct<data: struct<gqlSearchOffers: struct<gqlOffersSets: array<struct<"
                f"trips: array<struct<stopCnt: bigint, scheduledDepartureLocalTs: string, scheduledArrivalLocalTs: string, "
                f"totalTripTime: {_DHM}, flightSegment: array<struct<marketingCarrier: {_DL_CARRIER}, "
                f"operatingCarrier: {_DL_CARRIER}, flightLeg: array<{_DL_LEG}>>>>>, "
                f"offers: array<struct<additionalOfferProperties: struct<fareType: string, dominantSegmentBrandId: string>, "
                f"offerItems: array<struct<retailItems: array<struct<retailItemMetaData: struct<fareInformation: array<struct<"
                f"brandByFlightLegs: array<struct<brandId: string, cosCode: string>>, availableSeatCnt: bigint, "
                f"farePrice: string>>>>>>>>>>>>>>")


def brand_to_cabin(brand: Column) -> Column:
    """fn_brand_to_cabin: the first rule whose token occurs in the upper-cased brand id."""
    key = F.upper(brand)
    out = None
    for token, cabin in DELTA_CABIN_RULES:
        cond = key.contains(token)
        out = F.when(cond, F.lit(cabin)) if out is None else out.when(cond, F.lit(cabin))
    return F.when(F.length(brand) > 0, out)


def most_premium(cabins: Column) -> Column:
    """fn_most_premium: business > first > premium economy > economy; null if none."""
    ranked = F.filter(F.transform(cabins, lambda c: F.struct(lookup(CABIN_RANK, c).alias("r"), c.alias("c"))),
                      lambda x: x["r"].isNotNull())
    return F.when(F.size(ranked) > 0, F.array_max(ranked)["c"])


def dhm_minutes(d: Column) -> Column:
    """fn_duration_dhm: {dayCnt, hourCnt, minuteCnt} -> minutes; <= 0 -> null."""
    t = F.coalesce(d["dayCnt"], F.lit(0)) * 1440 + F.coalesce(d["hourCnt"], F.lit(0)) * 60 + F.coalesce(d["minuteCnt"], F.lit(0))
    return F.when(d.isNotNull() & (t > 0), t)


def _carrier_nums(items: Column) -> Column:
    nums = F.transform(items, lambda s: F.coalesce(s["marketingCarrier"], s["operatingCarrier"]))
    nums = F.transform(nums, lambda c: F.when((F.length(c["carrierCode"]) > 0) & (F.length(c["carrierNum"]) > 0),
                                              F.concat(c["carrierCode"], F.lit(" "), c["carrierNum"])))
    return F.filter(nums, lambda n: n.isNotNull())


def flatten_delta(bronze: DataFrame, airports: DataFrame, details: bool = False) -> DataFrame:
    """nrm_delta: one record per priced branded fare. Cabin from the dominant brand, else the
    most premium leg brand; farePrice may be a list or an object; trip duration from the
    day/hour/minute object, else arrival - departure instants."""
    p = bronze.withColumn("_p", F.from_json("payload", DELTA_SCHEMA))
    s = p.select(*RESPONSE, F.posexplode(F.coalesce(F.col("_p.data.gqlSearchOffers.gqlOffersSets"), F.array())).alias("set_pos", "os"))
    trip = F.get(F.col("os.trips"), 0)
    s = s.filter(trip.isNotNull()).withColumn("_trip", trip)
    legs = F.flatten(F.transform(F.coalesce(F.col("_trip.flightSegment"), F.array()), lambda g: F.coalesce(g["flightLeg"], F.array())))
    s = _once(s, "_legs", legs)
    nums = F.when(F.size(_carrier_nums(F.col("_trip.flightSegment"))) > 0, _carrier_nums(F.col("_trip.flightSegment"))) \
            .otherwise(_carrier_nums(F.col("_legs")))
    lay = F.filter(F.transform("_legs", lambda l: F.upper(l["layover"]["destinationAirportCode"])), lambda a: F.length(a) == 3)
    z = airports.select("iata", "tz")
    s = s.join(F.broadcast(z.withColumnRenamed("iata", "_o").withColumnRenamed("tz", "_otz")), F.upper(s["origin"]) == F.col("_o"), "left") \
         .join(F.broadcast(z.withColumnRenamed("iata", "_d").withColumnRenamed("tz", "_dtz")), F.upper(s["destination"]) == F.col("_d"), "left")
    iso = F.lit("yyyy-MM-dd'T'HH:mm:ss")
    dep_l = F.try_to_timestamp(F.regexp_replace("_trip.scheduledDepartureLocalTs", "Z", ""), iso).cast("timestamp_ntz")
    arr_l = F.try_to_timestamp(F.regexp_replace("_trip.scheduledArrivalLocalTs", "Z", ""), iso).cast("timestamp_ntz")
    s, dep_l, arr_l = _clocks(s, dep_l, arr_l)
    dep = F.when(F.col("_otz").isNotNull(), F.convert_timezone(F.col("_otz"), F.lit("UTC"), dep_l))
    arr = F.when(F.col("_dtz").isNotNull(), F.convert_timezone(F.col("_dtz"), F.lit("UTC"), arr_l))
    diff = F.timestamp_diff("MINUTE", dep, arr)
    craft = F.get(F.col("_legs"), 0)["aircraft"]
    waits = F.filter(F.transform("_legs", lambda l: dhm_minutes(l["layover"]["layoverDuration"])), lambda m: m.isNotNull())
    more = _details(details, F.when(F.col("_otz").isNotNull(), dep_l), F.when(F.col("_dtz").isNotNull(), arr_l),
                    F.coalesce(F.when(F.length(craft["fleetTypeCode"]) > 0, craft["fleetTypeCode"]), craft["subFleetTypeCode"]), _sum(waits))[:-1]
    trip_cols = ["_stops", "_dur", "_raw_fn", "_lay", "_nd", *(DETAIL_COLS[:-1] if details else [])]  # all that a fare needs of its trip
    s = s.select(*RESPONSE, "os", *more, F.coalesce(F.col("_trip.stopCnt"), F.greatest(F.size("_legs") - 1, F.lit(0))).alias("_stops"),
                 F.coalesce(dhm_minutes(F.col("_trip.totalTripTime")), F.when(diff > 0, diff)).alias("_dur"),
                 F.when(F.size(nums) > 0, F.array_join(nums, "+")).otherwise(F.lit("UNKNOWN")).alias("_raw_fn"),
                 F.when(F.size(lay) > 0, F.array_join(lay, ",")).alias("_lay"),
                 (arr.isNotNull() & F.coalesce(F.to_date(arr_l) > F.col("travel_date"), F.lit(False))).alias("_nd"))
    o = s.select(*RESPONSE, *trip_cols, F.explode(F.coalesce(F.col("os.offers"), F.array())).alias("off"))
    fis = F.flatten(F.transform(F.coalesce(F.col("off.offerItems"), F.array()), lambda it: F.flatten(F.transform(
        F.coalesce(it["retailItems"], F.array()), lambda ri: F.coalesce(ri["retailItemMetaData"]["fareInformation"], F.array())))))
    offer = F.col("off.additionalOfferProperties")
    f = o.select(*RESPONSE, *trip_cols, offer["fareType"].alias("_type"), offer["dominantSegmentBrandId"].alias("_brand"), F.explode(fis).alias("fi"))
    brands = F.filter(F.coalesce(F.col("fi.brandByFlightLegs"), F.array()), lambda b: F.length(b["brandId"]) > 0)
    leg_cabins = F.filter(F.transform(brands, lambda b: brand_to_cabin(b["brandId"])), lambda c: c.isNotNull())
    cabin = F.coalesce(brand_to_cabin(F.col("_brand")), most_premium(leg_cabins))
    raw_price = F.col("fi.farePrice")
    price = F.when(F.trim(raw_price).startswith("["), F.get(F.from_json(raw_price, f"array<{_DL_PRICE}>"), 0)) \
             .otherwise(F.from_json(raw_price, _DL_PRICE))
    f = _once(f, "_fare", F.struct(price.alias("price"), cabin.alias("cabin")))
    f = f.select("*", F.col("_fare.cabin").alias("_cabin"), F.col("_fare.price.totalFarePrice.milesEquivalentPrice.mileCnt").alias("_miles"),
                 F.col("_fare.price.totalFarePrice.currencyEquivalentPrice.roundedCurrencyAmt").alias("_cash"),
                 F.get(F.filter(F.coalesce(F.col("fi.brandByFlightLegs"), F.array()), lambda b: F.length(b["cosCode"]) > 0), 0)["cosCode"].alias("_cos"),
                 (F.size(F.array_distinct(leg_cabins)) > 1).alias("_mixed"))
    f = f.filter(F.col("_cabin").isNotNull() & (F.col("_miles") > 0))
    ft = F.col("_type")
    recs = _record(f, "DL", "delta", keep=[*(DETAIL_COLS[:-1] if details else []), F.col("_mixed").alias("mixed_cabin")],
                   points_cost=F.col("_miles").try_cast("long"), cash_cost=F.coalesce(F.col("_cash"), F.lit(0.0)),
                   cabin_class=F.col("_cabin"), stops=F.col("_stops"),
                   available_seats=F.coalesce(F.col("fi.availableSeatCnt"), F.lit(-1)), raw_flight_number=F.col("_raw_fn"),
                   duration_minutes=F.col("_dur"), is_saver=F.coalesce(F.upper(ft).contains("AWARD"), F.lit(False)),
                   fare_class=F.when(F.length("_cos") > 0, F.substring("_cos", 1, 10)), layover_airports=F.col("_lay"),
                   next_day_arrival=F.col("_nd"))
    return recs


# ------------------------------------------------------------------ Alaska: dehydrated flat array with references
# --- fixed values: solution key -> cabin ---
ALASKA_CABINS = {
    "REFUNDABLE_FIRST": "first", "SAVER_FIRST": "first", "FIRST": "first", "REFUNDABLE_PREMIUM": "premium_economy",
    "SAVER_PREMIUM": "premium_economy", "PREMIUM": "premium_economy", "REFUNDABLE_MAIN": "economy", "SAVER_MAIN": "economy",
    "MAIN": "economy", "SAVER": "economy", "REFUNDABLE_BUSINESS": "business", "SAVER_BUSINESS": "business",
    "BUSINESS": "business",
}
# --- end fixed values ---
ALASKA_SCHEMA = "struct<chunks: array<struct<type: string, data: array<string>>>>"
_AS_ROW = "struct<segments: bigint, solutions: bigint, totalDuration: bigint, duration: bigint>"
_AS_SEG = ("struct<publishingCarrier: bigint, displayCarrier: bigint, departureDateTime: bigint, departureTime: bigint, "
           "arrivalDateTime: bigint, arrivalTime: bigint, arrivalAirportCode: bigint, arrivalStation: bigint, "
           "destinationCode: bigint, equipmentCode: bigint>")
_AS_SOL = "struct<atmosPoints: bigint, grandTotal: bigint, seatsRemaining: bigint, bookingCode: bigint, fareClass: bigint, bookingClass: bigint>"


def _deref(flat: Column, ref: Column) -> Column:
    """The flat-array element a reference points at (raw JSON text); -1 / out of range -> null."""
    return F.get(flat, ref.try_cast("int"))  # the reference is read once: it may be a parsed fragment


def _obj(flat: Column, ref: Column, schema: str) -> Column:
    return F.from_json(_deref(flat, ref), schema)


def flatten_alaska(bronze: DataFrame, details: bool = False) -> DataFrame:
    """nrm_alaska_deref: locate the chunk whose root has 'rows', then resolve integer references
    through the flat array (rows -> segments / solutions -> primitives); one record per priced
    solution. Depth is fixed by the format, so plain expressions resolve it. All references of a response are resolved
    before its rows are exploded: a row carries its own texts, never the flat array that it came from."""
    p = bronze.withColumn("_p", F.from_json("payload", ALASKA_SCHEMA))
    chunk = F.get(F.filter(F.coalesce(F.col("_p.chunks"), F.array()), lambda c: (c["type"] == "chunk") & (
        F.get_json_object(F.get(c["data"], 0), "$.rows").isNotNull())), 0)
    p = p.select(*RESPONSE, chunk["data"].alias("_flat"))  # null without such a chunk, and then without rows
    flat = F.col("_flat")
    longs, none = "array<bigint>", F.array().cast("array<bigint>")
    rows_ref = F.get_json_object(F.get(flat, 0), "$.rows").try_cast("bigint")
    refs = F.coalesce(F.from_json(_deref(flat, rows_ref), longs), none)
    # each step adds what the next one follows
    rows = F.filter(F.transform(refs, lambda ref: _obj(flat, ref, _AS_ROW)), lambda r: r.isNotNull())
    rows = F.transform(rows, lambda r: F.struct(
        F.from_json(_deref(flat, r["segments"]), longs).alias("segs"),
        F.from_json(_deref(flat, r["solutions"]), "map<string,bigint>").alias("sols"),
        F.coalesce(_deref(flat, r["totalDuration"]), _deref(flat, r["duration"])).alias("dur")))
    solution = lambda e: F.struct(e["key"].alias("key"), _obj(flat, e["value"], _AS_SOL).alias("so"))
    rows = F.transform(rows, lambda r: F.struct(
        F.transform(F.coalesce(r["segs"], none), lambda g: _obj(flat, g, _AS_SEG)).alias("segs"),
        F.transform(F.filter(F.map_entries(r["sols"]), lambda e: e["value"] != -1), solution).alias("sols"), r["dur"].alias("dur")))
    rows = F.transform(rows, lambda r: F.struct(F.transform(F.transform(r["segs"], lambda g, i: _alaska_carriers(flat, g, i)), lambda g: _alaska_segment(flat, g)).alias("segs"),
                                                F.transform(r["sols"], lambda e: _alaska_solution(flat, e)).alias("sols"), r["dur"].alias("dur")))
    r = p.select(*RESPONSE, F.explode(rows).alias("_row")).select(*RESPONSE, "_row.segs", "_row.sols", "_row.dur")

    segs = F.col("segs")
    first, last = F.get(segs, 0), F.element_at(segs, -1)
    code, fnum, disp, arr_txt = first["code"], first["num"], first["disp"], last["arr"]
    inner = F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0)))
    lay = F.filter(F.transform(inner, lambda s: F.upper(s["stop"])), lambda a: F.length(a) == 3)
    dur = F.col("dur").try_cast("double")
    out = [F.when((F.size(segs) > 0) & (F.length(code) > 0) & (F.length(fnum) > 0),
                  F.concat(code, F.lit(" "), fnum)).otherwise(F.lit("UNKNOWN")).alias("_raw_fn"),
           F.greatest(F.size(segs) - 1, F.lit(0)).alias("_stops"),
           F.when((F.length(disp) > 0) & (disp != "AS"), disp).alias("_partner"),
           F.when(dur > 0, dur.try_cast("int")).alias("_dur"),
           F.when(F.size(lay) > 0, F.array_join(lay, ",")).alias("_lay"),
           F.coalesce(F.try_to_date(F.substring(arr_txt, 1, 10)) > F.col("travel_date"), F.lit(False)).alias("_nd")]
    if details:  # before the solutions, so that a row's times are read once
        at = lambda t: F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
        n = F.size(segs)
        gaps = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.when(n > 1, F.timestamp_diff(
            "MINUTE", at(F.get(segs, i - 1)["arr"]), at(F.get(segs, i)["dep"]))))
        out += _details(True, _wall_clock(first["dep"]), _wall_clock(arr_txt), first["craft"], _sum(F.filter(gaps, lambda g: g > 0)))
    s = r.select(*RESPONSE, *out, "sols").select("*", F.explode("sols").alias("sol")).drop("sols")
    s = s.withColumn("_cabin", lookup(ALASKA_CABINS, F.upper("sol.key"))).filter(F.col("_cabin").isNotNull() & F.col("sol.known"))
    pts = F.col("sol.pts").try_cast("double")
    fees = F.col("sol.fees").try_cast("double")
    seats_txt, fc = F.col("sol.seats"), F.col("sol.fc")
    s = s.filter(pts > 0)
    recs = _record(s, "AS", "alaska", keep=DETAIL_COLS if details else (), points_cost=pts.try_cast("long"), cash_cost=F.coalesce(fees, F.lit(0.0)),
                   cabin_class=F.col("_cabin"), stops=F.col("_stops"),
                   available_seats=F.when(seats_txt.rlike(r"^-?\d+$"), F.coalesce(seats_txt.try_cast("int"), F.lit(-1))).otherwise(F.lit(-1)),
                   raw_flight_number=F.col("_raw_fn"), partner_airline=F.col("_partner"), duration_minutes=F.col("_dur"),
                   is_saver=F.upper("sol.key").startswith("SAVER"),
                   fare_class=F.when(F.length(fc) > 0, F.substring(fc, 1, 10)), layover_airports=F.col("_lay"),
                   next_day_arrival=F.col("_nd"))
    return recs


def _alaska_carriers(flat: Column, g: Column, i: Column) -> Column:
    """A segment with its carriers; those of a trip are its first segment's."""
    carrier = lambda name, schema: F.when(i == 0, _obj(flat, g[name], schema))
    return F.struct(g.alias("seg"), carrier("publishingCarrier", "struct<carrierCode: bigint, flightNumber: bigint>").alias("pub"),
                    carrier("displayCarrier", "struct<carrierCode: bigint>").alias("disp"))


def _alaska_segment(flat: Column, g: Column) -> Column:
    text = lambda *names: F.coalesce(*[_deref(flat, g["seg"][n]) for n in names])
    return F.struct(_deref(flat, g["pub"]["carrierCode"]).alias("code"), _deref(flat, g["pub"]["flightNumber"]).alias("num"),
                    _deref(flat, g["disp"]["carrierCode"]).alias("disp"), text("departureDateTime", "departureTime").alias("dep"),
                    text("arrivalDateTime", "arrivalTime").alias("arr"), text("arrivalAirportCode", "arrivalStation", "destinationCode").alias("stop"),
                    text("equipmentCode").alias("craft"))


def _alaska_solution(flat: Column, e: Column) -> Column:
    text = lambda *names: F.coalesce(*[_deref(flat, e["so"][n]) for n in names])
    return F.struct(e["key"].alias("key"), e["so"].isNotNull().alias("known"), text("atmosPoints").alias("pts"), text("grandTotal").alias("fees"),
                    text("seatsRemaining").alias("seats"), text("bookingCode", "fareClass", "bookingClass").alias("fc"))
