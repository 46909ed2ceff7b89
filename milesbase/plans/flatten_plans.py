"""Provider flattening plans and the scalar parsers they exercise (§2.8).

Bronze payloads are rendered in the query itself from ``fx_award``: one landed
response per (carrier, route, travel date, scrape time), items in a fixed
order, serialised with ``to_json``. The flatteners only see the JSON text.
The oracle derives the expected records straight from ``fx_award``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import flatten as FL
from milesbase.operators import text_parse
from milesbase.plans import domain as D
from milesbase.plans.registry import query

ITEM = ["raw_flight_number", "cabin_class", "points_cost", "cash_cost", "available_seats", "duration_minutes",
        "dep_min", "stops"]
ITEM_ORDER = ", ".join(ITEM)


def responses(L, airline):
    """One row per landed response (carrier, route, date, scrape time), items in payload order.

    Rendering and parsing a response takes far longer than moving its items, so the shuffle keeps its number of partitions; by
    their bytes alone a provider's responses would be merged into one or two tasks."""
    response = ["origin", "destination", "date", "scraped_at_utc"]
    a = L.fx_award.filter(F.col("airline") == airline).select(*response, *ITEM)
    a = a.repartition(int(L.spark.conf.get("spark.sql.shuffle.partitions")), *response)
    return a.groupBy(*response).agg(
        F.sort_array(F.collect_list(F.struct(*ITEM))).alias("items"))  # array_sort compares through a lambda


def _bronze(df, payload):
    return df.select("origin", "destination", F.col("date").alias("travel_date"), "scraped_at_utc",
                     F.to_json(payload).alias("payload"))


def _hhmm(m):
    return F.concat(F.lpad(X.idiv(m, F.lit(60)).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(F.pmod(m, F.lit(60)).cast("string"), 2, "0"))


def _local(date_col, minutes):
    return date_col.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def _num(raw):
    return F.regexp_extract(raw, r" (\d+)$", 1)


# ------------------------------------------------------------------ bronze renderers
def etihad_bronze(L):
    r = responses(L, "EY")

    def card(i):
        end = i["dep_min"] + i["duration_minutes"]
        dur = i["duration_minutes"]
        raw = i["raw_flight_number"]
        return F.struct(
            _hhmm(i["dep_min"]).alias("depTime"), _hhmm(F.pmod(end, F.lit(1440))).alias("arrTime"),
            F.col("origin").alias("origin"), F.col("destination").alias("dest"),
            F.when(end >= 1440, F.concat(F.lit("+"), X.idiv(end, F.lit(1440)).cast("string"))).otherwise(F.lit("")).alias("dayDiff"),
            F.concat(X.idiv(dur, F.lit(60)).cast("string"), F.lit("h"),
                     F.when(F.pmod(dur, F.lit(60)) > 0, F.concat(F.lit(" "), F.pmod(dur, F.lit(60)).cast("string"), F.lit("m")))
                      .otherwise(F.lit(""))).alias("duration"),
            (i["stops"] == 0).alias("nonstop"),
            F.when(raw == "UNKNOWN", F.array().cast("array<string>"))
             .when(i["stops"] == 1, F.array(raw, F.concat(F.lit("AA "), (F.pmod(i["dep_min"], F.lit(50)) + 200).cast("string"))))
             .otherwise(F.array(raw)).alias("flightNumbers"),
            F.array(F.struct(X.case_map(i["cabin_class"], {"economy": "Economy", "premium_economy": "Premium Economy",
                                                           "business": "Business", "first": "First"}).alias("cabin"),
                             i["points_cost"].cast("long").alias("miles"), X.cents(i["cash_cost"]).alias("cashCents")),
                    F.struct(F.lit("Residence").alias("cabin"), F.lit(1).cast("long").alias("miles"),
                             F.lit(0).cast("long").alias("cashCents"))).alias("cabins"))

    return _bronze(r, F.struct(F.transform("items", card).alias("cards")))


def turkish_bronze(L):
    r = responses(L, "TK")
    fmt = "dd-MM-yyyy HH:mm"

    def opt(i):
        dep = _local(F.col("date"), i["dep_min"])
        arr = _local(F.col("date"), i["dep_min"] + i["duration_minutes"])
        raw = i["raw_flight_number"]
        fc = F.when(raw != "UNKNOWN", F.struct(F.lit("TK").alias("airlineCode"), F.lpad(_num(raw), 4, "0").alias("flightNumber")))
        seg1 = F.struct(fc.alias("flightCode"), F.date_format(dep, fmt).alias("departureDateTime"),
                        F.date_format(F.when(i["stops"] == 1, dep + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(60))).otherwise(arr), fmt).alias("arrivalDateTime"),
                        F.when(i["stops"] == 1, F.lit("IST")).otherwise(F.col("destination")).alias("arrivalAirportCode"),
                        F.lit("77W").alias("equipmentCode"), F.lit("TK").alias("carrierAirline"))
        seg2 = F.struct(F.struct(F.lit("A3").alias("airlineCode"),
                                 F.concat(F.lit("0"), (F.pmod(i["dep_min"], F.lit(90)) + 700).cast("string")).alias("flightNumber")).alias("flightCode"),
                        F.date_format(dep + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(90)), fmt).alias("departureDateTime"),
                        F.date_format(arr, fmt).alias("arrivalDateTime"), F.col("destination").alias("arrivalAirportCode"),
                        F.lit("320").alias("equipmentCode"), F.lit("A3").alias("carrierAirline"))
        key = X.case_map(i["cabin_class"], {"economy": "ECONOMY", "premium_economy": "PREMIUM_ECONOMY",
                                            "business": "BUSINESS", "first": "FIRST"})
        fare = F.struct(F.array(F.struct(
            F.concat(F.lit("TK"), F.upper(F.substring(i["cabin_class"], 1, 2))).alias("brandCode"),
            F.struct(F.struct(F.when(i["available_seats"] == 2, F.lit("TRY")).otherwise(F.lit("MILE")).alias("currencyCode"),
                              i["points_cost"].cast("double").alias("amount")).alias("totalFare")).alias("referencePassengerFare")
        )).alias("bookingPriceInfoList"))
        cats = F.when(i["available_seats"] == 5, F.create_map().cast(f"map<string,{FL._TK_FARE}>")) \
            .otherwise(F.map_from_arrays(F.array(key), F.array(fare)))
        segs = F.when(i["stops"] == 1, F.array(seg1, seg2)).otherwise(F.array(seg1))
        return F.struct(segs.alias("segmentList"), cats.alias("fareCategory"), i["available_seats"].cast("long").alias("lastSeatCount"))

    payload = F.struct((F.pmod(F.hour("scraped_at_utc"), F.lit(17)) != 0).alias("success"),
                       F.struct(F.array(F.struct(F.transform("items", opt).alias("originDestinationOptionList")))
                                .alias("originDestinationInformationList")).alias("data"))
    return _bronze(r, payload)


def jetblue_bronze(L):
    r = responses(L, "B6")
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def product(i):
        dep = _local(F.col("date"), i["dep_min"])
        arr = _local(F.col("date"), i["dep_min"] + i["duration_minutes"])
        raw = i["raw_flight_number"]
        known = raw != "UNKNOWN"
        seg1 = F.struct(F.struct(F.when(known, F.lit("B6")).alias("marketingAirlineCode"),
                                 F.when(known, _num(raw)).alias("marketingFlightNumber"),
                                 F.lit("B6").alias("operatingAirlineCode")).alias("flightInfo"),
                        F.lit("A321").alias("aircraftCode"),
                        F.struct(F.when(i["stops"] == 1, F.lit("BOS")).otherwise(F.col("destination")).alias("airport")).alias("arrival"),
                        F.when(i["stops"] == 1, F.lit(45)).cast("long").alias("layoverDuration"))
        seg2 = F.struct(F.struct(F.lit("B6").alias("marketingAirlineCode"),
                                 (F.pmod(i["dep_min"], F.lit(50)) + 900).cast("string").alias("marketingFlightNumber"),
                                 F.lit("AA").alias("operatingAirlineCode")).alias("flightInfo"),
                        F.lit("E90").alias("aircraftCode"), F.struct(F.col("destination").alias("airport")).alias("arrival"),
                        F.lit(None).cast("long").alias("layoverDuration"))

        def offer(sold):
            return F.struct(F.lit(sold).alias("soldOut"),
                            F.array(F.struct(F.lit("FFCURRENCY").alias("currency"), i["points_cost"].cast("double").alias("amount")),
                                    F.struct(F.lit("USD").alias("currency"), i["cash_cost"].cast("double").alias("amount"))).alias("price"),
                            X.case_map(i["cabin_class"], {"economy": "ECONOMY", "premium_economy": "PREMIUM",
                                                          "business": "BUSINESS", "first": "FIRST"}).alias("cabinClass"),
                            F.when(i["available_seats"] >= 0, F.struct(i["available_seats"].cast("long").alias("count"))).alias("seatsRemaining"),
                            F.array(F.struct(F.upper(F.substring(i["cabin_class"], 1, 1)).alias("bookingClass"))).alias("offerSegmentInfo"),
                            F.struct(F.when(i["cabin_class"] == "economy", F.lit("AN")).otherwise(F.lit("BL")).alias("brandId")).alias("brand"))

        od = F.struct(F.struct(F.date_format(dep, iso).alias("date")).alias("departure"),
                      F.struct(F.date_format(arr, iso).alias("date")).alias("arrival"),
                      i["stops"].cast("long").alias("stops"), i["duration_minutes"].cast("long").alias("totalDuration"),
                      F.when(i["stops"] == 1, F.array(seg1, seg2)).otherwise(F.array(seg1)).alias("flightSegments"))
        return F.struct(F.array(od).alias("originAndDestination"), F.array(offer(False), offer(True)).alias("offers"))

    payload = F.struct(F.struct(F.array(F.struct(F.transform("items", product).alias("productOffers"))).alias("searchResults")).alias("data"))
    return _bronze(r, payload)


def southwest_bronze(L):
    z = L.dim_airport.select(F.col("iata").alias("_iata"), F.coalesce("off_min", F.lit(0)).alias("_off"))
    r = responses(L, "WN")
    r = r.join(F.broadcast(z.withColumnRenamed("_iata", "origin").withColumnRenamed("_off", "_ooff")), "origin", "left") \
         .join(F.broadcast(z.withColumnRenamed("_iata", "destination").withColumnRenamed("_off", "_doff")), "destination", "left")

    def iso(ts, off):
        sign = F.when(off < 0, F.lit("-")).otherwise(F.lit("+"))
        a = F.abs(off)
        return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), sign, F.lpad(X.idiv(a, F.lit(60)).cast("string"), 2, "0"),
                        F.lit(":"), F.lpad(F.pmod(a, F.lit(60)).cast("string"), 2, "0"))

    def with_legs(i):
        """An item with what its three product ids share of their legs: all but the booking class."""
        dep = _local(F.col("date"), i["dep_min"])
        arr = _local(F.col("date"), i["dep_min"] + i["duration_minutes"])
        mins = lambda m: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))
        num2 = (F.pmod(i["dep_min"], F.lit(50)) + 800).cast("string")
        leg = lambda a, b, t, u, num, craft: F.concat_ws(",", a, b, t, u, F.lit("WN"), F.lit("WN"), num, F.lit(craft))
        start, end, num = iso(dep, F.col("_ooff")), iso(arr, F.col("_doff")), _num(i["raw_flight_number"])
        first = leg(F.col("origin"), F.lit("DEN"), start, iso(dep + mins(60), F.col("_ooff")), num, "7M8")
        second = leg(F.lit("DEN"), F.col("destination"), iso(dep + mins(105), F.col("_ooff")), end, num2, "73H")
        unknown = i["raw_flight_number"] == "UNKNOWN"
        return F.struct(i.alias("i"), F.when(unknown, F.lit(None)).when(i["stops"] == 1, first)
                        .otherwise(leg(F.col("origin"), F.col("destination"), start, end, num, "7M8")).alias("leg"),
                        F.when(unknown, F.lit(None)).when(i["stops"] == 1, second).alias("leg2"))

    def detail(x):
        i = x["i"]

        def pid(fam, bc):
            part = lambda leg: F.concat_ws(",", F.lit("Y"), bc, leg)
            segs = F.when(i["raw_flight_number"] == "UNKNOWN", F.concat(F.lit("Y,K,"), F.col("origin"))) \
                .when(i["stops"] == 1, F.concat(part(x["leg"]), F.lit("|"), part(x["leg2"]))).otherwise(part(x["leg"]))
            return F.concat(fam, F.lit("|"), segs)

        def fp(status, pts, cash, fam, bc):
            return F.struct(status.alias("availabilityStatus"),
                            F.struct(F.struct(pts.cast("string").alias("value")).alias("totalFare"),
                                     F.struct(cash.cast("string").alias("value")).alias("totalTaxesAndFees")).alias("fare"),
                            pid(fam, bc).alias("productId"))

        own_fam = X.case_map(i["cabin_class"], {"economy": "WGA", "premium_economy": "PLU", "business": "BIZ", "first": "FST"})
        own = fp(F.when(i["available_seats"] == -1, F.lit("UNAVAILABLE")).otherwise(F.lit("AVAILABLE")), i["points_cost"],
                 i["cash_cost"], own_fam, F.upper(F.substring(i["cabin_class"], 1, 1)))
        any_ = fp(F.lit("AVAILABLE"), i["points_cost"] + 5000, i["cash_cost"] + 10, F.lit("ANY"), F.lit("Y"))
        unav = fp(F.lit("UNAVAILABLE"), i["points_cost"] - 1000, i["cash_cost"], F.lit("UNAV"), F.lit("Y"))
        fams = F.map_from_arrays(F.array(own_fam, F.lit("ANY"), F.lit("UNAV")), F.array(own, any_, unav))
        return F.struct(i["duration_minutes"].cast("long").alias("totalDuration"),
                        (i["dep_min"] + i["duration_minutes"] >= 1440).alias("nextDay"),
                        F.struct(fams.alias("ADULT")).alias("fareProducts"))

    payload = F.struct(F.struct(F.struct(F.array(F.struct(F.transform(F.transform("items", with_legs), detail).alias("details"))).alias("airProducts"))
                                .alias("searchResults")).alias("data"))
    return _bronze(r, payload)


# ------------------------------------------------------------------ expected records (DuckDB)
_REC_SQL = ("upper({a}.origin) AS origin, upper({a}.destination) AS destination, {a}.date AS date, '{al}' AS airline, "
            "'{src}' AS source, CAST({pts} AS INTEGER) AS points_cost, CAST({cash} AS DECIMAL(8,2)) AS cash_cost, "
            "{cabin} AS cabin_class, CAST({a}.stops AS INTEGER) AS stops, CAST({seats} AS INTEGER) AS available_seats, "
            "{rfn} AS raw_flight_number, CAST({partner} AS VARCHAR) AS partner_airline, CAST({dur} AS INTEGER) AS duration_minutes, "
            "{saver} AS is_saver, CAST({fc} AS VARCHAR) AS fare_class, CAST({lay} AS VARCHAR) AS layover_airports, "
            "{nd} AS next_day_arrival, {a}.scraped_at_utc AS scraped_at_utc")
_FIRST = f"QUALIFY row_number() OVER (PARTITION BY a.origin, a.destination, a.date, a.scraped_at_utc, a.rfn, a.cabin_class ORDER BY {', '.join('a.' + c for c in ITEM)}) = 1"

EXP_CTE = f"""
exp_ey AS (SELECT {_REC_SQL.format(a='a', al='EY', src='etihad', pts='a.points_cost', cash='a.cash_cost', cabin='a.cabin_class',
    seats='-1', rfn='a.rfn', partner="CASE WHEN a.raw_flight_number <> 'UNKNOWN' AND a.stops = 1 THEN 'AA' END",
    dur='a.duration_minutes', saver='false', fc='NULL', lay='NULL', nd='a.dep_min + a.duration_minutes >= 1440')}
  FROM (SELECT *, CASE WHEN raw_flight_number = 'UNKNOWN' THEN 'UNKNOWN' WHEN stops = 1 THEN raw_flight_number || '+AA ' || CAST(dep_min % 50 + 200 AS VARCHAR)
   ELSE raw_flight_number END AS rfn FROM fx_award WHERE airline = 'EY') a WHERE a.points_cost > 0 {_FIRST}),
tk_a AS (SELECT *, CASE WHEN raw_flight_number = 'UNKNOWN' THEN (CASE WHEN stops = 1 THEN 'A3 ' || CAST(dep_min % 90 + 700 AS VARCHAR) ELSE 'UNKNOWN' END)
   WHEN stops = 1 THEN raw_flight_number || '+A3 ' || CAST(dep_min % 90 + 700 AS VARCHAR) ELSE raw_flight_number END AS rfn
   FROM fx_award WHERE airline = 'TK'),
tk_bad AS (SELECT origin, destination, date, scraped_at_utc FROM tk_a GROUP BY origin, destination, date, scraped_at_utc
   HAVING bool_or(available_seats = 5) OR bool_or(hour(scraped_at_utc) % 17 = 0)),
exp_tk AS (SELECT {_REC_SQL.format(a='a', al='TK', src='turkish', pts='a.points_cost', cash='0', cabin='a.cabin_class',
    seats='CASE WHEN a.available_seats >= 0 THEN a.available_seats ELSE -1 END', rfn='a.rfn', partner="CASE WHEN a.stops = 1 THEN 'A3' END",
    dur='CASE WHEN o.tz IS NOT NULL AND d.tz IS NOT NULL AND a.duration_minutes + o.off_min - d.off_min > 0 THEN a.duration_minutes + o.off_min - d.off_min END',
    saver='false', fc="'TK' || upper(substr(a.cabin_class, 1, 2))", lay="CASE WHEN a.stops = 1 THEN 'IST' END",
    nd='d.tz IS NOT NULL AND a.dep_min + a.duration_minutes >= 1440')}
  FROM tk_a a JOIN dim_airport o ON o.iata = upper(a.origin) JOIN dim_airport d ON d.iata = upper(a.destination)
  WHERE a.available_seats <> 2 AND a.points_cost > 0 AND NOT EXISTS (SELECT 1 FROM tk_bad b WHERE b.origin = a.origin
   AND b.destination = a.destination AND b.date = a.date AND b.scraped_at_utc = a.scraped_at_utc) {_FIRST}),
exp_b6 AS (SELECT {_REC_SQL.format(a='a', al='B6', src='jetblue', pts='a.points_cost', cash='a.cash_cost', cabin='a.cabin_class',
    seats='a.available_seats', rfn="CASE WHEN a.raw_flight_number = 'UNKNOWN' THEN (CASE WHEN a.stops = 1 THEN 'B6 ' || CAST(a.dep_min % 50 + 900 AS VARCHAR) ELSE 'UNKNOWN' END) WHEN a.stops = 1 THEN a.raw_flight_number || '+B6 ' || CAST(a.dep_min % 50 + 900 AS VARCHAR) ELSE a.raw_flight_number END",
    partner="CASE WHEN a.stops = 1 THEN 'AA' END", dur='a.duration_minutes', saver="a.cabin_class = 'economy'",
    fc='upper(substr(a.cabin_class, 1, 1))', lay="CASE WHEN a.stops = 1 THEN 'BOS' END",
    nd='d.tz IS NOT NULL AND a.dep_min + a.duration_minutes >= 1440')}
  FROM fx_award a JOIN dim_airport d ON d.iata = upper(a.destination) WHERE a.airline = 'B6' AND a.points_cost > 0),
exp_wn AS (SELECT {_REC_SQL.format(a='a', al='WN', src='southwest', pts='CASE WHEN a.own_ok THEN a.points_cost ELSE a.points_cost + 5000 END',
    cash='CASE WHEN a.own_ok THEN a.cash_cost ELSE a.cash_cost + 10 END', cabin="'economy'", seats='-1',
    rfn="CASE WHEN a.stops = 1 THEN a.raw_flight_number || '+WN ' || CAST(a.dep_min % 50 + 800 AS VARCHAR) ELSE a.raw_flight_number END",
    partner='NULL', dur='a.duration_minutes', saver="a.own_ok AND a.cabin_class IN ('economy', 'premium_economy')",
    fc="CASE WHEN a.own_ok THEN upper(substr(a.cabin_class, 1, 1)) ELSE 'Y' END", lay="CASE WHEN a.stops = 1 THEN 'DEN' END",
    nd='a.dep_min + a.duration_minutes >= 1440')}
  FROM (SELECT *, available_seats <> -1 AND points_cost > 0 AS own_ok FROM fx_award WHERE airline = 'WN' AND raw_flight_number <> 'UNKNOWN') a)"""


def _etihad(spark, sf_dir):
    return FL.flatten_etihad(etihad_bronze(D.lk(spark, sf_dir)))


def _turkish(spark, sf_dir):
    L = D.lk(spark, sf_dir)
    return FL.flatten_turkish(turkish_bronze(L), L.dim_airport)


def _jetblue(spark, sf_dir):
    L = D.lk(spark, sf_dir)
    return FL.flatten_jetblue(jetblue_bronze(L), L.dim_airport)


def _southwest(spark, sf_dir):
    return FL.flatten_southwest(southwest_bronze(D.lk(spark, sf_dir)))


@query("nrm_etihad", "SELECT * FROM exp_ey", EXP_CTE)
def nrm_etihad(spark, sf_dir):
    """cards[] x cabins[] -> records; unknown cabins and non-positive miles skipped; first (flight, cabin) wins."""
    return _etihad(spark, sf_dir)


@query("nrm_turkish", "SELECT * FROM exp_tk", EXP_CTE)
def nrm_turkish(spark, sf_dir):
    """options[] x fareCategory map; miles only; one malformed option or success=false rejects the response."""
    return _turkish(spark, sf_dir)


@query("nrm_jetblue", "SELECT * FROM exp_b6", EXP_CTE)
def nrm_jetblue(spark, sf_dir):
    """productOffers[] x offers[]; sold-out and points-less offers skipped."""
    return _jetblue(spark, sf_dir)


@query("nrm_southwest", "SELECT * FROM exp_wn", EXP_CTE)
def nrm_southwest(spark, sf_dir):
    """details[] priced by the cheapest available family; legs from the packed productId."""
    return _southwest(spark, sf_dir)


def _proj(name, exp, fn, cols, doc):
    body = f"SELECT {', '.join(cols)} FROM {exp}"

    def run(spark, sf_dir):
        return fn(spark, sf_dir).select(*cols)
    run.__doc__ = doc
    run.__name__ = name
    query(name, body, EXP_CTE)(run)


_proj("fn_cents_to_usd", "exp_ey", _etihad, ["origin", "destination", "date", "raw_flight_number", "cabin_class", "cash_cost"],
      "Etihad cash cents -> USD (2 dp, default 0).")
_proj("fn_cabin_map", "exp_ey", _etihad, ["origin", "destination", "date", "raw_flight_number", "cabin_class"],
      "Provider cabin token (lower-cased) -> canonical cabin; unknown tokens drop the fare.")
_proj("fn_flight_number", "exp_tk", _turkish, ["origin", "destination", "date", "raw_flight_number", "cabin_class"],
      "Segments -> 'XX 1+YY 2' with leading zeros stripped; none -> UNKNOWN.")
_proj("fn_partner_airline", "exp_tk", _turkish, ["origin", "destination", "date", "raw_flight_number", "partner_airline"],
      "First operating carrier other than the program's own.")
_proj("fn_layover_airports", "exp_b6", _jetblue, ["origin", "destination", "date", "raw_flight_number", "layover_airports"],
      "Intermediate arrival airports, upper-cased, length 3, comma-joined.")
_proj("fn_price_by_currency", "exp_b6", _jetblue, ["origin", "destination", "date", "raw_flight_number", "points_cost", "cash_cost"],
      "Amount of the first price entry in the wanted currency (points and USD).")
_proj("fn_next_day", "exp_b6", _jetblue, ["origin", "destination", "date", "raw_flight_number", "next_day_arrival"],
      "Arrival local date after the travel date (only when the arrival zone is known).")
_proj("fn_saver_flag", "exp_wn", _southwest, ["origin", "destination", "date", "raw_flight_number", "fare_class", "is_saver"],
      "Saver fare families by prefix.")
_proj("agg_cheapest_available", "exp_wn", _southwest, ["origin", "destination", "date", "raw_flight_number", "points_cost", "cash_cost"],
      "Cheapest AVAILABLE fare family with points > 0 per itinerary; first wins ties.")


# ------------------------------------------------------------------ text parsers over data
@query("fn_duration_text", """
SELECT DISTINCT CAST(duration_minutes // 60 AS VARCHAR) || 'h' || CASE WHEN duration_minutes % 60 > 0 THEN ' ' || CAST(duration_minutes % 60 AS VARCHAR) || 'm' ELSE '' END AS duration_text,
 duration_minutes AS minutes FROM fx_award""")
def fn_duration_text(spark, sf_dir):
    """'12h 40m' -> 760, '13h' -> 780 over every distinct rendered duration."""
    a = D.lk(spark, sf_dir).fx_award
    d = F.col("duration_minutes")
    txt = F.concat(X.idiv(d, F.lit(60)).cast("string"), F.lit("h"),
                   F.when(F.pmod(d, F.lit(60)) > 0, F.concat(F.lit(" "), F.pmod(d, F.lit(60)).cast("string"), F.lit("m"))).otherwise(F.lit("")))
    t = a.select(txt.alias("duration_text")).distinct()
    return t.select("duration_text", text_parse.duration_text("duration_text").alias("minutes"))


@query("fn_day_offset", """
SELECT DISTINCT CASE WHEN dep_min + duration_minutes >= 1440 THEN '+' || CAST((dep_min + duration_minutes) // 1440 AS VARCHAR) ELSE '' END AS badge,
 CAST((dep_min + duration_minutes) // 1440 AS INTEGER) AS day_offset FROM fx_award""")
def fn_day_offset(spark, sf_dir):
    """'+N' arrival badge -> N over every rendered badge."""
    a = D.lk(spark, sf_dir).fx_award
    end = F.col("dep_min") + F.col("duration_minutes")
    b = a.select(F.when(end >= 1440, F.concat(F.lit("+"), X.idiv(end, F.lit(1440)).cast("string"))).otherwise(F.lit("")).alias("badge")).distinct()
    return b.select("badge", text_parse.day_offset("badge").alias("day_offset"))


@query("fn_12h_to_24h", """
SELECT DISTINCT CAST(((dep_min // 60) + 11) % 12 + 1 AS VARCHAR) || ':' || lpad(CAST(dep_min % 60 AS VARCHAR), 2, '0') || ' ' || CASE WHEN dep_min >= 720 THEN 'PM' ELSE 'AM' END AS clock12,
 lpad(CAST(dep_min // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(dep_min % 60 AS VARCHAR), 2, '0') AS clock24 FROM fx_fare""")
def fn_12h_to_24h(spark, sf_dir):
    """'1:05 PM' -> '13:05' over every distinct rendered fare departure."""
    f = D.lk(spark, sf_dir).fx_fare
    h = X.idiv("dep_min", F.lit(60))
    c12 = F.concat((F.pmod(h + 11, F.lit(12)) + 1).cast("string"), F.lit(":"), F.lpad(F.pmod("dep_min", F.lit(60)).cast("string"), 2, "0"),
                   F.lit(" "), F.when(F.col("dep_min") >= 720, F.lit("PM")).otherwise(F.lit("AM")))
    t = f.select(c12.alias("clock12")).distinct()
    rx = r"^(\d{1,2}):(\d{2})\s*([AP]M)$"
    return t.select("clock12", text_parse.to_24h(F.regexp_extract("clock12", rx, 1), F.regexp_extract("clock12", rx, 2),
                                                 F.regexp_extract("clock12", rx, 3)).alias("clock24"))


@query("fn_hhmm_minutes", """
SELECT DISTINCT lpad(CAST(dep_min // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(dep_min % 60 AS VARCHAR), 2, '0') AS hhmm, dep_min AS minutes FROM fx_fare""")
def fn_hhmm_minutes(spark, sf_dir):
    """'HH:MM' -> minutes since midnight (no wrap)."""
    f = D.lk(spark, sf_dir).fx_fare
    t = f.select(_hhmm(F.col("dep_min")).alias("hhmm")).distinct()
    return t.select("hhmm", text_parse.hhmm_minutes("hhmm").alias("minutes"))


# ------------------------------------------------------------------ Delta
DL_BRAND = {"economy": "MAIN", "premium_economy": "PREMIUM_SELECT", "business": "DELTA_ONE", "first": "CFIRST"}


def delta_bronze(L):
    r = responses(L, "DL")
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def offer_set(i):
        dep = _local(F.col("date"), i["dep_min"])
        arr = _local(F.col("date"), i["dep_min"] + i["duration_minutes"])
        dur = i["duration_minutes"]
        raw = i["raw_flight_number"]
        unk = i["available_seats"] == 4
        own = F.when(unk, F.lit("ZZZ")).otherwise(X.case_map(i["cabin_class"], DL_BRAND))
        dom = F.when(unk, F.lit("ZZZ")).when(i["available_seats"].isin(3, 6, 9), F.lit(None).cast("string")).otherwise(own)
        cos = F.upper(F.substring(i["cabin_class"], 1, 1))
        leg1 = F.struct(F.lit(None).cast(FL._DL_CARRIER).alias("marketingCarrier"), F.lit(None).cast(FL._DL_CARRIER).alias("operatingCarrier"),
                        F.struct(F.lit("321").alias("fleetTypeCode"), F.lit(None).cast("string").alias("subFleetTypeCode")).alias("aircraft"),
                        F.when(i["stops"] == 1, F.struct(F.lit("ATL").alias("destinationAirportCode"),
                                                         F.struct(F.lit(0).cast("long").alias("dayCnt"), F.lit(1).cast("long").alias("hourCnt"),
                                                                  F.lit(5).cast("long").alias("minuteCnt")).alias("layoverDuration"))).alias("layover"))
        leg2 = F.struct(F.lit(None).cast(FL._DL_CARRIER).alias("marketingCarrier"), F.lit(None).cast(FL._DL_CARRIER).alias("operatingCarrier"),
                        F.struct(F.lit("739").alias("fleetTypeCode"), F.lit(None).cast("string").alias("subFleetTypeCode")).alias("aircraft"),
                        F.lit(None).cast("struct<destinationAirportCode:string,layoverDuration:" + FL._DHM + ">").alias("layover"))
        carrier = F.when(raw != "UNKNOWN", F.struct(F.lit("DL").alias("carrierCode"), _num(raw).alias("carrierNum")))
        seg = F.struct(carrier.alias("marketingCarrier"), F.lit(None).cast(FL._DL_CARRIER).alias("operatingCarrier"),
                       F.when(i["stops"] == 1, F.array(leg1, leg2)).otherwise(F.array(leg1)).alias("flightLeg"))
        dhm = F.when(F.pmod(i["dep_min"], F.lit(7)) != 0, F.struct(
            X.idiv(dur, F.lit(1440)).cast("long").alias("dayCnt"), X.idiv(F.pmod(dur, F.lit(1440)), F.lit(60)).cast("long").alias("hourCnt"),
            F.pmod(dur, F.lit(60)).cast("long").alias("minuteCnt")))
        trip = F.struct(i["stops"].cast("long").alias("stopCnt"), F.date_format(dep, iso).alias("scheduledDepartureLocalTs"),
                        F.date_format(arr, iso).alias("scheduledArrivalLocalTs"), dhm.alias("totalTripTime"),
                        F.array(seg).alias("flightSegment"))
        b1 = F.struct(own.alias("brandId"), cos.alias("cosCode"))
        b2 = F.struct(F.when(unk, F.lit("ZZZ")).otherwise(F.lit("BASIC")).alias("brandId"), F.lit("B").alias("cosCode"))
        price = F.struct(F.struct(F.struct(i["points_cost"].cast("double").alias("mileCnt")).alias("milesEquivalentPrice"),
                                  F.struct(i["cash_cost"].cast("double").alias("roundedCurrencyAmt")).alias("currencyEquivalentPrice"))
                         .alias("totalFarePrice"))
        price_json = F.when(F.pmod(i["dep_min"], F.lit(2)) == 0, F.to_json(F.array(price))).otherwise(F.to_json(price))
        fi = F.struct(F.when(i["stops"] == 1, F.array(b1, b2)).otherwise(F.array(b1)).alias("brandByFlightLegs"),
                      F.when(i["available_seats"] >= 0, i["available_seats"].cast("long")).alias("availableSeatCnt"),
                      price_json.alias("farePrice"))
        offer = F.struct(F.struct(F.when(i["cabin_class"] == "economy", F.lit("AWARD_SAVER")).otherwise(F.lit("MILES")).alias("fareType"),
                                  dom.alias("dominantSegmentBrandId")).alias("additionalOfferProperties"),
                         F.array(F.struct(F.array(F.struct(F.struct(F.array(fi).alias("fareInformation")).alias("retailItemMetaData")))
                                          .alias("retailItems"))).alias("offerItems"))
        return F.struct(F.array(trip).alias("trips"), F.array(offer).alias("offers"))

    payload = F.struct(F.struct(F.struct(F.transform("items", offer_set).alias("gqlOffersSets")).alias("gqlSearchOffers")).alias("data"))
    return _bronze(r, payload)


EXP_CTE += f""",
exp_dl AS (SELECT {_REC_SQL.format(a='a', al='DL', src='delta', pts='a.points_cost', cash='a.cash_cost', cabin='a.cabin_class',
    seats='a.available_seats', rfn='a.raw_flight_number', partner='NULL',
    dur='CASE WHEN a.dep_min % 7 <> 0 THEN a.duration_minutes WHEN o.tz IS NOT NULL AND d.tz IS NOT NULL AND a.duration_minutes + o.off_min - d.off_min > 0 THEN a.duration_minutes + o.off_min - d.off_min END',
    saver="a.cabin_class = 'economy'", fc='upper(substr(a.cabin_class, 1, 1))', lay="CASE WHEN a.stops = 1 THEN 'ATL' END",
    nd='d.tz IS NOT NULL AND a.dep_min + a.duration_minutes >= 1440')},
  a.stops = 1 AND a.cabin_class <> 'economy' AS mixed_cabin
  FROM fx_award a JOIN dim_airport o ON o.iata = upper(a.origin) JOIN dim_airport d ON d.iata = upper(a.destination)
  WHERE a.airline = 'DL' AND a.points_cost > 0 AND a.available_seats <> 4)"""


def _delta(spark, sf_dir):
    L = D.lk(spark, sf_dir)
    return FL.flatten_delta(delta_bronze(L), L.dim_airport)


@query("nrm_delta", "SELECT * FROM exp_dl", EXP_CTE)
def nrm_delta(spark, sf_dir):
    """offer sets x offers x fare information; dominant brand else most premium leg; list-or-object price."""
    return _delta(spark, sf_dir)


_proj("fn_brand_to_cabin", "exp_dl", _delta, ["origin", "destination", "date", "raw_flight_number", "points_cost", "cabin_class"],
      "Delta brand id -> cabin: first matching token of the ordered rule list.")
_proj("fn_most_premium", "exp_dl", _delta, ["origin", "destination", "date", "raw_flight_number", "points_cost", "cabin_class", "stops"],
      "Cabin of the most premium leg when the dominant brand is unknown.")
_proj("fn_mixed_cabin", "exp_dl", _delta, ["origin", "destination", "date", "raw_flight_number", "cabin_class", "mixed_cabin"],
      "More than one distinct mapped leg cabin.")
_proj("fn_duration_dhm", "exp_dl", _delta, ["origin", "destination", "date", "raw_flight_number", "cabin_class", "duration_minutes"],
      "{dayCnt, hourCnt, minuteCnt} -> minutes.")
_proj("fn_duration_fallback", "exp_dl", _delta, ["origin", "destination", "date", "raw_flight_number", "points_cost", "duration_minutes"],
      "Provider duration, else arrival minus departure as instants (zone-aware).")


# ------------------------------------------------------------------ Alaska
AS_SLOTS = 28  # flat-array slots rendered per row


def alaska_bronze(L):
    z = L.dim_airport.select(F.col("iata").alias("_iata"), F.coalesce("off_min", F.lit(0)).alias("_off"))
    r = responses(L, "AS")
    r = r.join(F.broadcast(z.withColumnRenamed("_iata", "origin").withColumnRenamed("_off", "_ooff")), "origin", "left") \
         .join(F.broadcast(z.withColumnRenamed("_iata", "destination").withColumnRenamed("_off", "_doff")), "destination", "left")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def iso(ts, off):
        a = F.abs(off)
        return q(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(off < 0, F.lit("-")).otherwise(F.lit("+")),
                          F.lpad(X.idiv(a, F.lit(60)).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.pmod(a, F.lit(60)).cast("string"), 2, "0")))

    def slots(i, k):
        b = F.lit(2) + k * AS_SLOTS
        ref = lambda n: (b + n).cast("long")
        dep = _local(F.col("date"), i["dep_min"])
        arr = _local(F.col("date"), i["dep_min"] + i["duration_minutes"])
        one = i["stops"] == 1
        mins = lambda m: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))
        known = i["raw_flight_number"] != "UNKNOWN"
        saver = F.pmod(i["available_seats"], F.lit(2)) == 0
        key = X.case_map(i["cabin_class"], {"economy": "MAIN", "premium_economy": "PREMIUM", "business": "REFUNDABLE_BUSINESS",
                                            "first": "FIRST"})
        key = F.when(saver & i["cabin_class"].isin("economy", "premium_economy"), F.concat(F.lit("SAVER_"), key)).otherwise(key)

        def seg(p, d, dt, at, ap, eq):
            return F.to_json(F.struct(p.alias("publishingCarrier"), d.alias("displayCarrier"), dt.alias("departureDateTime"),
                                      at.alias("arrivalDateTime"), ap.alias("arrivalAirportCode"), eq.alias("equipmentCode")))

        return F.array(
            F.to_json(F.struct(ref(1).alias("segments"), ref(2).alias("solutions"), ref(3).alias("totalDuration"))),
            F.when(one, F.concat(F.lit("["), ref(4).cast("string"), F.lit(","), ref(11).cast("string"), F.lit("]")))
             .otherwise(F.concat(F.lit("["), ref(4).cast("string"), F.lit("]"))),
            F.concat(F.lit('{"'), key, F.lit('":'), ref(18).cast("string"), F.lit(',"SAVER_FIRST":-1,"UPGRADE":'),
                     ref(18).cast("string"), F.lit("}")),
            i["duration_minutes"].cast("string"),
            seg(F.when(known, ref(5)), ref(6), ref(7), ref(8), ref(9), ref(10)),
            F.to_json(F.struct(ref(23).alias("carrierCode"), ref(24).alias("flightNumber"))),
            F.to_json(F.struct(F.when(one, ref(26)).otherwise(ref(25)).alias("carrierCode"))),
            iso(dep, F.col("_ooff")),
            F.when(one, iso(dep + mins(60), F.col("_ooff"))).otherwise(iso(arr, F.col("_doff"))),
            q(F.when(one, F.lit("SEA")).otherwise(F.col("destination"))),
            q(F.lit("73J")),
            seg(ref(12), ref(13), ref(14), ref(15), ref(16), ref(17)),
            F.to_json(F.struct(ref(26).alias("carrierCode"), ref(27).alias("flightNumber"))),
            F.to_json(F.struct(ref(26).alias("carrierCode"))),
            iso(dep + mins(100), F.col("_ooff")), iso(arr, F.col("_doff")), q(F.col("destination")), q(F.lit("E75")),
            F.to_json(F.struct(ref(19).alias("atmosPoints"), ref(20).alias("grandTotal"), ref(21).alias("seatsRemaining"),
                               ref(22).alias("bookingCode"))),
            i["points_cost"].cast("string"), i["cash_cost"].cast("string"), i["available_seats"].cast("string"),
            q(F.upper(F.substring(i["cabin_class"], 1, 1))), q(F.lit("AS")),
            F.when(known, _num(i["raw_flight_number"])).otherwise(F.lit("0")), q(F.lit("AS")), q(F.lit("QX")),
            (F.pmod(i["dep_min"], F.lit(100)) + 2000).cast("string"))

    frags = F.concat(F.array(F.lit('{"rows":1}'),
                             F.concat(F.lit("["), F.array_join(F.transform("items", lambda i, k: (F.lit(2) + k * AS_SLOTS).cast("string")), ","),
                                      F.lit("]"))),
                     F.flatten(F.transform("items", slots)))
    payload = F.concat(F.lit('{"chunks":[{"type":"data","data":[{"meta":1},"x"]},{"type":"chunk","data":['),
                       F.array_join(frags, ","), F.lit("]}]}"))
    return r.select("origin", "destination", F.col("date").alias("travel_date"), "scraped_at_utc", payload.alias("payload"))


EXP_CTE += f""",
exp_as AS (SELECT {_REC_SQL.format(a='a', al='AS', src='alaska', pts='a.points_cost', cash='a.cash_cost', cabin='a.cabin_class',
    seats='a.available_seats', rfn='a.raw_flight_number', partner="CASE WHEN a.stops = 1 THEN 'QX' END",
    dur='a.duration_minutes', saver="(a.available_seats % 2 = 0) AND a.cabin_class IN ('economy', 'premium_economy')",
    fc='upper(substr(a.cabin_class, 1, 1))', lay="CASE WHEN a.stops = 1 THEN 'SEA' END",
    nd='a.dep_min + a.duration_minutes >= 1440')}
  FROM fx_award a WHERE a.airline = 'AS' AND a.points_cost > 0)"""


def _alaska(spark, sf_dir):
    return FL.flatten_alaska(alaska_bronze(D.lk(spark, sf_dir)))


@query("nrm_alaska_deref", "SELECT * FROM exp_as", EXP_CTE)
def nrm_alaska_deref(spark, sf_dir):
    """Dehydrated flat array: references resolved with element_at + from_json; one record per priced solution."""
    return _alaska(spark, sf_dir)


# ------------------------------------------------------------------ quarantine of unreadable payloads
@query("nrm_quarantine", """
SELECT airline, CASE day(date) WHEN 13 THEN 'malformed' WHEN 17 THEN 'unexpected_shape' ELSE 'missing' END AS reason, count(*) AS responses
FROM (SELECT DISTINCT airline, origin, destination, date, scraped_at_utc FROM fx_award WHERE airline IN ('EY', 'B6')) r
WHERE day(date) IN (13, 17, 19) GROUP BY ALL""")
def nrm_quarantine(spark, sf_dir):
    """Landed responses of two providers, those of some days damaged on the way (cut off, another document, nothing):
    how many each provider's quarantine holds, by reason."""
    L = D.lk(spark, sf_dir)
    day, text = F.dayofmonth("travel_date"), F.col("payload")
    damaged = F.when(day == 13, F.substring(text, 1, 20)).when(day == 17, F.lit('{"error": "busy"}')).when(day == 19, F.lit(None)).otherwise(text)
    ey = FL.quarantined(etihad_bronze(L).withColumn("payload", damaged), "$.cards").select(F.lit("EY").alias("airline"), "reason")
    b6 = FL.quarantined(jetblue_bronze(L).withColumn("payload", damaged), "$.data.searchResults").select(F.lit("B6").alias("airline"), "reason")
    return ey.union(b6).groupBy("airline", "reason").agg(F.count(F.lit(1)).alias("responses"))
