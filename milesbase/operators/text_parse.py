"""Parsing of scraped text into typed columns (fn_12h_to_24h, fn_price_text, fn_stops_text,
fn_duration_text, fn_day_offset, fn_parse_dates_csv, nrm_fare_labels).

All JVM regex built-ins (``regexp_extract`` / ``rlike``); a non-match yields null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.functions.exprs import col

# --- fixed values: label patterns of the cash fare list ---
PRICE_RE = r"([\d,]+)\s+US dollars"
STOPS_RE = r"(Nonstop|(\d+) stops?) flight with ([A-Za-z][A-Za-z .&'-]*?)\."
DEP_RE = r"Leaves .*? at (\d{1,2}):(\d{2})\s*([AP]M)"
DURATION_RE = r"(?i)(\d+)h(?:\s*(\d+)m)?"
DAY_OFFSET_RE = r"\d+"
# --- end fixed values ---


def _extract(c, pattern, idx) -> Column:
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def to_24h(hour, minute, ampm) -> Column:
    """fn_12h_to_24h: ('1', '05', 'PM') -> '13:05'; 12 AM -> '00'."""
    h = F.pmod(col(hour).cast("int"), F.lit(12)) + F.when(col(ampm) == "PM", 12).otherwise(0)
    return F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), col(minute))


def price_text(c) -> Column:
    """fn_price_text: '1,234 US dollars' -> 1234.0; no number (',') -> null."""
    return F.regexp_replace(_extract(c, PRICE_RE, 1), ",", "").try_cast("double")


def parse_fare_labels(labels: DataFrame, text="label") -> DataFrame:
    """nrm_fare_labels: (carrier, dep_hhmm, price, nonstop); labels missing any part dropped,
    connecting rows kept (nonstop = false)."""
    t = F.col(text)
    ok = t.rlike(STOPS_RE) & t.rlike(DEP_RE) & t.rlike(PRICE_RE)
    out = labels.filter(ok)
    return out.select(
        *[c for c in labels.columns if c != text],
        F.trim(F.regexp_extract(t, STOPS_RE, 3)).alias("carrier"),
        to_24h(F.regexp_extract(t, DEP_RE, 1), F.regexp_extract(t, DEP_RE, 2), F.regexp_extract(t, DEP_RE, 3)).alias("dep_hhmm"),
        price_text(t).alias("price"),
        (F.regexp_extract(t, STOPS_RE, 1) == "Nonstop").alias("nonstop"),
    )


def hhmm_minutes(c) -> Column:
    """fn_hhmm_minutes: 'HH:MM' -> minutes since midnight (no wrap); anything else -> null."""
    parts = F.split(col(c), ":")
    h, m = F.get(parts, 0).try_cast("int"), F.get(parts, 1).try_cast("int")
    return F.try_add(F.try_multiply(h, F.lit(60)), m)


def duration_text(c) -> Column:
    """fn_duration_text: '12h 40m' -> 760, '13h' -> 780, found anywhere in the text and in either case; nothing
    found, zero or a number beyond int -> null."""
    # no match gives '', and casting that would raise and drop an exception for each row
    part = lambda i: F.concat(F.lit("0"), F.regexp_extract(col(c), DURATION_RE, i)).try_cast("int")
    total = F.try_add(F.try_multiply(part(1), F.lit(60)), part(2))
    return F.get(F.filter(F.array(total), lambda t: t > 0), 0)  # when(total > 0, total) would search the text again


def day_offset(c) -> Column:
    """fn_day_offset: the first number of a badge ('+1', '1', 'arr +2'); none -> 0."""
    return F.coalesce(F.concat(F.lit("0"), F.regexp_extract(col(c), DAY_OFFSET_RE, 0)).try_cast("int"), F.lit(0))


def parse_dates_csv(c) -> Column:
    """fn_parse_dates_csv: CSV of ISO dates -> array<date>; blank / malformed tokens dropped."""
    toks = F.transform(F.split(F.coalesce(col(c), F.lit("")), ","), lambda x: F.try_to_date(F.trim(x), "yyyy-MM-dd"))
    return F.filter(toks, lambda x: x.isNotNull())
