"""Validation, invariants and quarantine (flt_validate, flt_record_invariants,
flt_check_constraints, agg_reject_summary).

A failing row is never an exception: the first failing rule becomes
``reject_reason`` and the row is routed to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.functions.exprs import is_upper_code
from milesbase.sources.dims import CABINS


def _first_failing(rules: list[tuple[str, Column]]) -> Column:
    out = None
    for name, bad in rules:
        cond = F.coalesce(bad, F.lit(True))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def validate_rules(as_of_date) -> list[tuple[str, Column]]:
    """filter_valid order: origin, destination, self-route, past date, rolled date, points."""
    days_past = F.datediff(F.lit(as_of_date).cast("date"), F.col("date"))
    return [
        ("invalid_origin", ~is_upper_code("origin")),
        ("invalid_destination", ~is_upper_code("destination")),
        ("same_route", F.col("origin") == F.col("destination")),
        ("date_past", days_past > 1),
        ("date_rolled", days_past == 1),
        ("points_nonpositive", F.col("points_cost") <= 0),
    ]


def with_reject_reason(df: DataFrame, as_of_date) -> DataFrame:
    return df.withColumn("reject_reason", _first_failing(validate_rules(as_of_date)))


def filter_valid(df: DataFrame, as_of_date) -> DataFrame:
    """Accepted rows only (the reason column is dropped)."""
    return with_reject_reason(df, as_of_date).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(df: DataFrame, as_of_date) -> DataFrame:
    return with_reject_reason(df, as_of_date).filter(F.col("reject_reason").isNotNull())


def reject_summary(df: DataFrame, as_of_date, by=()) -> DataFrame:
    """agg_reject_summary: dropped count and whether every drop is a rolled-over date."""
    r = with_reject_reason(df, as_of_date)
    rolled = F.datediff(F.lit(as_of_date).cast("date"), F.col("date")) == 1
    agg = r.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("dropped"),
        F.count_if(F.coalesce(rolled, F.lit(False))).alias("rolled"),
    )
    return agg.withColumn("housekeeping_only", (F.col("dropped") > 0) & (F.col("rolled") == F.col("dropped")))


def award_invariant_rules() -> list[tuple[str, Column]]:
    """flt_record_invariants for award records (constructor checks)."""
    return [
        ("bad_origin", F.length("origin") != 3),
        ("bad_destination", F.length("destination") != 3),
        ("no_source", F.coalesce(F.length("source"), F.lit(0)) == 0),
        ("points_nonpositive", F.col("points_cost") <= 0),
        ("bad_cabin", ~F.col("cabin_class").isin(*CABINS)),
        ("expiry_not_after_scrape", F.col("expires_at_utc") <= F.col("scraped_at_utc")),
    ]


def cash_invariant_rules() -> list[tuple[str, Column]]:
    return [
        ("bad_iata", (F.length("origin") != 3) | (F.length("destination") != 3)),
        ("no_flight_number", F.coalesce(F.length("flight_number"), F.lit(0)) == 0),
        ("price_nonpositive", F.col("cash_price") <= 0),
        ("bad_cabin", ~F.col("cabin_class").isin(*CABINS)),
        ("no_source", F.coalesce(F.length("source"), F.lit(0)) == 0),
        ("expiry_not_after_scrape", F.col("expires_at_utc") <= F.col("scraped_at_utc")),
    ]


def check_invariants(df: DataFrame, rules) -> DataFrame:
    return df.withColumn("reject_reason", _first_failing(rules))
