"""Scalar column expressions. All JVM-side built-ins, no Python UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from milesbase.sources.dims import CADENCE_BOUNDS_H, CADENCE_STEP_H, TIER_RANK, TTL_HOURS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping: dict, default=None) -> Column:
    """Ordered ``CASE c WHEN k THEN v ... ELSE default``."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


# ---- tiers -----------------------------------------------------------------

def tier_rank(tier="priority_tier") -> Column:
    """fn_tier_rank: HIGH 1, MED 2, anything else 3."""
    return case_map(tier, TIER_RANK, 3)


def ttl_hours(tier="tier") -> Column:
    """TTL by tier; unknown / missing tier falls back to LOW."""
    return case_map(tier, {"HIGH": TTL_HOURS["HIGH"], "MED": TTL_HOURS["MED"]}, TTL_HOURS["LOW"])


def seconds_between(start, end) -> Column:
    """Exact elapsed seconds (microsecond precision) from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / 1e6


def hours(n) -> Column:
    """An interval of ``n`` (integer column) hours."""
    return F.make_dt_interval(F.lit(0), col(n).cast("int"))


def expiry(scraped="scraped_at_utc", tier="tier") -> Column:
    """fn_expiry: scraped + TTL(tier) hours."""
    return col(scraped) + hours(ttl_hours(tier))


def tier_default(tier="tier") -> Column:
    """fn_tier_default: queue tier, else MED for on-demand jobs."""
    return F.coalesce(col(tier), F.lit("MED"))


def cadence_lo(tier="priority_tier") -> Column:
    return case_map(tier, {t: lo for t, (lo, _) in CADENCE_BOUNDS_H.items()}, TTL_HOURS["LOW"])


def cadence_hi(tier="priority_tier") -> Column:
    return case_map(tier, {t: hi for t, (_, hi) in CADENCE_BOUNDS_H.items()}, TTL_HOURS["LOW"])


def cadence_step(tier="priority_tier") -> Column:
    return case_map(tier, CADENCE_STEP_H, cadence_lo(tier))


# ---- money -----------------------------------------------------------------

def idiv(a, b) -> Column:
    """Exact integral division (SQL ``a div b``)."""
    return F.call_function("div", col(a), col(b))


def cents(amount) -> Column:
    """Exact integer cents of a DECIMAL(x,2) amount."""
    return (col(amount) * 100).cast("bigint")


def cpp(cash_price, points) -> Column:
    """fn_cpp: round(cash / points * 100, 2) half-up, via integer arithmetic (exact)."""
    c, p = cents(cash_price), col(points).cast("bigint")
    return F.when(col(cash_price).isNotNull() & (p > 0),
                  idiv(F.lit(200) * c + p, F.lit(2) * p) / F.lit(100))


def ceil_div(num, den) -> Column:
    """Integer ceil division for non-negative operands."""
    return idiv(col(num) + col(den) - 1, col(den))


def base_points(points, ratio_cents) -> Column:
    """fn_base_points: CEIL(points * ratio) with ratio held as integer hundredths."""
    return ceil_div(col(points).cast("bigint") * col(ratio_cents), F.lit(100))


def effective_points(points, ratio_cents, bonus_pct) -> Column:
    """fn_effective_points: CEIL(points * ratio / (1 + bonus/100))."""
    b = F.coalesce(col(bonus_pct).cast("bigint"), F.lit(0).cast("bigint"))
    return ceil_div(col(points).cast("bigint") * col(ratio_cents), F.lit(100) + b)


# ---- predicates ------------------------------------------------------------

def all_of(preds) -> Column:
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds) -> Column:
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def changed(left_prefix: str, right_prefix: str, cols) -> Column:
    """flt_changed: NULL-safe 'IS DISTINCT FROM' over a column list, OR-ed."""
    return any_of([~F.col(f"{left_prefix}{c}").eqNullSafe(F.col(f"{right_prefix}{c}")) for c in cols])


def is_upper_code(c, n=3) -> Column:
    """Length-n code that Python's str.isupper() accepts: upper == itself and has a cased char."""
    c = col(c)
    return (F.length(c) == n) & (c == F.upper(c)) & (c != F.lower(c))
