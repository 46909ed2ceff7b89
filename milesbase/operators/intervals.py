"""Stabbing join: every point in time meets the intervals that hold it, by equi-joins only.

An interval is cut into days at its ragged ends and into blocks of 32 and 1,024 days in between (at most 62 + 62 pieces and one for
each 1,024 days); a day looks up three keys, its own and those of its two blocks. So a long or open interval is a few rows and no
range condition reaches the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32


def _between(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def _split(lo: Column, hi: Column) -> tuple[Column, Column, Column]:
    """Single units at the ends of [lo, hi], and the first and last whole block between them."""
    first, last = F.ceil(lo / BLOCK).cast("int"), (F.floor((hi + 1) / BLOCK) - 1).cast("int")
    whole = first <= last
    ends = F.when(whole, F.concat(_between(lo, first * BLOCK - 1), _between((last + 1) * BLOCK, hi))).otherwise(_between(lo, hi))
    return ends, first, last


def pieces(lo: Column, hi: Column) -> Column:
    """Array of (level, block) that covers the days [lo, hi] exactly once; days are integers."""
    days, a, b = _split(lo, hi)
    blocks, c, d = _split(a, b)
    level = lambda k, xs: F.transform(xs, lambda x: F.struct(F.lit(k).alias("level"), x.alias("block")))
    none = F.array().cast("array<struct<level:int,block:int>>")
    return F.concat(level(0, days), F.when(a <= b, F.concat(level(1, blocks), F.when(c <= d, level(2, _between(c, d))).otherwise(none))).otherwise(none))


def stabbed(points: DataFrame, intervals: DataFrame, on: list[str], at: str, starts: str, ends: str) -> DataFrame:
    """Each distinct (on, ``at`` date) of ``points`` with each interval of the same ``on`` that holds it, both ends inclusive; a null end is
    open. Join the result back on (on, at): the points themselves are never copied to keys."""
    day = F.unix_date(at)
    days = points.select(*on, at).filter(F.col(at).isNotNull()).distinct()
    hull = days.groupBy(*on).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    # an open or overlong interval reaches no further than the points do
    cut = intervals.join(hull, on).withColumn("_lo", F.greatest(F.unix_date(starts), "_first")).withColumn("_hi", F.least(F.unix_date(ends), "_last"))
    cut = cut.filter((F.col("_lo") <= F.col("_hi")) & (F.coalesce(starts, F.lit("0001-01-01").cast("date")) <= F.coalesce(ends, F.lit("9999-12-31").cast("date"))))
    cut = cut.select(*intervals.columns, F.explode(pieces(F.col("_lo"), F.col("_hi"))).alias("_p")).select(*intervals.columns, "_p.level", "_p.block")
    keys = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(day / BLOCK**k).cast("int").alias("block")) for k in range(3)])
    look = days.select(*on, at, F.explode(keys).alias("_p")).select(*on, at, "_p.level", "_p.block")
    return look.join(cut, [*on, "level", "block"]).drop("level", "block")
