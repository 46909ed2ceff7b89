"""Date spines (gen_dense_sparse, gen_plan, gen_units).

Spines are array columns exploded next to the row that owns them, so no
cross join is ever planned: a route's dates are generated from that route's
own parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.functions.exprs import col
from milesbase.operators.text_parse import parse_dates_csv


def _range(start, stop, step=None) -> Column:
    """Python ``range(start, stop, step)`` as an array (empty when stop <= start)."""
    start, stop = col(start), col(stop)
    seq = F.sequence(start, stop - 1) if step is None else F.sequence(start, stop - 1, col(step))
    return F.when(stop > start, seq).otherwise(F.array().cast("array<int>"))


def dense_sparse_offsets(dense_days, sparse_step, max_day, sparse_max=30, coarse_step=7) -> Column:
    """Every day for the dense prefix, every ``sparse_step`` days to 30, weekly to ``max_day`` (exclusive)."""
    dense = F.least(col(dense_days), col(max_day))
    step = F.greatest(F.lit(1), col(sparse_step))
    parts = F.concat(_range(F.lit(0), dense), _range(dense, F.least(F.lit(sparse_max), col(max_day)), step),
                     F.when(col(max_day) > sparse_max, _range(F.lit(sparse_max), col(max_day), F.lit(max(1, coarse_step))))
                      .otherwise(F.array().cast("array<int>")))
    return F.array_sort(F.array_distinct(parts))


def explode_dates(df: DataFrame, today, offsets: Column, name="date") -> DataFrame:
    return df.withColumn("_off", F.explode(offsets)).withColumn(
        name, F.date_add(F.lit(today).cast("date"), F.col("_off"))).drop("_off")


def plan_dates(dates_csv, today, scrape_days: int) -> Column:
    """gen_plan dates: the parsed CSV if it yields any date, else today .. today + n - 1."""
    parsed = parse_dates_csv(dates_csv)
    default = F.transform(F.sequence(F.lit(0), F.lit(scrape_days - 1)),
                          lambda i: F.date_add(F.lit(today).cast("date"), i))
    return F.when(F.size(parsed) > 0, parsed).otherwise(default)
