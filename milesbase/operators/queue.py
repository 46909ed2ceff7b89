"""Work-queue ranking (win_due_batch, win_shard_stride, win_stride_sample, fn_score,
fn_overdue, fn_demand_decay, fold_promote).

The due batch is computed for every airline at once: stage 1 keeps the
``fetch`` most overdue rows per airline (tier rank, next scrape), stage 2
re-ranks them never-scraped first, then by score. Both cuts are
``row_number() <= k`` per airline, which Catalyst executes as
WindowGroupLimit (top-k per partition before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators.numbering import numbered
from milesbase.sources.dims import (
    CHANGE_RATE_SEED, DEMAND_HALF_LIFE_DAYS, DEMAND_REF, PROMOTE_TO_HIGH, PROMOTE_TO_MED, SCORE_FETCH_MULTIPLE,
    SCORE_W_CHANGE, SCORE_W_DEMAND, SCORE_W_OVERDUE,
)

CAPPED_AT_MED = ("AS",)  # the daily-run carrier never goes above MED


def _ts(as_of) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    return X.seconds_between(start, end)


def decay_demand(stored, last_search_at, as_of, half_life=DEMAND_HALF_LIFE_DAYS) -> Column:
    """fn_demand_decay: stored * 2^(-days/half_life); null / future timestamp or stored <= 0 -> unchanged."""
    days = seconds_between(last_search_at, _ts(as_of)) / 86400.0
    s = X.col(stored)
    return F.when(X.col(last_search_at).isNull() | (s <= 0) | (days <= 0), s) \
            .otherwise(s * F.pow(F.lit(2.0), -days / F.lit(half_life)))


def overdue_ratio(next_scrape_at, interval_h, as_of) -> Column:
    """fn_overdue: overdue in units of the route's own interval; a zero interval counts as 1."""
    return F.when(X.col(interval_h) <= 0, F.lit(1.0)).otherwise(
        seconds_between(next_scrape_at, _ts(as_of)) / 3600.0 / X.col(interval_h))


def clamp01(c) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), X.col(c)))


def route_score(eff_demand, overdue, change_rate) -> Column:
    """fn_score: weighted sum of normalised demand, overdue and change rate."""
    demand_norm = F.least(F.lit(1.0), X.col(eff_demand) / F.lit(DEMAND_REF))
    return (F.lit(SCORE_W_DEMAND) * demand_norm + F.lit(SCORE_W_OVERDUE) * clamp01(overdue)
            + F.lit(SCORE_W_CHANGE) * clamp01(change_rate))


def scored(queue: DataFrame, as_of) -> DataFrame:
    """Score columns for queue rows (null interval -> tier lower bound, null rate -> seed)."""
    interval = F.coalesce(F.nullif(F.col("interval_h"), F.lit(0.0)), X.cadence_lo("priority_tier").cast("double")) \
        if "interval_h" in queue.columns else X.cadence_lo("priority_tier").cast("double")
    q = queue.withColumn("_interval", interval)
    q = q.withColumn("eff_demand", decay_demand(F.coalesce("decayed_demand", F.lit(0.0)), "last_search_at_utc", as_of))
    q = q.withColumn("overdue", overdue_ratio("next_scrape_at_utc", "_interval", as_of))
    q = q.withColumn("score", route_score("eff_demand", "overdue",
                                          F.coalesce("change_rate", F.lit(CHANGE_RATE_SEED))))
    return q.drop("_interval")


def due_batch(queue: DataFrame, as_of, limit: int, key="queue_id") -> DataFrame:
    """win_due_batch per airline: stage 1 = fetch rows by tier rank then next scrape,
    stage 2 = never-scraped first, then score desc (stage-1 order breaks ties); plus the
    airline's full due count."""
    fetch = max(limit, limit * SCORE_FETCH_MULTIPLE)
    due = queue.filter(F.col("next_scrape_at_utc") <= _ts(as_of))
    counts = due.groupBy("airline").agg(F.count(F.lit(1)).alias("due_count"))
    w1 = Window.partitionBy("airline").orderBy(X.tier_rank("priority_tier"), F.col("next_scrape_at_utc"), F.col(key))
    s1 = due.withColumn("stage1_rank", F.row_number().over(w1)).filter(F.col("stage1_rank") <= fetch)
    s1 = scored(s1, as_of)
    w2 = Window.partitionBy("airline").orderBy(F.when(F.col("last_scraped_at_utc").isNull(), 0).otherwise(1),
                                               F.col("score").desc(), F.col("stage1_rank"))
    s2 = s1.withColumn("batch_rank", F.row_number().over(w2)).filter(F.col("batch_rank") <= limit)
    s2 = s2.withColumn("batch_rank", F.col("batch_rank").cast("bigint")).withColumn("stage1_rank", F.col("stage1_rank").cast("bigint"))
    return s2.join(counts, "airline")


def due_list(queue: DataFrame, as_of, key="queue_id") -> DataFrame:
    """The whole due list of each airline in stage-1 order (tier rank, next scrape, key) with its rank and length, uncapped: numbered by
    an ordered scan, so a list of any length spreads over tasks."""
    due = queue.filter(F.col("next_scrape_at_utc") <= _ts(as_of)).withColumn("_tier", X.tier_rank("priority_tier"))
    ranked = numbered(due, ["airline"], ["_tier", "next_scrape_at_utc", key], "_pos", "due_count")
    return ranked.withColumn("due_rank", F.col("_pos") + 1).drop("_pos", "_tier")


def shard_stride(batch: DataFrame, shards: int, max_legs: int, rank="batch_rank") -> DataFrame:
    """win_shard_stride: ``due[i::n][:max_legs]`` as columns: shard = rn % n, kept while rn div n < max_legs."""
    rn = F.col(rank) - 1
    return batch.withColumn("shard", F.pmod(rn, F.lit(shards)).cast("bigint")).filter(X.idiv(rn, F.lit(shards)) < max_legs)


def stride_keep(idx, cnt, n: int) -> Column:
    """win_stride_sample membership: keep all when cnt <= n; else indices round_half_even(i*last/(n-1))."""
    last = X.col(cnt) - 1
    if n == 1:
        picks = F.array(F.lit(0).cast("double"))
    else:
        picks = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * last / F.lit(n - 1), 0))
    return (X.col(cnt) <= n) | F.array_contains(picks, X.col(idx).cast("double"))


def promoted_tier(tier0, count0, n, airline) -> Column:
    """fold_promote in closed form: one tier step per search, LOW->MED once count >= 3,
    MED->HIGH once count >= 10 (at least one search after the first step); capped carriers stay MED."""
    t, c, k = F.coalesce(X.col(tier0), F.lit("LOW")), F.coalesce(X.col(count0), F.lit(0)), X.col(n)
    k_med = F.greatest(F.lit(1), F.lit(PROMOTE_TO_MED) - c)
    k_high_from_low = F.greatest(k_med + 1, F.lit(PROMOTE_TO_HIGH) - c)
    k_high_from_med = F.greatest(F.lit(1), F.lit(PROMOTE_TO_HIGH) - c)
    capped = X.col(airline).isin(*CAPPED_AT_MED)
    from_low = (F.when(~capped & (k >= k_high_from_low), "HIGH").when(k >= k_med, "MED").otherwise("LOW"))
    from_med = F.when(~capped & (k >= k_high_from_med), "HIGH").otherwise("MED")
    return F.when(t == "LOW", from_low).when(t == "MED", from_med).otherwise(t)
