"""Coverage, freshness and run-outcome reports.

Aggregates are computed before joins (eager aggregation): route coverage
aggregates flights per (route, source) once and then left-joins the queue, so
the queue never fans out over flight rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.sources.dims import CABINS


def route_coverage(queue: DataFrame, flights: DataFrame, as_of_date, source_col="source") -> DataFrame:
    """agg_route_coverage: every queue row with its future flights' counts; zero-data rows kept."""
    fut = flights.filter(F.col("date") >= F.lit(as_of_date).cast("date"))
    per_route = fut.groupBy(F.col("origin"), F.col("destination").alias("dest"), F.col("source").alias(source_col)).agg(
        F.count(F.lit(1)).alias("flight_rows"),
        F.countDistinct("date").alias("dates_covered"),
        F.countDistinct("cabin_class").alias("cabins_seen"),
        F.array_join(F.array_sort(F.collect_set("cabin_class")), ",").alias("cabin_list"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.max("scraped_at_utc").alias("last_flight_scrape"),
    )
    j = queue.join(per_route, ["origin", "dest", source_col], "left")
    return (j.withColumn("flight_rows", F.coalesce("flight_rows", F.lit(0)))
             .withColumn("dates_covered", F.coalesce("dates_covered", F.lit(0)))
             .withColumn("cabins_seen", F.coalesce("cabins_seen", F.lit(0))))


def cabin_distribution(flights: DataFrame, as_of_date) -> DataFrame:
    """agg_cabin_distribution, every source at once."""
    fut = flights.filter(F.col("date") >= F.lit(as_of_date).cast("date"))
    return fut.groupBy("source", "cabin_class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.concat_ws("-", "origin", "destination")).alias("routes"),
        F.countDistinct("date").alias("dates"),
    )


def coverage_states(flights: DataFrame, key=("origin", "destination", "source")) -> DataFrame:
    """Mergeable exact coverage: per key and month one bit per date seen, one per cabin, row count and newest scrape. A state of a month
    follows from that month's date partitions alone."""
    bit = F.expr("shiftleft(1L, day(date) - 1)")
    cabin = F.coalesce(*[F.when(F.col("cabin_class") == c, F.lit(1 << i).cast("bigint")) for i, c in enumerate(CABINS)], F.lit(0).cast("bigint"))
    return flights.groupBy(*key, F.trunc("date", "month").alias("month")).agg(
        F.bit_or(bit).alias("days"), F.bit_or(cabin).alias("cabins"), F.count(F.lit(1)).alias("n"), F.max("scraped_at_utc").alias("newest"))


def merged_states(a: DataFrame, b: DataFrame, key=("origin", "destination", "source")) -> DataFrame:
    """States of disjoint rows put together: sets by OR, counts by sum."""
    return a.unionByName(b).groupBy(*key, "month").agg(F.bit_or("days").alias("days"), F.bit_or("cabins").alias("cabins"), F.sum("n").alias("n"), F.max("newest").alias("newest"))


def coverage_of(states: DataFrame, key=("origin", "destination", "source")) -> DataFrame:
    """Rows, distinct dates and cabins, cabin list, date range and newest scrape of each key, from states only."""
    low = F.expr("date_add(month, cast(log2(days & -days) as int))")
    high = F.expr("date_add(month, cast(floor(log2(days)) as int))")
    c = states.groupBy(*key).agg(F.sum("n").alias("flight_rows"), F.sum(F.bit_count("days")).alias("dates_covered"), F.bit_or("cabins").alias("_cabins"),
                                 F.min(low).alias("first_date"), F.max(high).alias("last_date"), F.max("newest").alias("last_flight_scrape"))
    has = [F.when(F.col("_cabins").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(x)) for i, x in enumerate(CABINS)]
    return c.select(*key, "flight_rows", "dates_covered", F.bit_count("_cabins").cast("bigint").alias("cabins_seen"),
                    F.array_join(F.array_sort(F.array_compact(F.array(*has))), ",").alias("cabin_list"), "first_date", "last_date", "last_flight_scrape")


def freshness_series(observations: DataFrame, step_hours: int = 1) -> DataFrame:
    """Per source and step of time: observations so far, unexpired ones, and the newest scrape's age in hours. An expiry sweep: +1 at the
    scrape, -1 at the expiry, each at the first step not before it, summed over time; a step is one row whatever the observations."""
    step = F.lit(step_hours * 3600)
    up = lambda c: (F.ceil(F.unix_timestamp(F.col(c).cast("timestamp")) / step) * step).cast("bigint")
    seen = observations.select("source", up("scraped_at_utc").alias("at"), F.lit(1).alias("plus"), F.lit(0).alias("minus"), F.unix_timestamp(F.col("scraped_at_utc").cast("timestamp")).alias("t"))
    gone = observations.select("source", F.greatest(up("expires_at_utc"), up("scraped_at_utc")).alias("at"), F.lit(0).alias("plus"), F.lit(1).alias("minus"), F.lit(None).cast("bigint").alias("t"))
    steps = seen.unionByName(gone).groupBy("source", "at").agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus"), F.max("t").alias("t"))
    w = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.select("source", F.timestamp_seconds("at").cast("timestamp_ntz").alias("at_utc"), F.sum("plus").over(w).alias("rows"),
                        F.sum(F.col("plus") - F.col("minus")).over(w).alias("unexpired_rows"),
                        F.round((F.col("at") - F.max("t").over(w)) / 3600.0, 1).alias("newest_age_h"))


def freshness(flights: DataFrame, as_of) -> DataFrame:
    """agg_freshness: per source rows, newest scrape age (h, 1 dp) and unexpired rows."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    return flights.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("scraped_at_utc").alias("newest_scrape"),
        F.count_if(F.col("expires_at_utc") > ts).alias("unexpired_rows"),
    ).withColumn("newest_age_h", F.round(X.seconds_between("newest_scrape", ts) / 3600.0, 1))


def cheapest_by_cabin(awards: DataFrame, scrape_key) -> DataFrame:
    """agg_cheapest_by_cabin: min non-null points per cabin per scrape (4 fixed pivot values)."""
    return awards.filter(F.col("points_cost").isNotNull()).groupBy(*scrape_key) \
                 .pivot("cabin_class", list(CABINS)).agg(F.min("points_cost"))


def _before_first_block(attempts: DataFrame, run="run_id", seq="seq") -> DataFrame:
    """Attempts strictly before the run's first block, plus the blocked route and flag."""
    blocks = attempts.filter(F.col("outcome") == "blocked").groupBy(run).agg(
        F.min_by(F.struct(F.col("origin").alias("b_origin"), F.col("dest").alias("b_dest"), F.col(seq).alias("b_seq")),
                 F.col(seq)).alias("_b"))
    j = attempts.join(blocks, run, "left")
    return j.filter(F.col("_b").isNull() | (F.col(seq) < F.col("_b.b_seq")))


def run_outcome(attempts: DataFrame) -> DataFrame:
    """agg_run_outcome over an attempt log (run_id, seq, origin, dest, outcome, records).

    Attempts after the first block are never made; the blocked route is not
    counted as scraped. Status: blocked -> failed (errors, no progress) ->
    partial (errors) -> healthy.
    """
    a = _before_first_block(attempts)
    blocked_route = (F.col("_b").isNotNull() & (F.col("origin") == F.col("_b.b_origin"))
                     & (F.col("dest") == F.col("_b.b_dest")))
    a = a.withColumn("_counted", ~F.coalesce(blocked_route, F.lit(False)))
    per_route = a.groupBy("run_id", "origin", "dest").agg(
        F.first(F.col("_b").isNotNull()).alias("blocked"),
        F.bool_and("_counted").alias("counted"),
        F.sum("records").alias("records"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.count_if(F.col("outcome").isin("ok", "empty")).alias("progress_attempts"),
    )
    # runs whose only attempt is the block still need a row
    runs = attempts.groupBy("run_id").agg(F.count_if(F.col("outcome") == "blocked").alias("_nb"))
    per_run = per_route.groupBy("run_id").agg(
        F.sum("records").alias("records"),
        F.sum("errors").alias("errors"),
        F.count_if("counted").alias("routes_scraped"),
        F.count_if(F.col("counted") & (F.col("progress_attempts") > 0)).alias("routes_with_progress"),
        F.count_if(F.col("counted") & (F.col("records") == 0)).alias("routes_zero"),
    )
    out = runs.join(per_run, "run_id", "left").select(
        "run_id", (F.col("_nb") > 0).alias("blocked"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("records", "errors", "routes_scraped", "routes_with_progress", "routes_zero")])
    status = (F.when(F.col("blocked"), "blocked")
               .when((F.col("errors") > 0) & (F.col("routes_with_progress") == 0), "failed")
               .when(F.col("errors") > 0, "partial").otherwise("healthy"))
    return out.withColumn("status", status)


def cash_run(attempts: DataFrame) -> DataFrame:
    """agg_cash_run: per run units attempted, fares, zero-yield, failed, blocked; units after
    the first block are not attempted (the blocked unit itself is not counted)."""
    a = _before_first_block(attempts)
    runs = attempts.groupBy("run_id").agg(F.count_if(F.col("outcome") == "blocked").alias("_nb"))
    agg = a.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("records").cast("bigint").alias("fares"),
        F.count_if(F.col("outcome") == "empty").alias("zero"),
        F.count_if(F.col("outcome") == "error").alias("failed"),
    )
    return runs.join(agg, "run_id", "left").select(
        "run_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("units", "fares", "zero", "failed")],
        (F.col("_nb") > 0).alias("blocked"))


def check_constraint_violations(awards: DataFrame, cash: DataFrame, bonuses: DataFrame) -> DataFrame:
    """flt_check_constraints: violations per table CHECK, computed in one pass per table."""
    a = awards.agg(F.count_if(~(F.col("points_cost") > 0)).alias("points_positive"),
                   F.count_if(~F.col("cabin_class").isin(*CABINS)).alias("cabin_enum"))
    c = cash.agg(F.count_if(~(F.col("cash_price") > 0)).alias("cash_positive"))
    b = bonuses.agg(F.count_if(~(F.col("bonus_pct") > 0)).alias("bonus_positive"),
                    F.count_if(F.col("ends_at") < F.col("starts_at")).alias("bonus_interval"))
    stack = lambda df, tbl: df.select(F.explode(F.array(*[
        F.struct(F.lit(tbl).alias("table_name"), F.lit(n).alias("constraint_name"), F.col(n).alias("violations"))
        for n in df.columns])).alias("s")).select("s.*")
    return stack(a, "flights").unionByName(stack(c, "cash_fares")).unionByName(stack(b, "transfer_bonuses"))


def run_pressure(attempts: DataFrame, due: DataFrame, budget_s: int, airline: Column) -> DataFrame:
    """agg_run_outcome with a time budget and queue pressure. A run begins no route once ``budget_s`` seconds have passed since its
    first attempt: routes not begun are left out of its outcome and it has stopped early (unless a block ended it before).

    due: distinct (origin, dest, airline) of the due routes; ``airline``: a run's carrier. Adds the airline's due routes, those of them
    that the run was given, how many stay due, and the fill ratio (half-even, null without due routes)."""
    begun = attempts.groupBy("run_id", "origin", "dest").agg(F.min("ts").alias("_from"))
    start = attempts.groupBy("run_id").agg(F.min("ts").alias("_start"))
    routes = begun.join(start, "run_id").withColumn(
        "_reached", F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_from")) < F.lit(budget_s * 1_000_000))
    reached = attempts.join(routes.filter("_reached").select("run_id", "origin", "dest"), ["run_id", "origin", "dest"], "left_semi")
    given = routes.withColumn("airline", airline).join(due.withColumn("_due", F.lit(True)), ["origin", "dest", "airline"], "left")
    given = given.groupBy("run_id").agg(F.first("airline").alias("airline"), F.count("_due").alias("queue_selected_routes"),
                                        F.count_if(~F.col("_reached")).alias("_left"))
    total = due.groupBy("airline").agg(F.count(F.lit(1)).alias("due_routes"))
    out = run_outcome(reached).join(given, "run_id").join(total, "airline", "left")
    due_n, picked = F.coalesce("due_routes", F.lit(0)), F.col("queue_selected_routes")
    stopped = (F.col("_left") > 0) & ~F.col("blocked")
    return out.select(
        "run_id", "airline", "blocked", stopped.alias("stopped_early"), "records", "errors", "routes_scraped", "routes_with_progress",
        "routes_zero", F.when((F.col("status") == "healthy") & stopped, "partial").otherwise(F.col("status")).alias("status"),
        due_n.alias("due_routes"), picked, F.greatest(due_n - picked, F.lit(0)).alias("queue_left_due_estimate"),
        F.when(due_n > 0, F.bround(picked / due_n, 2)).alias("queue_fill_ratio"))
