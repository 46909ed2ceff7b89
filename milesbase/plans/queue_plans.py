"""Work queue, folds and date spines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import folds, merge, queue as Q, reports, spine
from milesbase.plans import domain as D
from milesbase.plans.registry import query
from milesbase.sources.dims import METROS
from milesbase.sources.fixtures import AS_OF, AS_OF_DATE

QKEY = ["origin", "dest", "airline"]
DUE_LIMIT = 50
SHARDS, MAX_LEGS, SCRAPE_DAYS = 3, 10, 3
INLINE_DATES = 5
SEARCH_DAYS = 30
CASH_PE_EVERY_N = 4
DEMOTED_CABINS = ("premium_economy", "first")


def routes_queue(L):
    """The keyed queue (origin, dest, airline): first fixture row per key."""
    return merge.first_per_key(D.queue(L), QKEY, ["queue_id"])


RQ_CTE = """
rq AS (SELECT * FROM fx_queue QUALIFY row_number() OVER (PARTITION BY origin, dest, airline ORDER BY queue_id) = 1)"""
_TIER_RANK = "CASE priority_tier WHEN 'HIGH' THEN 1 WHEN 'MED' THEN 2 ELSE 3 END"
_LO = "CASE {t} WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 WHEN 'LOW' THEN 48 ELSE 48 END"
_HI = "CASE {t} WHEN 'HIGH' THEN 24 WHEN 'MED' THEN 72 WHEN 'LOW' THEN 144 ELSE 48 END"
_STEP = "CASE {t} WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 WHEN 'LOW' THEN 48 ELSE 48 END"
_SECS = "CAST(epoch({b}) - epoch({a}) AS DOUBLE)"
_DECAY = (f"CASE WHEN last_search_at_utc IS NULL OR coalesce(decayed_demand, 0) <= 0 "
          f"OR {_SECS.format(a='last_search_at_utc', b=chr(39) + AS_OF + chr(39) + '::TIMESTAMP')} / 86400.0 <= 0 "
          f"THEN coalesce(decayed_demand, 0) ELSE coalesce(decayed_demand, 0) * pow(2.0, -({_SECS.format(a='last_search_at_utc', b=chr(39) + AS_OF + chr(39) + '::TIMESTAMP')} / 86400.0) / 14.0) END")
_OVERDUE = f"{_SECS.format(a='next_scrape_at_utc', b=chr(39) + AS_OF + chr(39) + '::TIMESTAMP')} / 3600.0 / ({_LO.format(t='priority_tier')})"
_SCORE = (f"0.5 * least(1.0, ({_DECAY}) / 10.0) + 0.3 * greatest(0.0, least(1.0, {_OVERDUE})) "
          f"+ 0.2 * greatest(0.0, least(1.0, coalesce(change_rate, 0.5)))")


# ------------------------------------------------------------------ scalar scoring
@query("fn_demand_decay", f"SELECT queue_id, {_DECAY} AS eff_demand FROM fx_queue")
def fn_demand_decay(spark, sf_dir):
    """Stored demand decayed to as_of with a 14-day half-life (future / missing timestamps unchanged)."""
    q = D.lk(spark, sf_dir).fx_queue
    return q.select("queue_id", Q.decay_demand(F.coalesce("decayed_demand", F.lit(0.0)), "last_search_at_utc", AS_OF)
                    .alias("eff_demand"))


@query("fn_overdue", f"SELECT queue_id, {_OVERDUE} AS overdue FROM fx_queue")
def fn_overdue(spark, sf_dir):
    """Overdue ratio with the tier's lower cadence bound as interval (no stored interval)."""
    q = D.lk(spark, sf_dir).fx_queue
    return q.select("queue_id", Q.overdue_ratio("next_scrape_at_utc", X.cadence_lo("priority_tier").cast("double"), AS_OF)
                    .alias("overdue"))


@query("fn_score", f"SELECT queue_id, {_SCORE} AS score FROM fx_queue")
def fn_score(spark, sf_dir):
    """Queue priority score: weighted normalised demand, overdue ratio and change rate."""
    return Q.scored(D.lk(spark, sf_dir).fx_queue, AS_OF).select("queue_id", "score")


@query("fn_tier_rank", f"SELECT queue_id, priority_tier, {_TIER_RANK} AS tier_rank FROM fx_queue")
def fn_tier_rank(spark, sf_dir):
    """Tier rank HIGH 1, MED 2, anything else 3."""
    q = D.lk(spark, sf_dir).fx_queue
    return q.select("queue_id", "priority_tier", X.tier_rank("priority_tier").alias("tier_rank"))


@query("fn_tier_default", """
SELECT DISTINCT a.origin, a.destination, a.airline, coalesce(rq.priority_tier, 'MED') AS tier_used
FROM award_batch a LEFT JOIN rq ON rq.origin = a.origin AND rq.dest = a.destination AND rq.airline = a.airline""",
       D.AWARD_BATCH_CTE + "," + RQ_CTE)
def fn_tier_default(spark, sf_dir):
    """Tier used to stamp a route's scrape: its queue tier, else MED (on-demand)."""
    L = D.lk(spark, sf_dir)
    r = D.award_batch(L).select("origin", "destination", "airline").distinct()
    q = routes_queue(L).select("origin", F.col("dest").alias("destination"), "airline", "priority_tier")
    return r.join(q, ["origin", "destination", "airline"], "left").select(
        "origin", "destination", "airline", X.tier_default("priority_tier").alias("tier_used"))


@query("fn_expiry", """
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, scraped_at_utc, tier,
 scraped_at_utc + INTERVAL '1' HOUR * CASE tier WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 ELSE 48 END AS expires_at_utc FROM fx_award""")
def fn_expiry(spark, sf_dir):
    """scraped_at + TTL(tier) hours; an unknown tier falls back to LOW."""
    a = D.lk(spark, sf_dir).fx_award
    return a.select(*D.AWARD_KEY, "scraped_at_utc", "tier", X.expiry().alias("expires_at_utc"))


# ------------------------------------------------------------------ due batch, shards, spines
def _due_sql(limit):
    fetch = max(limit, limit * 4)
    return f"""
due AS (SELECT * FROM fx_queue WHERE next_scrape_at_utc <= TIMESTAMP '{AS_OF}'),
cnt AS (SELECT airline, count(*) AS due_count FROM due GROUP BY airline),
s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY airline ORDER BY {_TIER_RANK}, next_scrape_at_utc, queue_id) AS stage1_rank FROM due) WHERE stage1_rank <= {fetch}),
s2 AS (SELECT *, {_SCORE} AS score FROM s1),
batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY airline ORDER BY CASE WHEN last_scraped_at_utc IS NULL THEN 0 ELSE 1 END, score DESC, stage1_rank) AS batch_rank FROM s2)
  JOIN cnt USING (airline) WHERE batch_rank <= {limit})"""


@query("win_due_batch", "SELECT airline, batch_rank, stage1_rank, queue_id, origin, dest, priority_tier, score, due_count FROM batch",
       _due_sql(DUE_LIMIT))
def win_due_batch(spark, sf_dir):
    """Two-stage top-k per airline: 4k most overdue by tier, then never-scraped first and score."""
    b = Q.due_batch(D.lk(spark, sf_dir).fx_queue, AS_OF, DUE_LIMIT)
    return b.select("airline", "batch_rank", "stage1_rank", "queue_id", "origin", "dest", "priority_tier", "score", "due_count")


@query("win_shard_stride", f"""
SELECT airline, (batch_rank - 1) % {SHARDS} AS shard, batch_rank, queue_id FROM batch WHERE (batch_rank - 1) // {SHARDS} < {MAX_LEGS}""",
       _due_sql(SHARDS * MAX_LEGS))
def win_shard_stride(spark, sf_dir):
    """Each shard's stride of the airline's due batch (max_legs x shards), capped at max_legs."""
    b = Q.due_batch(D.lk(spark, sf_dir).fx_queue, AS_OF, SHARDS * MAX_LEGS)
    return Q.shard_stride(b, SHARDS, MAX_LEGS).select("airline", "shard", "batch_rank", "queue_id")


@query("win_due_list_stride", f"""
SELECT airline, (r - 1) % {SHARDS} AS shard, (r - 1) // {SHARDS} AS leg, r AS due_rank, due_count, queue_id FROM (
 SELECT *, row_number() OVER (PARTITION BY airline ORDER BY {_TIER_RANK}, next_scrape_at_utc, queue_id) AS r, count(*) OVER (PARTITION BY airline) AS due_count
 FROM fx_queue WHERE next_scrape_at_utc <= TIMESTAMP '{AS_OF}')""")
def win_due_list_stride(spark, sf_dir):
    """Each airline's whole due list dealt to shards by stride, without a cap on legs or list."""
    d = Q.due_list(D.lk(spark, sf_dir).fx_queue, AS_OF)
    rn = F.col("due_rank") - 1
    return d.select("airline", F.pmod(rn, F.lit(SHARDS)).cast("bigint").alias("shard"), X.idiv(rn, F.lit(SHARDS)).cast("bigint").alias("leg"),
                    "due_rank", "due_count", "queue_id")


@query("gen_units", f"""
SELECT airline, (batch_rank - 1) % {SHARDS} AS shard, queue_id, origin, dest, DATE '{AS_OF_DATE}' + CAST(d AS INT) AS date
FROM batch, range(0, {SCRAPE_DAYS}) r(d) WHERE (batch_rank - 1) // {SHARDS} < {MAX_LEGS}""", _due_sql(SHARDS * MAX_LEGS))
def gen_units(spark, sf_dir):
    """Each shard's routes x the scrape window (dates exploded per route row, no cross join)."""
    b = Q.shard_stride(Q.due_batch(D.lk(spark, sf_dir).fx_queue, AS_OF, SHARDS * MAX_LEGS), SHARDS, MAX_LEGS)
    b = b.select("airline", "shard", "queue_id", "origin", "dest")
    return spine.explode_dates(b, AS_OF_DATE, F.sequence(F.lit(0), F.lit(SCRAPE_DAYS - 1)))


@query("gen_dense_sparse", f"""
SELECT queue_id, DATE '{AS_OF_DATE}' + CAST(o AS INT) AS date FROM (
 SELECT queue_id, unnest(list_distinct(list_concat(range(0, least(search_count % 8, mx)),
  range(least(search_count % 8, mx), least(30, mx), greatest(1, queue_id % 4)),
  CASE WHEN mx > 30 THEN range(30, mx, 7) ELSE [] END))) AS o
 FROM (SELECT *, CASE WHEN airline IN ('AS', 'B6') THEN 90 ELSE 30 END AS mx FROM fx_queue) q) t""")
def gen_dense_sparse(spark, sf_dir):
    """Per queue row: dense days (search_count % 8), then every (queue_id % 4) days to 30,
    then weekly to the carrier's horizon (90 for AS/B6, else 30), exclusive, deduped."""
    q = D.lk(spark, sf_dir).fx_queue
    q = q.withColumn("mx", F.when(F.col("airline").isin("AS", "B6"), 90).otherwise(30))
    offs = spine.dense_sparse_offsets(F.pmod("search_count", F.lit(8)), F.pmod("queue_id", F.lit(4)).cast("int"), F.col("mx"))
    return spine.explode_dates(q.select("queue_id", "mx", "search_count"), AS_OF_DATE, offs).select("queue_id", "date")


_CSV_SQL = """CASE WHEN request_id % 2 = 0 THEN CAST(date_from AS VARCHAR) || ', ,x,' || CAST(date_to AS VARCHAR) ELSE '' END"""


@query("gen_plan", f"""
WITH r AS (SELECT request_id, origin, destination, {_CSV_SQL} AS csv FROM fx_request),
p AS (SELECT request_id, list_filter(list_transform(string_split(csv, ','), lambda x: TRY_CAST(trim(x) AS DATE)), lambda x: x IS NOT NULL) AS parsed, origin, destination FROM r)
SELECT request_id, upper(origin) AS origin, upper(destination) AS destination,
 unnest(CASE WHEN len(parsed) > 0 THEN parsed ELSE list_transform(range(0, 5), lambda i: DATE '{AS_OF_DATE}' + CAST(i AS INT)) END) AS date FROM p""")
def gen_plan(spark, sf_dir):
    """On-demand plan of every request as shard 0 emits it (other shards emit none, so the union over
    shards is shard 0's plan): the CSV dates when any parse, else the next 5 days."""
    r = D.lk(spark, sf_dir).fx_request
    csv = F.when(F.pmod("request_id", F.lit(2)) == 0,
                 F.concat(F.col("date_from").cast("string"), F.lit(", ,x,"), F.col("date_to").cast("string"))).otherwise(F.lit(""))
    r = r.select("request_id", F.upper("origin").alias("origin"), F.upper("destination").alias("destination"),
                 F.explode(spine.plan_dates(csv, AS_OF_DATE, 5)).alias("date"))
    return r


@query("fn_parse_dates_csv", f"""
SELECT request_id, list_filter(list_transform(string_split({_CSV_SQL}, ','), lambda x: TRY_CAST(trim(x) AS DATE)), lambda x: x IS NOT NULL) AS dates FROM fx_request""")
def fn_parse_dates_csv(spark, sf_dir):
    """CSV of ISO dates -> dates, blank and malformed tokens dropped."""
    r = D.lk(spark, sf_dir).fx_request
    csv = F.when(F.pmod("request_id", F.lit(2)) == 0,
                 F.concat(F.col("date_from").cast("string"), F.lit(", ,x,"), F.col("date_to").cast("string"))).otherwise(F.lit(""))
    from milesbase.operators.text_parse import parse_dates_csv
    return r.select("request_id", parse_dates_csv(csv).alias("dates"))


@query("flt_demote_cabins", f"""
SELECT run_id, cabin FROM (SELECT DISTINCT run_id FROM fx_attempt) r, (VALUES ('economy'), ('business'), ('premium_economy'), ('first')) c(cabin)
WHERE cabin NOT IN ('premium_economy', 'first') OR {CASH_PE_EVERY_N} <= 1 OR run_id % {CASH_PE_EVERY_N} = 0""")
def flt_demote_cabins(spark, sf_dir):
    """Cabins per cash run: slow cabins only every Nth run (run index = run id)."""
    runs = D.lk(spark, sf_dir).fx_attempt.select("run_id").distinct()
    cabins = F.array(*[F.lit(c) for c in ("economy", "business", "premium_economy", "first")])
    r = runs.withColumn("cabin", F.explode(cabins))
    keep = (~F.col("cabin").isin(*DEMOTED_CABINS)) | F.lit(CASH_PE_EVERY_N <= 1) | \
           (F.pmod("run_id", F.lit(CASH_PE_EVERY_N)) == 0)
    return r.filter(keep)


# ------------------------------------------------------------------ stride sample
_FRESH_CTE = D.FLIGHTS_CTE + """,
fresh AS (SELECT DISTINCT origin, destination, source, date FROM flights WHERE expires_at_utc > TIMESTAMP '2024-01-31 00:00:00')"""


def _stride_sql(src, key, n):
    return f"""SELECT {key}, list(date ORDER BY date) AS sample FROM (
 SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY date) - 1 AS idx, count(*) OVER (PARTITION BY {key}) AS cnt FROM {src})
WHERE cnt <= {n} OR list_contains(list_transform(range(0, {n}), lambda i: CAST(round_even(i * (cnt - 1) / {n - 1}, 0) AS BIGINT)), idx)
GROUP BY {key}"""


def _stride(df, key, n):
    w = Window.partitionBy(*key).orderBy("date")
    s = df.withColumn("_idx", F.row_number().over(w) - 1).withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    s = s.filter(Q.stride_keep("_idx", "_cnt", n))
    return s.groupBy(*key).agg(F.array_sort(F.collect_list("date")).alias("sample"))


@query("win_stride_sample", _stride_sql("fresh", "origin, destination, source", INLINE_DATES), _FRESH_CTE)
def win_stride_sample(spark, sf_dir):
    """At most 5 evenly spaced fresh dates per (route, source); first and last kept, half-to-even."""
    f = D.flights_table(D.lk(spark, sf_dir)).filter(F.col("expires_at_utc") > F.lit(AS_OF).cast("timestamp_ntz"))
    f = f.select("origin", "destination", "source", "date").distinct()
    return _stride(f, ["origin", "destination", "source"], INLINE_DATES)


# ------------------------------------------------------------------ folds
_SEARCH_AGG = f"""
sagg AS (SELECT origin, dest, airline, sum(pow(2.0, -greatest({_SECS.format(a='ts', b=chr(39) + AS_OF + chr(39) + '::TIMESTAMP')} / 86400.0, 0) / 14.0)) AS demand,
  count(*) AS searches, max(ts) AS last_search_at_utc FROM fx_search GROUP BY origin, dest, airline)"""


@query("fold_demand", "SELECT * FROM sagg", _SEARCH_AGG)
def fold_demand(spark, sf_dir):
    """Decayed demand at as_of rebuilt from the search log (closed form of decay-then-add-one)."""
    return folds.demand_from_log(D.lk(spark, sf_dir).fx_search, QKEY, AS_OF)


@query("fold_search_count", """
SELECT coalesce(rq.origin, s.origin) AS origin, coalesce(rq.dest, s.dest) AS dest, coalesce(rq.airline, s.airline) AS airline,
 coalesce(rq.priority_tier, 'LOW') AS priority_tier, CAST(coalesce(rq.search_count, 0) + coalesce(s.searches, 0) AS BIGINT) AS search_count
FROM rq FULL OUTER JOIN sagg s ON s.origin = rq.origin AND s.dest = rq.dest AND s.airline = rq.airline""", RQ_CTE + "," + _SEARCH_AGG)
def fold_search_count(spark, sf_dir):
    """+1 per search on the keyed queue; a searched route without a row is created LOW."""
    L = D.lk(spark, sf_dir)
    s = folds.demand_from_log(L.fx_search, QKEY, AS_OF).select(*QKEY, "searches")
    j = routes_queue(L).select(*QKEY, "priority_tier", "search_count").join(s, QKEY, "full")
    return j.select(*QKEY, F.coalesce("priority_tier", F.lit("LOW")).alias("priority_tier"),
                    (F.coalesce("search_count", F.lit(0)) + F.coalesce("searches", F.lit(0))).cast("bigint").alias("search_count"))


_PROMOTE_SQL = """CASE WHEN t0 = 'LOW' THEN CASE WHEN airline NOT IN ('AS') AND n >= greatest(greatest(1, 3 - c0) + 1, 10 - c0) THEN 'HIGH'
   WHEN n >= greatest(1, 3 - c0) THEN 'MED' ELSE 'LOW' END
 WHEN t0 = 'MED' THEN CASE WHEN airline NOT IN ('AS') AND n >= greatest(1, 10 - c0) THEN 'HIGH' ELSE 'MED' END ELSE t0 END"""


@query("fold_promote", f"""
SELECT origin, dest, airline, t0 AS tier_before, c0 AS count_before, n AS searches, {_PROMOTE_SQL} AS priority_tier FROM (
 SELECT s.origin, s.dest, s.airline, coalesce(rq.priority_tier, 'LOW') AS t0, coalesce(rq.search_count, 0) AS c0, s.searches AS n
 FROM sagg s LEFT JOIN rq ON s.origin = rq.origin AND s.dest = rq.dest AND s.airline = rq.airline) x""", RQ_CTE + "," + _SEARCH_AGG)
def fold_promote(spark, sf_dir):
    """Tier after a key's searches, one step per search from its stored tier and count."""
    L = D.lk(spark, sf_dir)
    s = folds.demand_from_log(L.fx_search, QKEY, AS_OF).select(*QKEY, F.col("searches").alias("n"))
    j = s.join(routes_queue(L).select(*QKEY, "priority_tier", "search_count"), QKEY, "left")
    j = j.select(*QKEY, F.coalesce("priority_tier", F.lit("LOW")).alias("tier_before"),
                 F.coalesce("search_count", F.lit(0)).alias("count_before"), F.col("n").alias("searches"))
    return j.withColumn("priority_tier", Q.promoted_tier("tier_before", "count_before", "searches", "airline"))


_SCRAPES_CTE = D.AWARD_BATCH_CTE + "," + RQ_CTE + """,
scrapes AS (SELECT origin, destination, airline, scraped_at_utc,
 min(points_cost) FILTER (WHERE cabin_class = 'economy') AS economy, min(points_cost) FILTER (WHERE cabin_class = 'premium_economy') AS premium_economy,
 min(points_cost) FILTER (WHERE cabin_class = 'business') AS business, min(points_cost) FILTER (WHERE cabin_class = 'first') AS first
 FROM award_batch WHERE points_cost IS NOT NULL GROUP BY origin, destination, airline, scraped_at_utc),
flags AS (SELECT *, (lag(1) OVER w IS NULL OR economy IS DISTINCT FROM lag(economy) OVER w OR premium_economy IS DISTINCT FROM lag(premium_economy) OVER w
  OR business IS DISTINCT FROM lag(business) OVER w OR first IS DISTINCT FROM lag(first) OVER w) AS changed
  FROM scrapes WINDOW w AS (PARTITION BY origin, destination, airline ORDER BY scraped_at_utc)),
bounds AS (SELECT r.origin, r.destination, r.airline, """ + _LO.format(t="q.priority_tier") + " AS lo, " + \
    _HI.format(t="q.priority_tier") + " AS hi, " + _STEP.format(t="q.priority_tier") + """ AS step
  FROM (SELECT DISTINCT origin, destination, airline FROM scrapes) r LEFT JOIN rq q ON q.origin = r.origin AND q.dest = r.destination AND q.airline = r.airline)"""


def _scrapes(L):
    return reports.cheapest_by_cabin(D.award_batch(L), ["origin", "destination", "airline", "scraped_at_utc"])


def _bounds(L, routes):
    q = routes_queue(L).select("origin", F.col("dest").alias("destination"), "airline", "priority_tier")
    b = routes.join(q, ["origin", "destination", "airline"], "left")
    return b.select("origin", "destination", "airline", X.cadence_lo("priority_tier").alias("lo"),
                    X.cadence_hi("priority_tier").alias("hi"), X.cadence_step("priority_tier").alias("step"),
                    X.cadence_lo("priority_tier").cast("double").alias("start"))


@query("fold_changed_flag", "SELECT origin, destination, airline, scraped_at_utc, changed FROM flags", _SCRAPES_CTE)
def fold_changed_flag(spark, sf_dir):
    """Per route scrape: did the cheapest-points-by-cabin map move vs the previous scrape?"""
    return folds.changed_flags(_scrapes(D.lk(spark, sf_dir))).select(
        "origin", "destination", "airline", "scraped_at_utc", "changed")


@query("fold_change_rate", """
SELECT origin, destination, airline, sum(0.3 * pow(0.7, n - i) * CAST(changed AS DOUBLE)) + pow(0.7, any_value(n)) * 0.5 AS change_rate,
 count(*) AS scrapes FROM (SELECT *, row_number() OVER (PARTITION BY origin, destination, airline ORDER BY scraped_at_utc) AS i,
 count(*) OVER (PARTITION BY origin, destination, airline) AS n FROM flags) GROUP BY origin, destination, airline""", _SCRAPES_CTE)
def fold_change_rate(spark, sf_dir):
    """EWMA (alpha 0.3, seed 0.5) of the changed flag, in closed form."""
    return folds.change_rate(folds.changed_flags(_scrapes(D.lk(spark, sf_dir))))


@query("fold_interval", """
SELECT origin, destination, airline, list_reduce(list_sort(list({'t': scraped_at_utc, 'c': changed, 'lo': lo, 'hi': hi, 'st': step})),
 lambda acc, x: greatest(CAST(x.lo AS DOUBLE), least(CAST(x.hi AS DOUBLE), CASE WHEN x.c THEN acc * 0.5 ELSE acc + x.st END)), CAST(any_value(lo) AS DOUBLE)) AS interval_h,
 count(*) AS scrapes FROM flags JOIN bounds USING (origin, destination, airline) GROUP BY origin, destination, airline""", _SCRAPES_CTE)
def fold_interval(spark, sf_dir):
    """AIMD cadence folded over a route's scrapes, clamped to its tier's bounds after each step."""
    L = D.lk(spark, sf_dir)
    flags = folds.changed_flags(_scrapes(L))
    bounds = _bounds(L, flags.select("origin", "destination", "airline").distinct())
    return folds.interval_fold(flags, bounds)


_MARK_STEP = """CASE WHEN x.blocked THEN {'prev': acc.prev, 'rate': acc.rate, 'interval_h': acc.interval_h, 'next_scrape_at_utc': x.t + INTERVAL 30 MINUTE, 'changes': acc.changes, 'scrapes': acc.scrapes}
 ELSE {'prev': x.cheap, 'rate': CAST(0.3 AS DOUBLE) * CAST((acc.prev IS NULL OR acc.prev IS DISTINCT FROM x.cheap) AS DOUBLE) + CAST(0.7 AS DOUBLE) * acc.rate,
  'interval_h': IV, 'next_scrape_at_utc': x.t + to_microseconds(CAST(IV * 3600000000 AS BIGINT)),
  'changes': acc.changes + CAST((acc.prev IS NULL OR acc.prev IS DISTINCT FROM x.cheap) AS INTEGER), 'scrapes': acc.scrapes + 1} END""".replace(
    "IV", "greatest(CAST(x.lo AS DOUBLE), least(CAST(x.hi AS DOUBLE), CASE WHEN (acc.prev IS NULL OR acc.prev IS DISTINCT FROM x.cheap) THEN acc.interval_h * 0.5 ELSE acc.interval_h + x.st END))")


MARK_SCRAPED_SQL = f"""
WITH ev AS (SELECT origin, destination, airline, scraped_at_utc AS t, false AS blocked,
  {{'economy': economy, 'premium_economy': premium_economy, 'business': business, 'first': first}} AS cheap FROM scrapes
 UNION ALL SELECT r.origin, r.destination, r.airline, a.ts, true, NULL FROM (SELECT DISTINCT origin, destination, airline FROM scrapes) r
  JOIN fx_attempt a ON a.origin = r.origin AND a.dest = r.destination WHERE a.outcome = 'blocked'),
f AS (SELECT origin, destination, airline, list_reduce(list_sort(list({{'t': t, 'blocked': blocked, 'cheap': cheap, 'lo': lo, 'hi': hi, 'st': step}})),
  lambda acc, x: {_MARK_STEP},
  {{'prev': CAST(NULL AS STRUCT(economy INTEGER, premium_economy INTEGER, business INTEGER, first INTEGER)), 'rate': CAST(0.5 AS DOUBLE),
    'interval_h': CAST(any_value(lo) AS DOUBLE), 'next_scrape_at_utc': CAST(NULL AS TIMESTAMP), 'changes': 0, 'scrapes': 0}}) AS s
  FROM ev JOIN bounds USING (origin, destination, airline) GROUP BY origin, destination, airline)
SELECT origin, destination, airline, s.rate AS rate, s.interval_h AS interval_h, s.next_scrape_at_utc AS next_scrape_at_utc,
 s.changes AS changes, s.scrapes AS scrapes FROM f"""


@query("fold_mark_scraped", MARK_SCRAPED_SQL, _SCRAPES_CTE)
def fold_mark_scraped(spark, sf_dir):
    """Route state after its scrapes and blocks: EWMA rate, AIMD interval, next scrape time."""
    L = D.lk(spark, sf_dir)
    sc = _scrapes(L)
    cheap = F.struct(*[F.col(c) for c in folds.CABIN_COLS])
    ev = sc.select("origin", "destination", "airline", F.col("scraped_at_utc").alias("t"), F.lit(False).alias("blocked"),
                   cheap.alias("cheap"))
    routes = sc.select("origin", "destination", "airline").distinct()
    blocks = L.fx_attempt.filter(F.col("outcome") == "blocked").select("origin", F.col("dest").alias("destination"),
                                                                       F.col("ts").alias("t"))
    ev = ev.unionByName(routes.join(blocks, ["origin", "destination"]).select(
        "origin", "destination", "airline", "t", F.lit(True).alias("blocked"), F.lit(None).cast(folds._CHEAP_T).alias("cheap")))
    return folds.mark_scraped_fold(ev, _bounds(L, routes))


@query("snk_keyed_update", f"""
WITH ev AS (SELECT origin, destination, airline, scraped_at_utc AS t, false AS blocked,
  {{'economy': economy, 'premium_economy': premium_economy, 'business': business, 'first': first}} AS cheap FROM scrapes
 UNION ALL SELECT r.origin, r.destination, r.airline, a.ts, true, NULL FROM (SELECT DISTINCT origin, destination, airline FROM scrapes) r
  JOIN fx_attempt a ON a.origin = r.origin AND a.dest = r.destination WHERE a.outcome = 'blocked'),
f AS (SELECT origin, destination, airline, list_reduce(list_sort(list({{'t': t, 'blocked': blocked, 'cheap': cheap, 'lo': lo, 'hi': hi, 'st': step}})),
  lambda acc, x: {_MARK_STEP},
  {{'prev': CAST(NULL AS STRUCT(economy INTEGER, premium_economy INTEGER, business INTEGER, first INTEGER)), 'rate': CAST(0.5 AS DOUBLE),
    'interval_h': CAST(any_value(lo) AS DOUBLE), 'next_scrape_at_utc': CAST(NULL AS TIMESTAMP), 'changes': 0, 'scrapes': 0}}) AS s
  FROM ev JOIN bounds USING (origin, destination, airline) GROUP BY origin, destination, airline)
SELECT rq.queue_id, rq.origin, rq.dest, rq.airline, coalesce(f.s.rate, rq.change_rate) AS change_rate,
 CASE WHEN f.origin IS NULL THEN rq.next_scrape_at_utc ELSE f.s.next_scrape_at_utc END AS next_scrape_at_utc
FROM rq LEFT JOIN f ON f.origin = rq.origin AND f.destination = rq.dest AND f.airline = rq.airline""", _SCRAPES_CTE)
def snk_keyed_update(spark, sf_dir):
    """record_scrape_outcome for every route at once: matching queue rows get the folded
    rate / next scrape; queue rows without scrapes are untouched; unknown keys are ignored."""
    L = D.lk(spark, sf_dir)
    st = fold_mark_scraped(spark, sf_dir).select("origin", F.col("destination").alias("dest"), "airline",
                                                 F.col("rate").alias("change_rate"), "next_scrape_at_utc")
    cur = routes_queue(L).select("queue_id", "origin", "dest", "airline", "change_rate", "next_scrape_at_utc")
    return merge.keyed_update(cur, st, QKEY, ["change_rate", "next_scrape_at_utc"])


_FORM_COLS = ["queue_id", *QKEY, "priority_tier", "last_scraped_at_utc", "next_scrape_at_utc"]


@query("snk_keyed_update_forms", """
WITH b AS (SELECT origin, dest, max(ts) + INTERVAL 30 MINUTE AS nxt FROM fx_attempt WHERE outcome = 'blocked' GROUP BY origin, dest),
s AS (SELECT DISTINCT origin, destination AS dest, airline FROM award_batch),
p AS (SELECT origin, dest, airline, """ + _PROMOTE_SQL + """ AS new_tier FROM (
 SELECT s.origin, s.dest, s.airline, coalesce(rq.priority_tier, 'LOW') AS t0, coalesce(rq.search_count, 0) AS c0, s.searches AS n
 FROM sagg s LEFT JOIN rq ON s.origin = rq.origin AND s.dest = rq.dest AND s.airline = rq.airline) x)
SELECT 'blocked' AS form, queue_id, origin, dest, airline, priority_tier, last_scraped_at_utc,
 coalesce((SELECT nxt FROM b WHERE b.origin = rq.origin AND b.dest = rq.dest), next_scrape_at_utc) AS next_scrape_at_utc FROM rq
UNION ALL SELECT 'scraped', queue_id, origin, dest, airline, priority_tier, CASE WHEN hit THEN TIMESTAMP '2024-01-31 00:00:00' ELSE last_scraped_at_utc END,
 CASE WHEN hit THEN TIMESTAMP '2024-01-31 00:00:00' + INTERVAL 1 HOUR * CASE priority_tier WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 ELSE 48 END ELSE next_scrape_at_utc END
 FROM (SELECT *, (origin, dest, airline) IN (SELECT (origin, dest, airline) FROM s) AS hit FROM rq)
UNION ALL SELECT 'tier', queue_id, origin, dest, airline,
 coalesce((SELECT new_tier FROM p WHERE p.origin = rq.origin AND p.dest = rq.dest AND p.airline = rq.airline), priority_tier), last_scraped_at_utc, next_scrape_at_utc FROM rq
UNION ALL SELECT 'reset', queue_id, origin, dest, airline, priority_tier, last_scraped_at_utc, TIMESTAMP '2024-01-31 00:00:00' FROM rq""",
       D.AWARD_BATCH_CTE + "," + RQ_CTE + "," + _SEARCH_AGG)
def snk_keyed_update_forms(spark, sf_dir):
    """The queue after record_blocked_route, mark_route_scraped, set_route_tier and reset_all_route_schedules, each
    from the stored queue (``form``)."""
    L = D.lk(spark, sf_dir)
    rq, now = routes_queue(L).select(*_FORM_COLS), F.lit(AS_OF).cast("timestamp_ntz")
    blocked = L.fx_attempt.filter(F.col("outcome") == "blocked").groupBy("origin", "dest").agg(
        (F.max("ts") + F.expr("INTERVAL 30 MINUTES")).alias("next_scrape_at_utc"))  # attempts name no airline
    scraped = D.award_batch(L).select("origin", F.col("destination").alias("dest"), "airline").distinct()
    scraped = scraped.join(rq.select(*QKEY, "priority_tier"), QKEY).select(
        *QKEY, now.alias("last_scraped_at_utc"), (now + X.hours(X.ttl_hours("priority_tier"))).alias("next_scrape_at_utc"))
    forms = {
        "blocked": merge.keyed_update(rq, blocked, ["origin", "dest"], ["next_scrape_at_utc"]),
        "scraped": merge.keyed_update(rq, scraped, QKEY, ["last_scraped_at_utc", "next_scrape_at_utc"]),
        "tier": merge.keyed_update(rq, fold_promote(spark, sf_dir), QKEY, ["priority_tier"]),
        "reset": rq.withColumn("next_scrape_at_utc", now),
    }
    out = None
    for name, df in forms.items():
        df = df.select(F.lit(name).alias("form"), *_FORM_COLS)
        out = df if out is None else out.unionByName(df)
    return out


_REPLAY_ORD = "scraped_at_utc, points_cost, cash_cost, stops, available_seats, dep_min, duration_minutes, tier"


@query("fold_merge_replay", """
WITH h AS (SELECT origin, destination, date, airline, cabin_class, raw_flight_number,
  list_sort(list({'t': scraped_at_utc, 'points_cost': points_cost, 'cash_cost': cash_cost, 'stops': stops, 'available_seats': available_seats,
   'dep_min': dep_min, 'duration_minutes': duration_minutes, 'tier': tier, 'e': expires_at_utc,
   'm': {'points_cost': points_cost, 'cash_cost': cash_cost, 'stops': stops, 'available_seats': available_seats, 'dep_min': dep_min, 'duration_minutes': duration_minutes}})) AS h
  FROM award_batch GROUP BY origin, destination, date, airline, cabin_class, raw_flight_number),
r AS (SELECT *, list_reduce(h[2:], lambda acc, x: CASE WHEN acc.m IS DISTINCT FROM x.m OR acc.e <= x.t
  THEN {'m': x.m, 't': x.t, 'e': x.e, 'writes': acc.writes + 1} ELSE acc END, {'m': h[1].m, 't': h[1].t, 'e': h[1].e, 'writes': 1}) AS s FROM h)
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, s.m.points_cost AS points_cost, s.m.cash_cost AS cash_cost,
 s.m.stops AS stops, s.m.available_seats AS available_seats, s.m.dep_min AS dep_min, s.m.duration_minutes AS duration_minutes,
 s.t AS scraped_at_utc, s.e AS expires_at_utc, s.writes AS writes FROM r""", D.AWARD_BATCH_CTE)
def fold_merge_replay(spark, sf_dir):
    """Conditional upserts replayed in time order, each applied at its own scrape time."""
    b = D.award_batch(D.lk(spark, sf_dir))
    return folds.merge_replay(b, D.AWARD_KEY, D.AWARD_MATERIAL,
                              order=["points_cost", "cash_cost", "stops", "available_seats", "dep_min", "duration_minutes", "tier"])


@query("fold_user_search", f"""
WITH req AS (SELECT s.origin, s.dest, s.airline, DATE '{AS_OF_DATE}' + CAST(d AS INT) AS date,
  CASE s.airline WHEN 'AS' THEN 'alaska' WHEN 'DL' THEN 'delta' WHEN 'B6' THEN 'jetblue' WHEN 'TK' THEN 'turkish' WHEN 'EY' THEN 'etihad' WHEN 'WN' THEN 'southwest' END AS source
  FROM sagg s, range(0, {SEARCH_DAYS}) r(d)),
miss AS (SELECT req.* FROM req WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.origin = req.origin AND f.destination = req.dest AND f.source = req.source AND f.date = req.date)),
mc AS (SELECT origin, dest, airline, count(*) AS missing_count FROM miss GROUP BY origin, dest, airline),
smp AS ({_stride_sql("miss", "origin, dest, airline", INLINE_DATES)}),
stored AS (SELECT origin, dest, airline, priority_tier, search_count, {_DECAY} AS kept FROM rq),
base AS (SELECT s.origin, s.dest, s.airline, s.demand + coalesce(rq.kept, 0) AS demand, coalesce(rq.priority_tier, 'LOW') AS t0, coalesce(rq.search_count, 0) AS c0, s.searches AS n
  FROM sagg s LEFT JOIN stored rq ON s.origin = rq.origin AND s.dest = rq.dest AND s.airline = rq.airline)
SELECT b.origin, b.dest, b.airline, CAST(c0 + n AS BIGINT) AS search_count, demand, {_PROMOTE_SQL} AS priority_tier,
 mc.missing_count, smp.sample AS inline_dates
FROM base b LEFT JOIN mc USING (origin, dest, airline) LEFT JOIN smp USING (origin, dest, airline)""",
       _FRESH_CTE + "," + RQ_CTE + "," + _SEARCH_AGG)
def fold_user_search(spark, sf_dir):
    """handle_user_search for every searched key: ensure row, count, demand (the stored one decayed to as_of plus
    that of the log), promotion, missing fresh dates in the next 30 days and the <= 5 strided dates to scrape inline."""
    L = D.lk(spark, sf_dir)
    s = folds.demand_from_log(L.fx_search, QKEY, AS_OF)
    kept = Q.decay_demand(F.coalesce("decayed_demand", F.lit(0.0)), "last_search_at_utc", AS_OF).alias("kept")
    base = s.join(routes_queue(L).select(*QKEY, "priority_tier", "search_count", kept), QKEY, "left")
    base = base.select(*QKEY, (F.col("demand") + F.coalesce("kept", F.lit(0.0))).alias("demand"), (F.coalesce("search_count", F.lit(0)) + F.col("searches")).cast("bigint").alias("search_count"),
                       Q.promoted_tier(F.coalesce("priority_tier", F.lit("LOW")), F.coalesce("search_count", F.lit(0)),
                                       F.col("searches"), F.col("airline")).alias("priority_tier"))
    req = s.select(*QKEY, X.case_map("airline", D.AIRLINE_SOURCE).alias("source"))
    req = spine.explode_dates(req, AS_OF_DATE, F.sequence(F.lit(0), F.lit(SEARCH_DAYS - 1)))
    fresh = D.flights_table(L).filter(F.col("expires_at_utc") > F.lit(AS_OF).cast("timestamp_ntz")) \
        .select("origin", F.col("destination").alias("dest"), "source", "date").distinct()
    miss = req.join(fresh, ["origin", "dest", "source", "date"], "left_anti")
    mc = miss.groupBy(*QKEY).agg(F.count(F.lit(1)).alias("missing_count"))
    smp = _stride(miss, QKEY, INLINE_DATES).withColumnRenamed("sample", "inline_dates")
    return base.join(mc, QKEY, "left").join(smp, QKEY, "left").select(
        *QKEY, "search_count", "demand", "priority_tier", "missing_count", "inline_dates")


@query("jn_missing_dates", f"""
WITH req AS (SELECT s.origin, s.dest, s.airline, DATE '{AS_OF_DATE}' + CAST(d AS INT) AS date,
  CASE s.airline WHEN 'AS' THEN 'alaska' WHEN 'DL' THEN 'delta' WHEN 'B6' THEN 'jetblue' WHEN 'TK' THEN 'turkish' WHEN 'EY' THEN 'etihad' WHEN 'WN' THEN 'southwest' END AS source
  FROM sagg s, range(0, {SEARCH_DAYS}) r(d))
SELECT req.origin, req.dest, req.airline, req.date FROM req WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.origin = req.origin
 AND f.destination = req.dest AND f.source = req.source AND f.date = req.date)""", _FRESH_CTE + "," + _SEARCH_AGG)
def jn_missing_dates(spark, sf_dir):
    """Requested dates minus dates with fresh data for the route's provider (left anti join)."""
    L = D.lk(spark, sf_dir)
    keys = L.fx_search.select(*QKEY).distinct().withColumn("source", X.case_map("airline", D.AIRLINE_SOURCE))
    req = spine.explode_dates(keys, AS_OF_DATE, F.sequence(F.lit(0), F.lit(SEARCH_DAYS - 1)))
    fresh = D.flights_table(L).filter(F.col("expires_at_utc") > F.lit(AS_OF).cast("timestamp_ntz")) \
        .select("origin", F.col("destination").alias("dest"), "source", "date").distinct()
    return req.join(fresh, ["origin", "dest", "source", "date"], "left_anti").select(*QKEY, "date")


# ------------------------------------------------------------------ queue sinks and seeding
_SEEDS_CTE = """
seeds AS (SELECT DISTINCT origin, dest, airline, priority_tier FROM fx_queue WHERE priority_tier IN ('HIGH', 'MED'))"""


@query("set_both_directions", """
SELECT origin, dest, airline, CASE min(CASE priority_tier WHEN 'HIGH' THEN 1 ELSE 2 END) WHEN 1 THEN 'HIGH' ELSE 'MED' END AS priority_tier
FROM (SELECT origin, dest, airline, priority_tier FROM seeds UNION ALL SELECT dest, origin, airline, priority_tier FROM seeds)
WHERE origin <> dest GROUP BY origin, dest, airline""", _SEEDS_CTE)
def set_both_directions(spark, sf_dir):
    """Seeded routes plus their reverses; HIGH entries precede MED, so the first tier seen wins."""
    s = D.lk(spark, sf_dir).fx_queue.filter(F.col("priority_tier").isin("HIGH", "MED")) \
        .select("origin", "dest", "airline", "priority_tier").distinct()
    both = s.unionByName(s.select(F.col("dest").alias("origin"), F.col("origin").alias("dest"), "airline", "priority_tier"))
    both = both.filter(F.col("origin") != F.col("dest"))
    return merge.first_per_key(both.withColumn("_r", X.tier_rank("priority_tier")), QKEY, ["_r"], ["priority_tier"])


@query("snk_insert_absent", """
SELECT origin, dest, airline, priority_tier, search_count FROM rq
UNION ALL SELECT s.origin, s.dest, s.airline, s.priority_tier, 0 FROM (SELECT origin, dest, airline, CASE min(CASE priority_tier WHEN 'HIGH' THEN 1 ELSE 2 END) WHEN 1 THEN 'HIGH' ELSE 'MED' END AS priority_tier
 FROM (SELECT origin, dest, airline, priority_tier FROM seeds UNION ALL SELECT dest, origin, airline, priority_tier FROM seeds) WHERE origin <> dest GROUP BY origin, dest, airline) s
WHERE NOT EXISTS (SELECT 1 FROM rq WHERE rq.origin = s.origin AND rq.dest = s.dest AND rq.airline = s.airline)""", RQ_CTE + "," + _SEEDS_CTE)
def snk_insert_absent(spark, sf_dir):
    """seed_from_config: insert seeded (both-direction) routes whose key is absent; never modify."""
    L = D.lk(spark, sf_dir)
    cur = routes_queue(L).select(*QKEY, "priority_tier", "search_count")
    new = set_both_directions(spark, sf_dir).withColumn("search_count", F.lit(0))
    return merge.insert_absent(new, cur, QKEY)


def _metro_dim(spark):
    rows = [(k, i, a) for k, airports in METROS.items() for i, a in enumerate(airports)]
    return spark.createDataFrame(rows, "token string, pos int, airport string")


_METRO_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {i}, '{a}')" for k, airports in METROS.items() for i, a in enumerate(airports)) + ") AS t(token, pos, airport)"


@query("jn_metro_expand", f"""
WITH m AS ({_METRO_SQL}),
toks AS (SELECT DISTINCT coalesce(mo.token, q.origin) AS o_token, coalesce(md.token, q.dest) AS d_token FROM fx_queue q
  LEFT JOIN m mo ON mo.airport = q.origin LEFT JOIN m md ON md.airport = q.dest),
ex AS (SELECT t.o_token, t.d_token, coalesce(a.airport, t.o_token) AS origin, coalesce(b.airport, t.d_token) AS dest FROM toks t
  LEFT JOIN m a ON a.token = t.o_token LEFT JOIN m b ON b.token = t.d_token)
SELECT DISTINCT o_token, d_token, origin, dest FROM ex WHERE origin <> dest""")
def jn_metro_expand(spark, sf_dir):
    """Route tokens (metro where the airport belongs to one) expanded back to airport pairs;
    self-pairs dropped, deduped."""
    L = D.lk(spark, sf_dir)
    m = F.broadcast(_metro_dim(spark))
    q = L.fx_queue.select("origin", "dest")
    q = q.join(m.select(F.col("airport").alias("origin"), F.col("token").alias("o_token")), "origin", "left") \
         .join(m.select(F.col("airport").alias("dest"), F.col("token").alias("d_token")), "dest", "left")
    toks = q.select(F.coalesce("o_token", "origin").alias("o_token"), F.coalesce("d_token", "dest").alias("d_token")).distinct()
    ex = toks.join(m.select(F.col("token").alias("o_token"), F.col("airport").alias("o_air")), "o_token", "left") \
             .join(m.select(F.col("token").alias("d_token"), F.col("airport").alias("d_air")), "d_token", "left")
    ex = ex.select("o_token", "d_token", F.coalesce("o_air", "o_token").alias("origin"), F.coalesce("d_air", "d_token").alias("dest"))
    return ex.filter(F.col("origin") != F.col("dest")).distinct()


@query("agg_due_count", f"""
SELECT airline, count(*) AS due_count FROM fx_queue WHERE next_scrape_at_utc <= TIMESTAMP '{AS_OF}' GROUP BY airline""")
def agg_due_count(spark, sf_dir):
    """Due routes per airline at as_of."""
    q = D.lk(spark, sf_dir).fx_queue
    return q.filter(F.col("next_scrape_at_utc") <= F.lit(AS_OF).cast("timestamp_ntz")).groupBy("airline") \
            .agg(F.count(F.lit(1)).alias("due_count"))


@query("flt_staleness", f"""
SELECT r.request_id,
 EXISTS (SELECT 1 FROM flights f WHERE f.origin = r.origin AND f.destination = r.destination) AS has_any_flights,
 NOT EXISTS (SELECT 1 FROM flights f WHERE f.origin = r.origin AND f.destination = r.destination AND f.date BETWEEN r.date_from AND r.date_to
  AND (r.airline IS NULL OR f.airline = r.airline) AND f.expires_at_utc > TIMESTAMP '{AS_OF}') AS window_stale,
 NOT EXISTS (SELECT 1 FROM flights f WHERE f.origin = r.origin AND f.destination = r.destination
  AND (r.airline IS NULL OR f.airline = r.airline) AND f.expires_at_utc > TIMESTAMP '{AS_OF}') AS route_stale
FROM fx_request r""", D.FLIGHTS_CTE)
def flt_staleness(spark, sf_dir):
    """has_any_flights (expiry ignored), is_window_stale (no unexpired row in the window) and is_route_stale (none of the
    route and airline on any date) for every request, via semi / anti joins on pre-aggregated route-dates."""
    L = D.lk(spark, sf_dir)
    f = D.flights_table(L)
    routes = f.select("origin", "destination").distinct().withColumn("has_any_flights", F.lit(True))
    live = f.filter(F.col("expires_at_utc") > F.lit(AS_OF).cast("timestamp_ntz")) \
            .select("origin", "destination", "date", "airline").distinct()
    r = L.fx_request.select("request_id", "origin", "destination", "date_from", "date_to", F.col("airline").alias("req_airline"))
    rd = r.withColumn("date", F.explode(F.when(F.col("date_from") <= F.col("date_to"), F.sequence("date_from", "date_to"))
                                        .otherwise(F.array().cast("array<date>"))))
    key = ["origin", "destination", "date"]
    some = rd.filter(F.col("req_airline").isNull()).join(live, key, "left_semi")
    one = rd.filter(F.col("req_airline").isNotNull()).join(live.withColumnRenamed("airline", "req_airline"), [*key, "req_airline"], "left_semi")
    hit = some.select("request_id").union(one.select("request_id")).distinct().withColumn("_fresh", F.lit(True))
    carriers = live.select("origin", "destination", F.col("airline").alias("req_airline")).distinct()
    served = carriers.unionByName(carriers.select("origin", "destination").distinct().withColumn("req_airline", F.lit(None).cast("string")))
    served = served.withColumn("_served", F.lit(True))
    out = r.join(routes, ["origin", "destination"], "left").join(hit, "request_id", "left")
    out = out.join(served, (out["origin"] == served["origin"]) & (out["destination"] == served["destination"])
                   & out["req_airline"].eqNullSafe(served["req_airline"]), "left")
    return out.select("request_id", F.coalesce("has_any_flights", F.lit(False)).alias("has_any_flights"),
                      F.col("_fresh").isNull().alias("window_stale"), F.col("_served").isNull().alias("route_stale"))


@query("prj_coverage_lookup", """
SELECT r.request_id, c.airline, c.last_attempt_utc, c.fare_count FROM fx_request r JOIN
 (SELECT upper(origin) AS origin, upper(dest) AS dest, airline, max(ts) AS last_attempt_utc, CAST(sum(records) AS BIGINT) AS fare_count
  FROM (SELECT a.*, CASE a.seq % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'DL' WHEN 2 THEN 'B6' WHEN 3 THEN 'TK' WHEN 4 THEN 'EY' ELSE 'WN' END AS airline FROM fx_attempt a) x
  GROUP BY upper(origin), upper(dest), airline) c ON c.origin = upper(r.origin) AND c.dest = upper(r.destination)""")
def prj_coverage_lookup(spark, sf_dir):
    """On-demand coverage per (route, airline) joined to every request on the upper-cased route key."""
    L = D.lk(spark, sf_dir)
    a = L.fx_attempt.withColumn("airline", X.case_map(F.pmod("seq", F.lit(6)), dict(enumerate(["AS", "DL", "B6", "TK", "EY"])), "WN"))
    cov = a.groupBy(F.upper("origin").alias("origin"), F.upper("dest").alias("dest"), "airline").agg(
        F.max("ts").alias("last_attempt_utc"), F.sum("records").cast("bigint").alias("fare_count"))
    r = L.fx_request.select("request_id", F.upper("origin").alias("origin"), F.upper("destination").alias("dest"))
    return r.join(cov, ["origin", "dest"]).select("request_id", "airline", "last_attempt_utc", "fare_count")


@query("prj_route_lookup", """
SELECT r.request_id, rq.queue_id, rq.origin, rq.dest, rq.airline, rq.priority_tier, rq.search_count, rq.last_scraped_at_utc AS last_scraped_at,
 rq.next_scrape_at_utc AS next_scrape_at, rq.change_rate FROM fx_request r JOIN rq ON rq.origin = r.origin AND rq.dest = r.destination
 AND rq.airline = coalesce(r.airline, 'AS')""", RQ_CTE)
def prj_route_lookup(spark, sf_dir):
    """get_route of every request: the queue entry of its route and airline (AS where none is named); requests without one have no row."""
    L = D.lk(spark, sf_dir)
    r = L.fx_request.select("request_id", "origin", F.col("destination").alias("dest"), F.coalesce("airline", F.lit("AS")).alias("airline"))
    return r.join(routes_queue(L), QKEY).select(
        "request_id", "queue_id", *QKEY, "priority_tier", "search_count", F.col("last_scraped_at_utc").alias("last_scraped_at"),
        F.col("next_scrape_at_utc").alias("next_scrape_at"), "change_rate")


_OUTCOME_COLS = ["change_rate", "interval_h", "last_cheapest", "last_scraped_at_utc", "next_scrape_at_utc"]
_CHEAPEST_JSON = "'{' || array_to_string(list_filter([" + ", ".join(
    f"'\"{c}\":' || {c}" for c in folds.CABIN_COLS) + "], lambda x: x IS NOT NULL), ',') || '}'"


@query("snk_scrape_outcome", f"""
WITH st AS ({MARK_SCRAPED_SQL}),
lc AS (SELECT origin, destination, airline, {_CHEAPEST_JSON} AS last_cheapest FROM scrapes
  QUALIFY row_number() OVER (PARTITION BY origin, destination, airline ORDER BY scraped_at_utc DESC) = 1)
SELECT rq.queue_id, rq.origin, rq.dest, rq.airline, CASE WHEN st.origin IS NULL THEN rq.change_rate ELSE st.rate END AS change_rate, st.interval_h, lc.last_cheapest,
 CASE WHEN st.origin IS NULL THEN rq.last_scraped_at_utc ELSE TIMESTAMP '{AS_OF}' END AS last_scraped_at_utc,
 CASE WHEN st.origin IS NULL THEN rq.next_scrape_at_utc ELSE st.next_scrape_at_utc END AS next_scrape_at_utc
FROM rq LEFT JOIN st ON st.origin = rq.origin AND st.destination = rq.dest AND st.airline = rq.airline
LEFT JOIN lc ON lc.origin = rq.origin AND lc.destination = rq.dest AND lc.airline = rq.airline""", _SCRAPES_CTE)
def snk_scrape_outcome(spark, sf_dir):
    """record_scrape_outcome in full: rate, interval, cheapest map (JSON text), last and next scrape of every matching queue row; others
    stay as they are and unknown keys are ignored."""
    L = D.lk(spark, sf_dir)
    cheap = _scrapes(L).groupBy("origin", "destination", "airline").agg(
        F.to_json(F.max_by(F.struct(*folds.CABIN_COLS), "scraped_at_utc")).alias("last_cheapest"))
    st = fold_mark_scraped(spark, sf_dir).join(cheap, ["origin", "destination", "airline"]).select(
        "origin", F.col("destination").alias("dest"), "airline", F.col("rate").alias("change_rate"), "interval_h", "last_cheapest",
        F.lit(AS_OF).cast("timestamp_ntz").alias("last_scraped_at_utc"), "next_scrape_at_utc")
    cur = routes_queue(L).select("queue_id", *QKEY, "change_rate", F.lit(None).cast("double").alias("interval_h"),
                                 F.lit(None).cast("string").alias("last_cheapest"), "last_scraped_at_utc", "next_scrape_at_utc")
    return merge.keyed_update(cur, st, QKEY, _OUTCOME_COLS)
