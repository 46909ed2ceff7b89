"""Per-key history folds rebuilt from event logs.

Order-free folds use closed forms and plain aggregations:

* fold_demand: decay-then-add-one from zero is  sum_i 2^(-(as_of - t_i)/half_life);
* fold_change_rate: EWMA from a seed is  sum_i a(1-a)^(n-i) x_i + (1-a)^n seed.

Order-dependent folds never gather a key's history:

* The clamped interval and the mark-scraped state are products in a monoid. A step x -> min(H, max(L, a x + b)) is closed under
  composition, and so is the rate's x -> a x + b; a key's events, numbered in order, are reduced in blocks of ``BLOCK``
  neighbours, the blocks in blocks, until one state per key is left. A state can be stored and composed with the state of a
  later batch (``composed``).
* The replayed conditional merge is a chain of pointers: from an applied row the next applied one is the first later row with
  other material or with a time at or after its expiry. Both are found by ordered scans, and pointer doubling gives the end
  of each chain and its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collections.abc import Callable

from milesbase.functions import exprs as X
from milesbase.operators.numbering import numbered, scanned, stored
from milesbase.sources.dims import BLOCK_COOLDOWN_MIN, CHANGE_RATE_ALPHA, CHANGE_RATE_SEED, DEMAND_HALF_LIFE_DAYS

ROUTE = ["origin", "destination", "airline"]
CABIN_COLS = ["economy", "premium_economy", "business", "first"]


def demand_from_log(searches: DataFrame, key, as_of, half_life=DEMAND_HALF_LIFE_DAYS) -> DataFrame:
    """fold_demand + fold_search_count: demand at as_of and count per key, one aggregation."""
    days = X.seconds_between("ts", F.lit(as_of).cast("timestamp_ntz")) / 86400.0
    w = F.pow(F.lit(2.0), -F.greatest(days, F.lit(0.0)) / F.lit(half_life))
    return searches.groupBy(*key).agg(F.sum(w).alias("demand"), F.count(F.lit(1)).alias("searches"),
                                      F.max("ts").alias("last_search_at_utc"))


def changed_flags(scrapes: DataFrame, key=ROUTE, t="scraped_at_utc") -> DataFrame:
    """fold_changed_flag: the cheapest-by-cabin map differs from the previous scrape (or none)."""
    w = Window.partitionBy(*key).orderBy(t)
    prev = [F.lag(c).over(w).alias(f"_p_{c}") for c in CABIN_COLS]
    s = scrapes.select("*", *prev, F.lag(F.lit(1)).over(w).alias("_has_prev"))
    diff = X.any_of([~F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in CABIN_COLS])
    return s.withColumn("changed", F.col("_has_prev").isNull() | diff) \
            .drop(*[f"_p_{c}" for c in CABIN_COLS], "_has_prev")


def change_rate(flags: DataFrame, key=ROUTE, t="scraped_at_utc", alpha=CHANGE_RATE_ALPHA,
                seed=CHANGE_RATE_SEED) -> DataFrame:
    """fold_change_rate (closed form of the EWMA fold)."""
    w = Window.partitionBy(*key).orderBy(t)
    wall = Window.partitionBy(*key)
    f = flags.withColumn("_i", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(wall))
    x = F.col("changed").cast("double")
    term = F.lit(alpha) * F.pow(F.lit(1.0 - alpha), (F.col("_n") - F.col("_i")).cast("double")) * x
    return f.groupBy(*key).agg(
        (F.sum(term) + F.pow(F.lit(1.0 - alpha), F.first("_n").cast("double")) * F.lit(seed)).alias("change_rate"),
        F.count(F.lit(1)).alias("scrapes"))


BLOCK = 256
HISTORY = 16_384  # observations of one key that are folded in one list


def reduced(rows: DataFrame, key, state: str, compose: Callable[[Column, Column], Column], block: int = BLOCK) -> DataFrame:
    """key, ``state``: the elements (key, ``_pos``, ``_total``, state) of each key composed in order. Each round composes runs of ``block``
    neighbours, so that a key with any number of elements spreads over many tasks and no list is longer than a run."""
    done = None
    while True:
        runs = rows.groupBy(*key, X.idiv(F.col("_pos"), F.lit(block)).alias("_pos"), F.ceil(F.col("_total") / block).alias("_total")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("p"), F.col(state).alias("s")))).alias("_run"))
        first = F.element_at("_run", 1)["s"]
        tail = F.slice("_run", 2, F.greatest(F.size("_run") - 1, F.lit(0)))
        runs = stored(runs.select(*key, "_pos", "_total", F.aggregate(tail, first, lambda acc, x: compose(acc, x["s"])).alias(state)), "fold-runs")
        ready = runs.where("_total = 1").select(*key, state)
        done = ready if done is None else done.unionByName(ready)
        rows = runs.where("_total > 1")
        if rows.isEmpty():
            return done


def composed(old: DataFrame, new: DataFrame, key, state: str, compose: Callable[[Column, Column], Column]) -> DataFrame:
    """Stored states of earlier batches followed by those of a later one, key by key."""
    both = old.select(*key, F.col(state).alias("_a")).join(new.select(*key, F.col(state).alias("_b")), list(key), "full")
    return both.select(*key, F.when(F.col("_a").isNull(), F.col("_b")).when(F.col("_b").isNull(), F.col("_a")).otherwise(compose(F.col("_a"), F.col("_b"))).alias(state))


def _clamp(x: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo, F.least(hi, x))


def interval_step(changed: Column, lo: Column, hi: Column, step: Column) -> Column:
    """One scrape as x -> min(hi, max(lo, a x + b))."""
    d = lambda c: c.cast("double")
    return F.struct(d(lo).alias("lo"), d(hi).alias("hi"), F.when(changed, F.lit(0.5)).otherwise(F.lit(1.0)).alias("a"),
                    F.when(changed, F.lit(0.0)).otherwise(d(step)).alias("b"), F.lit(1).cast("bigint").alias("n"))


def interval_then(f: Column, g: Column) -> Column:
    """First f, then g."""
    through = lambda x: _clamp(g["a"] * x + g["b"], g["lo"], g["hi"])
    return F.struct(through(f["lo"]).alias("lo"), through(f["hi"]).alias("hi"), (f["a"] * g["a"]).alias("a"), (g["a"] * f["b"] + g["b"]).alias("b"),
                    (f["n"] + g["n"]).alias("n"))


def interval_after(state: Column, start: Column) -> Column:
    return _clamp(state["a"] * start + state["b"], state["lo"], state["hi"])


def interval_states(flags: DataFrame, bounds: DataFrame, key=ROUTE, t="scraped_at_utc", block: int = BLOCK) -> DataFrame:
    """key, state: all scrapes of a key as one step."""
    rows = numbered(stored(flags.select(*key, t, "changed"), "fold-flags"), list(key), [t, "changed"], "_pos", "_total")
    rows = rows.join(bounds.select(*key, "lo", "hi", "step"), list(key))
    steps = rows.select(*key, "_pos", "_total", interval_step(F.col("changed"), F.col("lo"), F.col("hi"), F.col("step")).alias("state"))
    return reduced(steps, key, "state", interval_then, block)


def interval_fold(flags: DataFrame, bounds: DataFrame, key=ROUTE, t="scraped_at_utc", block: int = BLOCK) -> DataFrame:
    """fold_interval: changed -> x0.5, unchanged -> +step, clamped to [lo, hi] after every step.
    ``bounds`` carries lo / hi / step / start per key."""
    states = interval_states(flags, bounds, key, t, block).join(bounds.select(*key, "start"), list(key))
    return states.select(*key, interval_after(F.col("state"), F.col("start")).alias("interval_h"), F.col("state.n").alias("scrapes"))


_CHEAP_T = "struct<economy:int,premium_economy:int,business:int,first:int>"


def mark_step(t: Column, blocked: Column, changed: Column, lo: Column, hi: Column, step: Column, alpha: float) -> Column:
    """One event as a state: a scrape moves rate and interval, a block neither; the later event decides the next time."""
    scraped = interval_step(changed, lo, hi, step)
    still = F.struct(F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0).cast("bigint").alias("n"))
    return F.struct(F.when(blocked, still).otherwise(scraped).alias("iv"),
                    F.when(blocked, F.lit(1.0)).otherwise(F.lit(1.0 - alpha)).alias("ra"),
                    F.when(blocked, F.lit(0.0)).otherwise(F.lit(alpha) * changed.cast("double")).alias("rb"),
                    F.when(blocked, F.lit(0)).otherwise(changed.cast("int")).alias("changes"), t.alias("last_t"), blocked.alias("last_blocked"))


def mark_then(f: Column, g: Column) -> Column:
    return F.struct(interval_then(f["iv"], g["iv"]).alias("iv"), (f["ra"] * g["ra"]).alias("ra"), (g["ra"] * f["rb"] + g["rb"]).alias("rb"),
                    (f["changes"] + g["changes"]).alias("changes"), g["last_t"].alias("last_t"), g["last_blocked"].alias("last_blocked"))


def mark_scraped_states(events: DataFrame, bounds: DataFrame, key=ROUTE, alpha=CHANGE_RATE_ALPHA, block: int = BLOCK) -> DataFrame:
    """key, state of all events of a key. The cheapest map of the scrape before comes from an ordered scan."""
    rows = scanned(stored(events, "mark-events"), list(key), ["t", "blocked"], "_pos", "_total", {"_prev": F.when(~F.col("blocked"), F.col("cheap"))})
    changed = F.coalesce(~F.col("_prev").eqNullSafe(F.col("cheap")), F.lit(True)) | F.col("_prev").isNull()
    rows = rows.join(bounds.select(*key, "lo", "hi", "step"), list(key))
    state = mark_step(F.col("t"), F.col("blocked"), changed, F.col("lo"), F.col("hi"), F.col("step"), alpha)
    return reduced(rows.select(*key, "_pos", "_total", state.alias("state")), key, "state", mark_then, block)


def mark_scraped_fold(events: DataFrame, bounds: DataFrame, key=ROUTE, alpha=CHANGE_RATE_ALPHA,
                      seed=CHANGE_RATE_SEED, cooldown_min=BLOCK_COOLDOWN_MIN, block: int = BLOCK) -> DataFrame:
    """fold_mark_scraped: a route's scrape / block events as one state.
    A scrape updates changed flag, EWMA rate, AIMD interval and next = t + interval;
    a block only pushes next to t + cooldown."""
    s = mark_scraped_states(events, bounds, key, alpha, block).join(bounds.select(*key, "start"), list(key))
    iv = F.when(F.col("state.iv.n") > 0, interval_after(F.col("state.iv"), F.col("start"))).otherwise(F.col("start").cast("double"))
    pause = F.when(F.col("state.last_blocked"), F.make_dt_interval(F.lit(0), F.lit(0), F.lit(cooldown_min))).otherwise(
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (iv * 3600).cast("decimal(18,6)")))
    return s.select(*key, (F.col("state.ra") * F.lit(float(seed)) + F.col("state.rb")).alias("rate"), iv.alias("interval_h"),
                    (F.col("state.last_t") + pause).alias("next_scrape_at_utc"), F.col("state.changes").alias("changes"), F.col("state.iv.n").cast("int").alias("scrapes"))


def merge_replay(log: DataFrame, key, material, t="scraped_at_utc", expiry="expires_at_utc",
                 order=(), block: int = HISTORY) -> DataFrame:
    """fold_merge_replay: each observation applied at its own time; it replaces the stored
    row when a material column differs or the stored row has expired by then.

    An exact repeat (same time, material and expiry) is never applied after its twin, so
    repeats are collapsed first; the groupBy pre-aggregates map-side, hot duplicates included. Keys of at most ``block``
    rows (some megabytes) are folded in one list each; longer histories are never gathered (``_replayed_by_pointers``, which
    shuffles its rows once for each doubling)."""
    key = list(key)
    cols = list(dict.fromkeys([*key, t, *order, expiry, *material]))
    log = stored(log.groupBy(*cols).agg(F.count(F.lit(1)).alias("_dups")).drop("_dups"), "replay-log")
    long = log.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block).select(*key)
    if long.isEmpty():
        return _replayed_in_lists(log, key, material, t, expiry, order)
    long = stored(long, "replay-long")
    same = F.lit(True)
    for c in key:
        same = same & log[c].eqNullSafe(long[c])
    return (_replayed_in_lists(log.join(long, same, "left_anti"), key, material, t, expiry, order)
            .unionByName(_replayed_by_pointers(stored(log.join(long, same, "left_semi"), "replay-hot"), key, material, t, expiry, order)))


def _replayed_in_lists(log: DataFrame, key, material, t, expiry, order) -> DataFrame:
    # by time, order and expiry, then material; each column is in the list once
    names = {c: f"v{i}" for i, c in enumerate(dict.fromkeys([t, *order, expiry, *material]))}
    item = F.struct(*[F.col(c).alias(v) for c, v in names.items()])
    h = log.groupBy(*key).agg(F.array_sort(F.collect_list(item)).alias("h"))

    def state(x, writes):
        return F.struct(F.struct(*[x[names[c]].alias(c) for c in material]).alias("m"), x[names[t]].alias("t"), x[names[expiry]].alias("e"), writes.alias("writes"))

    init = state(F.element_at("h", 1), F.lit(1))

    def step(acc, x):
        changed = X.any_of([~acc["m"][c].eqNullSafe(x[names[c]]) for c in material])
        return F.when(changed | (acc["e"] <= x[names[t]]), state(x, acc["writes"] + 1)).otherwise(acc)

    rest = F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0)))
    s = h.select(*key, F.aggregate(rest, init, step).alias("s"))
    return s.select(*key, "s.m.*", F.col("s.t").alias(t), F.col("s.e").alias(expiry), "s.writes")


def _replayed_by_pointers(log: DataFrame, key, material, t, expiry, order) -> DataFrame:
    """Histories of any length. All rows get one number in the order of (key, time); pointers are numbers."""
    cols = log.columns
    sort = [*key, *dict.fromkeys([t, *order, expiry, *material])]
    m, k = F.struct(*material), F.struct(*key)
    rows = scanned(log.select(*cols), [], sort, "_i", last={"_before": F.struct(k.alias("k"), m.alias("m"))})
    first = F.col("_before").isNull() | ~F.col("_before.k").eqNullSafe(k)
    rows = stored(rows.select(*cols, "_i", first.alias("_first"), (first | ~F.col("_before.m").eqNullSafe(m)).alias("_new")), "replay-rows")

    # from the last row backwards: an expiry meets the next row at or after it, a row the next change of material
    events = rows.select(*key, F.col(t).alias("_at"), F.lit(1).alias("_kind"), "_i", F.when(F.col("_new"), F.col("_i")).alias("_change"))
    expiries = rows.select(*key, F.col(expiry).alias("_at"), F.lit(0).alias("_kind"), "_i", F.lit(None).cast("bigint").alias("_change"))
    met = scanned(stored(events.unionByName(expiries), "replay-times"), key, [F.col("_at").desc(), F.col("_kind").desc(), F.col("_i").desc()],
                  last={"_row": F.when(F.col("_kind") == 1, F.col("_i")), "_next_change": F.col("_change")})
    event = F.col("_kind") == 1
    nxt = met.groupBy("_i").agg(F.max(F.when(event, F.col("_next_change"))).alias("_c"), F.max(F.when(event, F.col("_row"))).alias("_after"),
                                F.max(F.when(~event, F.col("_row"))).alias("_e"))
    # a row that expires by its own time gives way to any later one; a pointer to itself ends a chain
    expired = F.when(F.col("_e") <= F.col("_i"), F.col("_after")).otherwise(F.col("_e"))
    point = nxt.select("_i", F.coalesce(F.least("_c", expired), F.col("_i")).alias("_to"))
    point = stored(point.withColumn("_steps", (F.col("_to") != F.col("_i")).cast("bigint")), "replay-pointers")
    while True:
        on = point.select(F.col("_i").alias("_to"), F.col("_to").alias("_then"), F.col("_steps").alias("_more"))
        point = stored(point.join(on, "_to").select("_i", F.col("_then").alias("_to"), (F.col("_steps") + F.col("_more")).alias("_steps"), (F.col("_then") != F.col("_to")).alias("_moved")),
                       "replay-pointers")
        moved = not point.where("_moved").isEmpty()
        point = point.drop("_moved")
        if not moved:
            break
    starts = rows.where("_first").select("_i").join(point, "_i").select(F.col("_to").alias("_i"), (F.col("_steps") + 1).cast("int").alias("writes"))
    return rows.join(starts, "_i").select(*key, *material, t, expiry, "writes")
