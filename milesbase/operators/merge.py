"""Keyed merge helpers for plain parquet tables (snk_* family, win_last_wins).

The reference applies a batch row by row with
``INSERT ... ON CONFLICT DO UPDATE ... WHERE changed OR expired``. Its net effect
per key is closed-form, so it is computed with aggregations instead of a fold:

* final material columns = the last row's (in arrival order);
* the *final run* is every observation after the last one whose material
  differs from the final material (the stored row counts as the first
  observation);
* inside the final run the stored stamps stop moving at the first row that is
  not yet expired at ``as_of``; if every row of the run is expired, the last
  one wins.

Stored rows and batch are put in one sequence and written once. Where keys have many rows, three passes of hash
aggregations over plain columns leave the few rows of each key that can decide its result (``deciding_rows``), so
that the history is neither shuffled nor sorted. Keys of at most ``HOT_KEY`` rows then take one
partition-by-key, newest-first sorted pass of window functions, hotter keys a form of partial aggregations and
equi-joins that never holds a key's rows in one task (no ``collect_list`` of a history, no fold in either). The
one-row-per-key pickers (first / last wins) are ``min_by`` / ``max_by`` aggregations with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milesbase.functions.exprs import any_of
from milesbase.operators.numbering import stored


def latest_per_key(df: DataFrame, key, order_cols, value_cols=None) -> DataFrame:
    """win_last_wins (plain form): the row with the greatest ordinal per key."""
    value_cols = value_cols or [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_v"))
    return picked.select(*key, "_v.*")


def first_per_key(df: DataFrame, key, order_cols, value_cols=None) -> DataFrame:
    """win_first_wins: the row with the smallest ordinal per key."""
    value_cols = value_cols or [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.min_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_v"))
    return picked.select(*key, "_v.*")


STRATEGY_CONF = "milesbase.merge.strategy"
HOT_KEY = 100_000
CROWDED = 32  # rows per key, on average, from which the deciding rows are picked before the sort


def conditional_merge(current: DataFrame | None, batch: DataFrame, key, material, stamps,
                      order_cols, as_of, expiry_col="expires_at_utc", keep_cols=(), strategy=None, hot_key=HOT_KEY,
                      crowded=CROWDED) -> DataFrame:
    """Net effect of sequential ``ON CONFLICT ... WHERE changed OR expired`` upserts.

    ``order_cols`` give the arrival order inside the batch; stored rows precede
    the batch. ``keep_cols`` are set at insert time and never updated.
    Returns one row per key with key + material + stamps + keep_cols.

    ``auto`` (default) writes the sequence of stored and new rows once, counts its keys, keeps only the deciding rows if there are
    ``crowded`` rows a key or more, and sends keys of more than ``hot_key`` rows through ``aggregate`` and all others
    through ``window``; the two give identical results and can be chosen for all keys with the argument or the session conf
    ``milesbase.merge.strategy``.
    """
    strategy = strategy or batch.sparkSession.conf.get(STRATEGY_CONF, "auto")
    key, material, stamps, keep_cols = list(key), list(material), list(stamps), list(keep_cols)
    seq = _sequence(current, batch, key + material + stamps + keep_cols, list(order_cols))
    args = (key, material, stamps, as_of, expiry_col, keep_cols)
    if strategy != "auto":
        return (_merge_by_aggregation if strategy == "aggregate" else _merge_by_window)(seq, *args)
    seq = stored(seq, "merge-sequence")
    ends = stored(_ends(seq, key), "merge-ends")
    size = ends.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys")).first()
    if size["keys"] and size["rows"] >= crowded * size["keys"]:
        seq = stored(deciding_rows(seq, ends, key, material, as_of, expiry_col, keep_cols), "merge-deciding")
        ends = _ends(seq, key)
    hot = ends.filter(F.col("_n") > hot_key).select(*key)
    if hot.isEmpty():
        return _merge_by_window(seq, *args)
    hot = stored(hot, "merge-hot-keys")  # at most one key for each hot_key rows
    same = _null_safe(seq, hot, key)
    return _merge_by_window(seq.join(hot, same, "left_anti"), *args).unionByName(_merge_by_aggregation(seq.join(hot, same, "left_semi"), *args))


def _null_safe(a: DataFrame, b: DataFrame, key):
    on = F.lit(True)
    for c in key:
        on = on & a[c].eqNullSafe(b[c])
    return on


def _ends(seq: DataFrame, key) -> DataFrame:
    """key, rows, latest and earliest arrival time (the first order column; null comes first) and whether one is null."""
    at = F.col("_ord.o0")
    return seq.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.max(at).alias("_last_at"), F.min(at).alias("_first_at"),
                                 F.max(at.isNull()).alias("_null_at"))


def deciding_rows(seq: DataFrame, ends: DataFrame, key, material, as_of, expiry_col, keep_cols=()) -> DataFrame:
    """The rows of ``seq`` that can decide a key's result, with all rows that share their arrival times: the last one, the newest whose
    material differs from it, the first unexpired one after that and, for ``keep_cols``, the first one.

    ``seq`` is read three times in its own partitioning and joined to tables of one row per key, which Spark broadcasts while they
    are small; every aggregation over it has plain numbers for its buffers and is combined before the exchange."""
    def marked(marks, cols):
        m = marks.select(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate(key)], *cols)
        on = F.lit(True)
        for i, c in enumerate(key):
            on = on & seq[c].eqNullSafe(m[f"_k_{i}"])
        return seq.join(m, on)

    at, own = F.col("_ord.o0"), [f"_k_{i}" for i in range(len(key))]
    back = [F.col(k).alias(c) for k, c in zip(own, key)]
    newest = marked(ends, ["_last_at"]).filter(at.eqNullSafe(F.col("_last_at"))).groupBy(*own).agg(
        F.max_by(F.struct(*material), F.col("_ord")).alias("_m")).select(*back, "_m")
    newest = stored(newest, "merge-newest")
    differs = any_of([~F.col(c).eqNullSafe(F.col(f"_m.{c}")) for c in material])
    change = marked(newest, ["_m"]).groupBy(*own).agg(F.max(F.when(differs, at)).alias("_change_at"), F.max(differs).alias("_changed"))
    change = stored(change.select(*back, "_change_at", "_changed"), "merge-change")
    # after the newest change: a null time is the earliest of all
    later = F.when(~F.col("_changed"), True).when(F.col("_change_at").isNull(), at.isNotNull()).otherwise(F.coalesce(at > F.col("_change_at"), F.lit(False)))
    fresh = marked(change, ["_change_at", "_changed"]).filter(later & (F.col(expiry_col) > F.lit(as_of).cast("timestamp_ntz"))).groupBy(*own).agg(
        F.min(at).alias("_fresh_at"), F.max(at.isNull()).alias("_fresh_null")).select(*back, "_fresh_at", "_fresh_null")
    c, f, e = change.alias("c"), fresh.alias("f"), ends.alias("e")
    same = lambda a, b: _null_safe_on([F.col(f"{a}.{k}") for k in key], [F.col(f"{b}.{k}") for k in key])
    marks = e.join(c, same("e", "c")).join(f, same("e", "f"), "left").select(
        *[F.col(f"e.{k}") for k in key], "_last_at", "_first_at", "_null_at", "_change_at", "_changed", "_fresh_at", "_fresh_null")
    marks = stored(marks, "merge-marks")
    first_of = lambda null, t: F.when(F.col(null), at.isNull()).otherwise(F.coalesce(at == F.col(t), F.lit(False)))
    keep = at.eqNullSafe(F.col("_last_at")) | (F.col("_changed") & at.eqNullSafe(F.col("_change_at"))) | first_of("_fresh_null", "_fresh_at")
    if keep_cols:
        keep = keep | first_of("_null_at", "_first_at")
    return marked(marks, ["_last_at", "_first_at", "_null_at", "_change_at", "_changed", "_fresh_at", "_fresh_null"]).filter(keep).select(*seq.columns)


def _null_safe_on(left, right):
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & a.eqNullSafe(b)
    return on


def _sequence(current, batch, cols, order_cols) -> DataFrame:
    """Stored rows, then the batch's, with ``_ord``: the place of each in the order of arrival."""
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]
    seq = batch.select(*cols, F.struct(F.lit(1).alias("src"), *order).alias("_ord"))
    if current is None:
        return seq
    none = [F.lit(None).cast(batch.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(order_cols)]
    return current.select(*cols, F.struct(F.lit(0).alias("src"), *none).alias("_ord")).unionByName(seq)


def _merge_by_window(seq, key, material, stamps, as_of, expiry_col, keep_cols) -> DataFrame:
    """One shuffle and one sort: every window below shares the partitioning by key
    and the newest-first arrival order, so Spark evaluates them in a single
    sorted pass and keeps row 1 of each key (no struct aggregation buffers,
    which would force sort-based aggregation and extra sorts).
    """
    cols = key + material + stamps + keep_cols
    w = Window.partitionBy(*key).orderBy(F.col("_ord").desc())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = seq.select("*", F.row_number().over(w).alias("_rn"),
                   *[F.first(c).over(upto).alias(f"_m_{c}") for c in material])
    differs = any_of([~F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in material])
    # rows newer than the newest differing observation form the final run
    s = s.withColumn("_in_run", F.max(differs.cast("int")).over(upto) == 0)
    fresh = F.col(expiry_col) > F.lit(as_of).cast("timestamp_ntz")
    st = F.struct(*stamps)
    s = s.select("*",
                 F.last(F.when(F.col("_in_run") & fresh, st), ignorenulls=True).over(whole).alias("_first_fresh"),
                 F.first(st).over(upto).alias("_last"),
                 *([F.last(F.struct(*keep_cols)).over(whole).alias("_k")] if keep_cols else []))
    out = s.filter(F.col("_rn") == 1).select(
        *key, *[F.col(f"_m_{c}").alias(c) for c in material], F.coalesce("_first_fresh", "_last").alias("_s"),
        *(["_k"] if keep_cols else []))
    return out.select(*key, *material, "_s.*", *(["_k.*"] if keep_cols else [])).select(*cols)


def _merge_by_aggregation(seq, key, material, stamps, as_of, expiry_col, keep_cols) -> DataFrame:
    """Skew-tolerant form: (1) final material per key, (2) the newest observation whose material
    differs, (3) first unexpired else last stamps inside the final run - three partial-aggregating
    groupBy(key) steps joined back on the key."""
    cols = key + material + stamps + keep_cols
    final = seq.groupBy(*key).agg(
        F.max_by(F.struct(*material), F.col("_ord")).alias("_m"),
        F.min_by(F.struct(*keep_cols), F.col("_ord")).alias("_k") if keep_cols else F.lit(None).alias("_k"))
    s = seq.join(final, key)
    differs = any_of([~F.col(c).eqNullSafe(F.col(f"_m.{c}")) for c in material])
    tstar = s.groupBy(*key).agg(F.max(F.when(differs, F.col("_ord"))).alias("_t"))
    run = s.join(tstar, key).filter(F.col("_t").isNull() | (F.col("_ord") > F.col("_t")))
    fresh = F.col(expiry_col) > F.lit(as_of).cast("timestamp_ntz")
    st = F.struct(*stamps)
    res = run.groupBy(*key).agg(
        F.first("_m").alias("_m"), F.first("_k").alias("_k"),
        F.min_by(F.when(fresh, st), F.when(fresh, F.col("_ord"))).alias("_first_fresh"),
        F.max_by(st, F.col("_ord")).alias("_last"))
    out = res.select(*key, "_m.*", F.coalesce("_first_fresh", "_last").alias("_s"), *([F.col("_k")] if keep_cols else []))
    return out.select(*key, *material, "_s.*", *(["_k.*"] if keep_cols else [])).select(*cols)


def insert_absent(new: DataFrame, current: DataFrame, key) -> DataFrame:
    """snk_insert_absent: add keys not present yet, never modify existing rows."""
    add = new.dropDuplicates(list(key)).join(current.select(*key), list(key), "left_anti")
    return current.unionByName(add.select(*current.columns))


def keyed_update(current: DataFrame, updates: DataFrame, key, set_cols) -> DataFrame:
    """snk_keyed_update: overwrite ``set_cols`` for matching keys; unknown keys are ignored.

    ``updates`` must be unique on key; a left join keeps every current row exactly once.
    """
    u = updates.select(*key, *[F.col(c).alias(f"_u_{c}") for c in set_cols],
                       F.lit(True).alias("_hit"))
    j = current.join(u, list(key), "left")
    return j.select(*[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
                      if c in set_cols else F.col(c) for c in current.columns])


def unconditional_merge(current: DataFrame, batch: DataFrame, key, order_cols) -> DataFrame:
    """snk_dim_merge: last batch row per key replaces the stored row; others kept."""
    last = latest_per_key(batch, key, order_cols, [c for c in current.columns if c not in key])
    keep = current.join(last.select(*key), list(key), "left_anti").select(*current.columns)
    return keep.unionByName(last.select(*current.columns))


def snapshot_replace(current: DataFrame, batch: DataFrame, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """snk_snapshot_replace: the table after deleting every row and inserting the batch, and (deleted, inserted) as one row. A dry run
    leaves the table as it is and reports (0, 0)."""
    if dry_run:
        zero = F.lit(0).cast("bigint")
        return current, current.sparkSession.range(1).select(zero.alias("deleted"), zero.alias("inserted"))
    old, new = current.agg(F.count(F.lit(1)).alias("deleted")), batch.agg(F.count(F.lit(1)).alias("inserted"))
    counts = old.withColumn("_k", F.lit(1)).join(new.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    return batch.select(*current.columns), counts


def scoped_replace(current: DataFrame, batch: DataFrame, scope_cols) -> DataFrame:
    """snk_scoped_replace: drop stored rows whose scope value appears in the batch, add the batch."""
    scope = batch.select(*scope_cols).distinct()
    kept = current.join(scope, list(scope_cols), "left_anti").select(*current.columns)
    return kept.unionByName(batch.select(*current.columns))



def write_touched_partitions(merged: DataFrame, batch: DataFrame, path: str, partition_col: str = "date") -> None:
    """Sink for the keyed tables: rewrite only the partitions the batch touched (dynamic partition
    overwrite); files of untouched dates stay as they are. ``merged`` must not read from ``path`` itself."""
    touched = batch.select(partition_col).distinct()
    out = merged.join(touched, partition_col, "left_semi")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
