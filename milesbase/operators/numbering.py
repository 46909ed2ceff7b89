"""Exact ordered scans (row numbers, carried values) without a window over a whole group.

``row_number()`` or ``lag()`` put each group into one task, and a group without keys is the whole table. Here rows are range
partitioned on (group, order), so a group of any size spreads over as many tasks as it needs. Each row gets its place and the last
values inside its partition; what the earlier partitions of its group hold comes from a table of one row per group
and partition that it touches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milesbase.session import checkpoint_dir

_LOW = (1 << 33) - 1  # monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under a new name in the shared checkpoint folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _free(df: DataFrame, base: str) -> str:
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def scanned(df: DataFrame, group: list[str], order: list[str | Column], pos: str | None = None, total: str | None = None,
            last: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with, per row in the ``order`` of its ``group`` (nulls are a group): ``pos`` (0, 1, ...), ``total`` (rows of the group) and for each
    name of ``last`` the last value that isn't null among the rows before it (null if there is none). ``order`` should name each row
    of a group; rows that it leaves tied come in any order. ``df`` is read twice (range bounds are sampled), so hand over something
    stored or cheap."""
    last = last or {}
    pid, at, lo, n, off, inside = (_free(df, x) for x in ("_pid", "_at", "_lo", "_n", "_off", "_in"))
    held = {k: _free(df, f"_held_{k}") for k in last}
    names = [F.col(f"`{c}`") for c in group]
    keys = [*names, *[F.col(f"`{c}`") if isinstance(c, str) else c for c in order]]
    placed = df.select("*", *[v.alias(held[k]) for k, v in last.items()])
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias(pid), F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW)).alias(at))
    placed = stored(placed, "scanned")
    ends = placed.groupBy(pid, *names).agg(F.min(at).alias(lo), F.count(F.lit(1)).alias(n), *[
        F.max_by(h, F.when(F.col(h).isNotNull(), F.col(at))).alias(f"_end_{k}") for k, h in held.items()])
    # a group's window holds one row for each partition that the group touches
    w = Window.partitionBy(*names) if group else Window.partitionBy(F.lit(0))
    before = w.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select(F.col(pid).alias(f"_b_{pid}"), *[F.col(f"`{c}`").alias(f"_b_{c}") for c in group],
                       (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(lo)).alias(off), *([F.sum(n).over(w).alias(total)] if total else []),
                       *[F.last(f"_end_{k}", ignorenulls=True).over(before).alias(f"_from_{k}") for k in last])
    rows = placed
    if last:
        here = Window.partitionBy(pid, *names).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        rows = placed.select("*", *[F.last(h, ignorenulls=True).over(here).alias(f"{inside}_{k}") for k, h in held.items()])
    on = rows[pid] == base[f"_b_{pid}"]
    for c in group:
        on = on & rows[f"`{c}`"].eqNullSafe(base[f"`_b_{c}`"])
    made = rows.join(base, on)
    return made.select(*[rows[f"`{c}`"] for c in df.columns], *([(rows[at] + base[off]).alias(pos)] if pos else []), *([base[total]] if total else []),
                       *[F.coalesce(rows[f"{inside}_{k}"], base[f"_from_{k}"]).alias(k) for k in last])


def numbered(df: DataFrame, group: list[str], order: list[str | Column], out: str = "pos", total: str | None = None) -> DataFrame:
    """``df`` with ``out``: 0, 1, ... within each ``group`` by ``order``, and with ``total`` the group's rows (see ``scanned``)."""
    return scanned(df, group, order, out, total)
