"""Streaming jobs: stream result equals the batch result, and a restarted job is a no-op."""

import datetime as dt
import os
import tempfile

from milesbase.operators import merge
from milesbase.streaming import jobs

T0 = dt.datetime(2026, 1, 1)


def _batch(spark):
    rows = []
    for k in range(12):
        for i in range(3):
            t = T0 + dt.timedelta(hours=i)
            rows.append((f"k{k}", (k + i) % 2, i, t, t + dt.timedelta(hours=2 if k % 3 else 30)))
    return spark.createDataFrame(rows, "k string, p int, ord int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")


def test_merge_stream_equals_batch_and_restart_is_noop(spark):
    base = tempfile.mkdtemp(prefix="stream-test-")
    b = _batch(spark)
    as_of = "2026-01-01 10:00:00"
    args = (["k"], ["p"], ["scraped_at_utc", "expires_at_utc"], ["ord"], as_of)
    landing, table, ckpt = (os.path.join(base, n) for n in ("landing", "table", "ckpt"))
    jobs.land(b, landing, ["k"], 3)
    t1 = jobs.merge_stream(spark, landing, b.schema, table, ckpt, *args)
    first = sorted(tuple(r) for r in t1.current().collect())
    expected = sorted(tuple(r) for r in merge.conditional_merge(None, b, *args).collect())
    assert first == expected
    commits = t1.last_commit()
    t2 = jobs.merge_stream(spark, landing, b.schema, table, ckpt, *args)  # restart: nothing new to do
    assert t2.last_commit() == commits
    assert sorted(tuple(r) for r in t2.current().collect()) == first


def test_partitioned_merge_touches_its_partitions_only(spark):
    base = tempfile.mkdtemp(prefix="stream-test-")
    rows = [(f"k{i % 9}", f"d{i % 9 // 3}" if i % 9 else None, i // 9 % 2, i, T0 + dt.timedelta(hours=i // 9), T0 + dt.timedelta(hours=i // 9 + 2)) for i in range(54)]
    schema = "k string, d string, p int, ord int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz"
    b = spark.createDataFrame(rows, schema)
    args = (["k", "d"], ["p"], ["scraped_at_utc", "expires_at_utc"], ["ord"], "2026-01-01 10:00:00")
    landing, table, ckpt = (os.path.join(base, n) for n in ("landing", "table", "ckpt"))
    want = sorted(str(tuple(r)) for r in merge.conditional_merge(None, b, *args).collect())
    sizes = []
    for part in ("d = 'd0'", "d = 'd1'", "d = 'd2' OR d IS NULL", "d = 'd1' AND ord > 1000"):
        if "1000" not in part:
            b.where(part).coalesce(1).write.mode("append").parquet(landing)
        t = jobs.merge_stream(spark, landing, b.schema, table, ckpt, *args, partition_by="d")
        sizes.append(t._log().where("path IS NOT NULL").groupBy("batch_id").count().orderBy("batch_id").collect())
    assert sorted(str(tuple(r)) for r in t.current().collect()) == want
    assert [r["count"] for r in sizes[-1]] == [1, 1, 2] and sizes[-1] == sizes[-2]
    # a second round over one date replaces that partition; the folder goes at the commit after
    b.where("d = 'd1'").withColumn("p", b["p"] + 5).withColumn("ord", b["ord"] + 100).coalesce(1).write.mode("append").parquet(landing)
    b.where("d = 'd2'").coalesce(1).write.mode("append").parquet(landing)
    t = jobs.merge_stream(spark, landing, b.schema, table, ckpt, *args, partition_by="d")
    assert {r.p for r in t.current().where("d = 'd1'").collect()} <= {5, 6}
    assert t.current().count() == len(want)
    assert not os.path.exists(os.path.join(table, "v000000001", "_part=d1"))


def test_versioned_table_never_rewrites_a_version(spark):
    root = tempfile.mkdtemp(prefix="vt-test-")
    vt = jobs.VersionedTable(spark, root)
    assert vt.current() is None
    vt.commit(0, spark.createDataFrame([(1,)], "x int"))
    vt.commit(1, spark.createDataFrame([(2,)], "x int"))
    assert vt.last_commit()[0] == 1
    assert [r.x for r in vt.current().collect()] == [2]
    assert sorted(os.listdir(root)) == ["_commits", "v000000000", "v000000001"]


def test_route_state_late_events_go_to_side_output(spark):
    import time
    base = tempfile.mkdtemp(prefix="route-state-")
    landing = os.path.join(base, "landing")
    cols = jobs.EVENT_SCHEMA

    def ev(h, blocked=False, eco=10000):
        return ("SEA", "JFK", "AS", T0 + dt.timedelta(hours=h), blocked, None if blocked else eco, None, None, None, 24, 72, 24)

    spark.createDataFrame([ev(0), ev(10, eco=9000)], cols).coalesce(1).write.mode("append").parquet(landing)
    time.sleep(1.1)
    spark.createDataFrame([ev(5, eco=1)], cols).coalesce(1).write.mode("append").parquet(landing)  # older than state
    out = os.path.join(base, "out")
    st = jobs.route_state_stream(spark, landing, out, os.path.join(base, "ckpt")).collect()
    assert len(st) == 1 and st[0].scrapes == 2 and st[0].changes == 2
    assert st[0].next_scrape_at_utc == T0 + dt.timedelta(hours=10 + 24)   # 24 -> changed -> 12 -> clamp 24
    late = jobs.late_events(spark, out).collect()
    assert [(r.origin, r.t) for r in late] == [("SEA", T0 + dt.timedelta(hours=5))]
