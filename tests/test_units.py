"""Unit cases on tiny hand-made frames (behaviour carried over from the reference's tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from milesbase.operators import cash_queue as CQ
from milesbase.operators import folds, matching, merge, queue as Q, reports, spine, text_parse, transfers as T
from milesbase.operators.html_tables import bank_table_rows

NOW = "2026-06-18 12:00:00"


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


# ------------------------------------------------------------------ scoring
def test_decay_demand(spark):
    df = spark.createDataFrame([(5.0, None), (8.0, "2026-06-04 12:00:00"), (8.0, "2026-06-19 12:00:00")],
                               "s double, last string").withColumn("last", F.col("last").cast("timestamp_ntz"))
    got = [r.v for r in df.select(Q.decay_demand("s", "last", NOW).alias("v")).collect()]
    assert got == [5.0, 4.0, 8.0]


def test_overdue_and_score(spark):
    df = spark.createDataFrame([("2026-06-18 12:00:00", 24.0), ("2026-06-17 12:00:00", 24.0), ("2026-06-18 12:00:00", 0.0)],
                               "nxt string, iv double").withColumn("nxt", F.col("nxt").cast("timestamp_ntz"))
    got = [r.v for r in df.select(Q.overdue_ratio("nxt", "iv", NOW).alias("v")).collect()]
    assert got == [0.0, 1.0, 1.0]
    assert one(spark, Q.route_score(F.lit(20.0), F.lit(5.0), F.lit(2.0))) == 1.0
    assert one(spark, Q.route_score(F.lit(50.0), F.lit(-1.0), F.lit(0.0))) == 0.5


def test_interval_fold_aimd(spark):
    flags = spark.createDataFrame([("A", "B", "AS", 1, True), ("A", "B", "AS", 2, False), ("A", "B", "AS", 3, False)],
                                  "origin string, destination string, airline string, scraped_at_utc int, changed boolean")
    bounds = spark.createDataFrame([("A", "B", "AS", 8, 24, 8, 24.0)],
                                   "origin string, destination string, airline string, lo int, hi int, step int, start double")
    got = folds.interval_fold(flags, bounds).first()
    assert got.interval_h == 24.0 and got.scrapes == 3  # 24 -> 12 -> 20 -> 28 clamped to 24


def test_change_rate_closed_form_equals_fold(spark):
    seq = [True, False, False, True, True]
    rows = [("A", "B", "AS", i, c) for i, c in enumerate(seq)]
    flags = spark.createDataFrame(rows, "origin string, destination string, airline string, scraped_at_utc int, changed boolean")
    got = folds.change_rate(flags).first().change_rate
    rate = 0.5
    for c in seq:
        rate = 0.3 * (1.0 if c else 0.0) + 0.7 * rate
    assert abs(got - rate) < 1e-12


def test_changed_flag_cabin_appears(spark):
    s = spark.createDataFrame([("A", "B", "AS", 1, 12000, None, None, None), ("A", "B", "AS", 2, 12000, None, None, None),
                               ("A", "B", "AS", 3, 12000, None, 50000, None)],
                              "origin string, destination string, airline string, scraped_at_utc int, economy int, "
                              "premium_economy int, business int, first int")
    got = [r.changed for r in folds.changed_flags(s).orderBy("scraped_at_utc").collect()]
    assert got == [True, False, True]


def test_promotion_steps(spark):
    df = spark.createDataFrame([("LOW", 0, 2, "DL"), ("LOW", 0, 3, "DL"), ("LOW", 0, 10, "DL"), ("LOW", 0, 10, "AS"),
                                ("MED", 9, 1, "DL"), ("LOW", 9, 1, "DL"), ("LOW", 9, 2, "DL")],
                               "t string, c int, n int, airline string")
    got = [r.v for r in df.select(Q.promoted_tier("t", "c", "n", "airline").alias("v")).collect()]
    assert got == ["LOW", "MED", "HIGH", "MED", "HIGH", "MED", "HIGH"]


# ------------------------------------------------------------------ matching
def _cands(spark, rows):
    return spark.createDataFrame(rows, "origin string, destination string, date date, cabin_class string, airline string, "
                                       "flight_number string, award_min int")


def _fares(spark, rows):
    from decimal import Decimal
    rows = [r[:7] + (Decimal(r[7]),) + r[8:] for r in rows]
    return spark.createDataFrame(rows, "fare_id long, origin string, destination string, date date, cabin_class string, "
                                       "carrier string, dep_min int, price decimal(10,2), nonstop boolean")


def test_nearest_fare_tie_takes_lowest_flight_number(spark):
    d = dt.date(2026, 7, 1)
    c = _cands(spark, [("SEA", "JFK", d, "economy", "AS", "AS 20", 600), ("SEA", "JFK", d, "economy", "AS", "AS 10", 620)])
    f = _fares(spark, [(1, "SEA", "JFK", d, "economy", "Alaska", 610, 199, True)])
    got = matching.nearest_fares(f, c).first()
    assert got.flight_number == "AS 10"


def test_nearest_fare_tolerance_and_unmapped(spark):
    d = dt.date(2026, 7, 1)
    c = _cands(spark, [("SEA", "JFK", d, "economy", "AS", "AS 1", 600)])
    f = _fares(spark, [(1, "SEA", "JFK", d, "economy", "Alaska", 611, 100, True),
                       (2, "SEA", "JFK", d, "economy", "Spirit", 600, 100, True),
                       (3, "SEA", "JFK", d, "economy", "Alaska", 600, 100, False),
                       (4, "SEA", "JFK", d, "economy", "Alaska", 590, 120, True)])
    got = [r.fare_id for r in matching.nearest_fares(f, c).collect()]
    assert got == [4]


def test_cheapest_per_flight_first_fare_wins_and_anchor(spark):
    d = dt.date(2026, 7, 1)
    c = _cands(spark, [("SEA", "JFK", d, "economy", "AS", "AA 2957", 600)])
    f = _fares(spark, [(1, "SEA", "JFK", d, "economy", "Alaska", 600, 150, True),
                       (2, "SEA", "JFK", d, "economy", "Alaska", 601, 150, True),
                       (3, "SEA", "JFK", d, "economy", "Delta", 900, 90, False)])
    per = matching.cheapest_per_flight(matching.nearest_fares(f, c)).collect()
    assert len(per) == 1 and per[0].airline == "AS" and float(per[0].cash_price) == 150.0  # codeshare keeps award airline
    od = matching.od_anchor(f).first()
    assert od.airline == "__OD__" and float(od.cash_price) == 90.0


# ------------------------------------------------------------------ transfers and text
def test_parse_ratio_accept_reject(spark):
    ok = {"1:1": 1.0, "2:1.5": 1.33, "5:4": 1.25, "1,000:800": 1.25, "1:1.6": 0.63}
    bad = ["1:0", "0:1", "-1:1", "abc", "1", "100:1"]
    df = spark.createDataFrame([(k,) for k in list(ok) + bad], "r string")
    got = {r.r: r.v for r in df.select("r", T.parse_ratio("r").alias("v")).collect()}
    assert {k: got[k] for k in ok} == ok
    assert all(got[k] is None for k in bad)


def test_match_airline_keywords(spark):
    cases = {"Alaska Airlines Mileage Plan": "AS", "United MileagePlus": "UA", "ANA Mileage Club": "NH",
             "Avianca LifeMiles": "AV", "Virgin Atlantic Flying Club": "VS", "Air France/KLM Flying Blue": "AF",
             "British Airways Avios": "BA", "Singapore": "SQ", "Virgin Red": None, "Emirates Skywards": None,
             "Qantas Frequent Flyer": None, "Japan Airlines Mileage Bank": None}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r.p: (r.m.airline_code if r.m else None) for r in df.select("p", T.match_airline("p").alias("m")).collect()}
    assert got == cases


def test_fare_label_parsing(spark):
    labels = spark.createDataFrame([
        (1, "From 1,234 US dollars. Nonstop flight with Turkish Airlines. Leaves JFK at 1:05 PM on Monday."),
        (2, "From 99 US dollars. 1 stop flight with Delta. Leaves SEA at 12:30 AM on Monday."),
        (3, "234 US dollars")], "fare_id long, label string")
    got = {r.fare_id: (r.carrier, r.dep_hhmm, r.price, r.nonstop) for r in text_parse.parse_fare_labels(labels).collect()}
    assert got == {1: ("Turkish Airlines", "13:05", 1234.0, True), 2: ("Delta", "00:30", 99.0, False)}


def test_duration_and_offset_text(spark):
    df = spark.createDataFrame([("12h 40m", "+1"), ("13h", ""), ("abc", "+2 days")], "d string, o string")
    got = [(r.m, r.k) for r in df.select(text_parse.duration_text("d").alias("m"), text_parse.day_offset("o").alias("k")).collect()]
    assert got == [(760, 1), (780, 0), (None, 2)]


def test_section_table_never_steals_next_section(spark):
    html = ("<h2>Chase Transfer Partners</h2><p>none</p><h2>Citi Transfer Partners</h2>"
            "<table><tr><th>h</th></tr><tr><td>United</td><td>Airline</td><td>1:1</td></tr></table>")
    rows = bank_table_rows(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    banks = {m: i for m, i in T.BANK_SECTIONS}
    chase, citi = (next(i for m, i in banks.items() if w in m) for w in ("chase", "citi"))
    assert {(r.section_id, r.table_found) for r in rows if r.section_id in (chase, citi) and r.row_idx is None} == {(chase, False), (citi, True)}
    assert [r.cells for r in rows if r.row_idx is not None] == [["United", "Airline", "1:1"]]


# ------------------------------------------------------------------ spines, shards, strides
def _offsets(spark, dense, step, mx):
    return one(spark, spine.dense_sparse_offsets(F.lit(dense), F.lit(step), F.lit(mx)))


def test_dense_sparse_offsets(spark):
    assert _offsets(spark, 3, 2, 10) == [0, 1, 2, 3, 5, 7, 9]
    assert _offsets(spark, 5, 3, 5) == [0, 1, 2, 3, 4]
    o = _offsets(spark, 14, 3, 90)
    assert o[:14] == list(range(14)) and 29 in o and [x for x in o if x >= 30] == list(range(30, 90, 7))
    assert all(x < 30 for x in _offsets(spark, 14, 3, 30))


def test_shard_total_disjoint_stable(spark):
    keys = spark.createDataFrame([(f"K{i:03d}",) for i in range(300)], "k string")
    a = keys.select("k", CQ.shard_of("k", 4).alias("s")).collect()
    b = keys.select("k", CQ.shard_of("k", 4).alias("s")).collect()
    assert a == b and {r.s for r in a} <= {0, 1, 2, 3} and len(a) == 300
    assert all(r.s == 0 for r in keys.select(CQ.shard_of("k", 1).alias("s")).collect())


def test_stride_sample_half_to_even(spark):
    def pick(cnt, n):
        df = spark.createDataFrame([(i, cnt) for i in range(cnt)], "i int, c int")
        return [r.i for r in df.filter(Q.stride_keep("i", "c", n)).orderBy("i").collect()]

    def ref(cnt, n):
        if cnt <= n:
            return list(range(cnt))
        return sorted({round(i * (cnt - 1) / (n - 1)) for i in range(n)})

    for cnt in (3, 5, 6, 9, 10, 17, 30):
        assert pick(cnt, 5) == ref(cnt, 5)


# ------------------------------------------------------------------ merge semantics
def _batch(spark, rows):
    return spark.createDataFrame(rows, "k string, p int, ord int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")


def test_conditional_merge_keeps_fresh_stamp_and_refreshes_expired(spark):
    t = lambda h: dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)
    cur = spark.createDataFrame([("a", 1, 0, t(0), t(20)), ("b", 1, 0, t(0), t(5)), ("c", 1, 0, t(0), t(20))],
                                "k string, p int, ord int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")
    b = _batch(spark, [("a", 1, 1, t(9), t(30)), ("b", 1, 1, t(9), t(30)), ("c", 2, 1, t(9), t(30)), ("d", 3, 1, t(9), t(30))])
    as_of = "2026-01-01 10:00:00"
    out = {r.k: r for r in merge.conditional_merge(cur.drop("ord"), b, ["k"], ["p"], ["scraped_at_utc", "expires_at_utc"],
                                                   ["ord"], as_of).collect()}
    assert out["a"].scraped_at_utc == t(0)          # unchanged and unexpired: skipped
    assert out["b"].scraped_at_utc == t(9)          # unchanged but expired: stamps refresh
    assert out["c"].p == 2 and out["c"].scraped_at_utc == t(9)
    assert out["d"].p == 3 and len(out) == 4
    again = merge.conditional_merge(
        spark.createDataFrame(list(out.values())), b, ["k"], ["p"], ["scraped_at_utc", "expires_at_utc"], ["ord"], as_of)
    assert {r.k: tuple(r) for r in again.collect()} == {k: tuple(v) for k, v in out.items()}  # idempotent


def test_run_outcome_truth_table(spark):
    rows = [(1, 1, "A", "B", "ok", 5), (1, 2, "A", "C", "error", 0),             # partial
            (2, 1, "A", "B", "error", 0),                                        # failed
            (3, 1, "A", "B", "ok", 3), (3, 2, "A", "C", "blocked", 0), (3, 3, "A", "D", "ok", 9),  # blocked
            (4, 1, "A", "B", "empty", 0)]                                        # healthy
    a = spark.createDataFrame(rows, "run_id long, seq long, origin string, dest string, outcome string, records int")
    got = {r.run_id: (r.status, r.records, r.routes_scraped) for r in reports.run_outcome(a).collect()}
    assert got == {1: ("partial", 5, 2), 2: ("failed", 0, 1), 3: ("blocked", 3, 1), 4: ("healthy", 0, 1)}


def test_merge_strategies_agree(spark):
    from __spark_entry__ import SMOKE_DIR
    from milesbase.plans import domain as D
    L = D.lk(spark, SMOKE_DIR)
    b = D.award_batch(L)
    args = (D.AWARD_KEY, D.AWARD_MATERIAL, D.AWARD_STAMPS, D.AWARD_ORDER, "2024-01-31 00:00:00")
    win = merge.conditional_merge(None, b, *args, keep_cols=["source"], strategy="window")
    agg = merge.conditional_merge(None, b, *args, keep_cols=["source"], strategy="aggregate")
    assert win.count() == agg.count() and win.exceptAll(agg).count() == 0 and agg.exceptAll(win).count() == 0
    cur = win.orderBy(*D.AWARD_KEY).limit(50)
    w2 = merge.conditional_merge(cur, b, *args, keep_cols=["source"], strategy="window")
    a2 = merge.conditional_merge(cur, b, *args, keep_cols=["source"], strategy="aggregate")
    assert w2.exceptAll(a2).count() == 0 and a2.exceptAll(w2).count() == 0


# ------------------------------------------------------------------ sinks and queue semantics
def test_insert_absent_never_modifies(spark):
    cur = spark.createDataFrame([("A", "B", "AS", "HIGH", 5)], "origin string, dest string, airline string, priority_tier string, search_count int")
    new = spark.createDataFrame([("A", "B", "AS", "LOW", 0), ("B", "A", "AS", "LOW", 0)], cur.schema)
    got = {(r.origin, r.dest): (r.priority_tier, r.search_count) for r in merge.insert_absent(new, cur, ["origin", "dest", "airline"]).collect()}
    assert got == {("A", "B"): ("HIGH", 5), ("B", "A"): ("LOW", 0)}


def test_keyed_update_ignores_unknown_keys(spark):
    cur = spark.createDataFrame([("A", 1.0, "x"), ("B", 2.0, "y")], "k string, rate double, other string")
    upd = spark.createDataFrame([("A", 9.0), ("Z", 7.0)], "k string, rate double")
    got = sorted(tuple(r) for r in merge.keyed_update(cur, upd, ["k"], ["rate"]).collect())
    assert got == [("A", 9.0, "x"), ("B", 2.0, "y")]


def test_scoped_and_unconditional_replace(spark):
    cur = spark.createDataFrame([(1, "AS", 10), (1, "UA", 20), (2, "DL", 30)], "bank int, airline string, pct int")
    batch = spark.createDataFrame([(3, "AS", 40)], cur.schema)
    got = sorted(tuple(r) for r in merge.scoped_replace(cur, batch, ["airline"]).collect())
    assert got == [(1, "UA", 20), (2, "DL", 30), (3, "AS", 40)]
    b2 = spark.createDataFrame([(1, "UA", 25, 1), (1, "UA", 26, 2)], "bank int, airline string, pct int, o int")
    got = sorted(tuple(r) for r in merge.unconditional_merge(cur, b2, ["bank", "airline"], ["o"]).collect())
    assert got == [(1, "AS", 10), (1, "UA", 26), (2, "DL", 30)]


def _queue(spark, n, scraped_every=2):
    base = dt.datetime(2024, 1, 30)
    rows = [(i, "AS", "MED", base - dt.timedelta(hours=i), None if i % scraped_every else base, 0.5, 0.0, None)
            for i in range(n)]
    return spark.createDataFrame(rows, "queue_id long, airline string, priority_tier string, next_scrape_at_utc timestamp_ntz, "
                                       "last_scraped_at_utc timestamp_ntz, change_rate double, decayed_demand double, "
                                       "last_search_at_utc timestamp_ntz")


def test_due_batch_never_scraped_first_and_backlog_count(spark):
    b = Q.due_batch(_queue(spark, 30), "2024-01-31 00:00:00", limit=5).orderBy("batch_rank").collect()
    assert len(b) == 5 and all(r.due_count == 30 for r in b)
    assert all(r.last_scraped_at_utc is None for r in b)  # never-scraped rows sort first


def test_shard_stride_disjoint_and_total(spark):
    b = Q.due_batch(_queue(spark, 40), "2024-01-31 00:00:00", limit=12)
    s = Q.shard_stride(b, 3, 4).collect()
    ids = [r.queue_id for r in s]
    assert len(ids) == len(set(ids)) == 12
    by_shard = {}
    for r in s:
        by_shard.setdefault(r.shard, []).append(r.batch_rank)
    assert {k: sorted(v) for k, v in by_shard.items()} == {0: [1, 4, 7, 10], 1: [2, 5, 8, 11], 2: [3, 6, 9, 12]}


def test_write_touched_partitions_only(spark):
    import os
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="touched-"), "t")
    d1, d2 = dt.date(2024, 2, 1), dt.date(2024, 2, 2)
    v1 = spark.createDataFrame([("a", d1, 1), ("b", d2, 1)], "k string, date date, p int")
    v1.write.partitionBy("date").parquet(path)
    untouched = os.path.join(path, "date=2024-02-01")
    before = {f: os.path.getmtime(os.path.join(untouched, f)) for f in os.listdir(untouched)}
    batch = spark.createDataFrame([("b", d2, 2)], v1.schema)
    merged = spark.createDataFrame([("a", d1, 1), ("b", d2, 2)], v1.schema)
    merge.write_touched_partitions(merged, batch, path)
    got = sorted((r.k, r.p) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 2)]
    after = {f: os.path.getmtime(os.path.join(untouched, f)) for f in os.listdir(untouched)}
    assert after == before  # the untouched date partition was neither deleted nor rewritten


# ------------------------------------------------------------------ landed text that does not parse is null, never a failure
@pytest.mark.parametrize("text,minutes", [("12h 40m", 760), ("13h", 780), ("12H 5m", 725), ("about 2h30m total", 150), ("0h", None),
                                          ("0h 0m", None), ("99999999999h", None), ("soon", None), (None, None), ("2000000000h 1m", None)])
def test_duration_text_anywhere(spark, text, minutes):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_parse.duration_text("t")).first()[0] == minutes


@pytest.mark.parametrize("text,days", [("+1", 1), ("1", 1), ("arr +2", 2), ("", 0), (None, 0), ("none", 0), ("99999999999", 0)])
def test_day_offset_any_digits(spark, text, days):
    assert spark.createDataFrame([(text,)], "t string").select(text_parse.day_offset("t")).first()[0] == days


@pytest.mark.parametrize("text,minutes", [("07:05", 425), ("x:y", None), ("12", None), ("", None), (None, None), ("9999999999:00", None)])
def test_hhmm_bad_text(spark, text, minutes):
    assert spark.createDataFrame([(text,)], "t string").select(text_parse.hhmm_minutes("t")).first()[0] == minutes


def test_price_of_commas_only_is_null(spark):
    df = spark.createDataFrame([(", US dollars",), ("1,234 US dollars",)], "t string")
    assert [r[0] for r in df.select(text_parse.price_text("t")).collect()] == [None, 1234.0]


def test_payload_shape_reads_the_top_level_field(spark, tmp_path):
    from milesbase.plans import QUERIES
    rows = [('{"nested": {"k": "x"}, "k": 1}',), ('{"k": [1]}',), ('{"k": {"k": 2}}',), ('{"k": null}',), ('{"k": 1.5}',), ('{"k": true}',),
            ('{"k": "s"}',), ('{"a": {"k": 1}}',)]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(1)
    df = spark.createDataFrame(rows, "p string")
    full = df.select(*[(F.col("p") if c == "props" else F.lit(None).cast(t)).alias(c) for c, t in events.dtypes])
    full.write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in QUERIES["fn_payload_shape"](spark, str(tmp_path)).select("keys", "k_type").collect()}
    assert got == {("k,nested", "int"), ("k", "list"), ("k", "dict"), ("k", "NoneType"), ("k", "float"), ("k", "bool"), ("k", "str"), ("a", "missing")}


def test_pins_expand_metros(spark):
    from milesbase.operators import cash_queue
    keys = {r[0] for r in cash_queue.pinned_keys(spark).collect()}
    for o in ("SEA", "PDX", "SFO", "LAX", "BUR", "SNA", "ONT", "LGB"):
        for d in ("JFK", "EWR", "LGA"):
            assert {f"{o}-{d}", f"{d}-{o}"} <= keys
    assert "SEA-MSP" in keys and "MSP-SEA" in keys and not any("NYC" in k or "METRO" in k for k in keys)


def test_a_cluster_session_needs_a_shared_folder():
    from milesbase import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_stored_tables_follow_their_input(spark, tmp_path):
    from milesbase.plans import domain as D

    class L:
        pass

    lake = L()
    lake.spark, lake.sf_dir, lake._frames = spark, str(tmp_path / "in"), {}
    spark.range(3).write.parquet(lake.sf_dir + "/t.parquet")
    build = lambda: spark.read.parquet(lake.sf_dir + "/t.parquet")
    assert D.materialized(lake, "t_test", build).count() == 3
    spark.range(5).write.mode("append").parquet(lake.sf_dir + "/t.parquet")
    assert D.materialized(lake, "t_test", build).count() == 8
    again = L()
    again.spark, again.sf_dir, again._frames = spark, lake.sf_dir, {}
    assert D.materialized(again, "t_test", lambda: 1 / 0).count() == 8  # read back, not built


def test_pages_without_tables_are_reported(spark):
    from milesbase.operators import html_tables
    pages = spark.createDataFrame([(1, "<html><p>nothing here</p></html>")], "page_id long, html string")
    rows = html_tables.bank_table_rows(pages)
    assert rows.filter("row_idx IS NULL AND NOT table_found").count() == rows.count() > 0


def test_cash_records_are_checked(spark):
    from milesbase.operators import quality
    t = dt.datetime(2024, 1, 30)
    good = ("SEA", "JFK", "AS 1", 99.0, "economy", "alaska_cash", t, t + dt.timedelta(hours=72))
    bad = {0: ("SEAX", "bad_iata"), 1: (None, "bad_iata"), 2: ("", "no_flight_number"), 3: (0.0, "price_nonpositive"),
           4: ("coach", "bad_cabin"), 5: (None, "no_source"), 7: (t, "expiry_not_after_scrape")}
    rows = [good] + [(*good[:i], v, *good[i + 1:]) for i, (v, _) in bad.items()]
    df = spark.createDataFrame(rows, "origin string, destination string, flight_number string, cash_price double, cabin_class string, "
                                     "source string, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")
    got = quality.check_invariants(df.coalesce(1), quality.cash_invariant_rules()).collect()
    assert [r.reject_reason for r in got] == [None] + [reason for _, reason in bad.values()]


def test_survey_items_with_two_tables_or_more_forms(spark):
    from __spark_entry__ import SMOKE_DIR
    from milesbase.plans import QUERIES
    from milesbase.plans import domain as D
    past = D.lk(spark, SMOKE_DIR).fx_award.filter("date < DATE '2024-01-30'").count()
    kept = QUERIES["snk_retention_flights"](spark, SMOKE_DIR)
    assert past and kept.count() == D.lk(spark, SMOKE_DIR).fx_award.count() - past
    assert QUERIES["flt_cash_invariants"](spark, SMOKE_DIR).count() == D.lk(spark, SMOKE_DIR).fx_cash.count()
    forms = {}
    for r in QUERIES["snk_keyed_update_forms"](spark, SMOKE_DIR).collect():
        forms.setdefault(r.form, {})[r.queue_id] = (r.priority_tier, r.last_scraped_at_utc, r.next_scrape_at_utc)
    assert sorted(forms) == ["blocked", "reset", "scraped", "tier"] and len({frozenset(f) for f in forms.values()}) == 1
    assert {f[2] for f in forms["reset"].values()} == {dt.datetime(2024, 1, 31)}
    assert any(forms[a][i] != forms["reset"][i][:2] + (forms["tier"][i][2],) for a in ("blocked", "scraped") for i in forms[a])
