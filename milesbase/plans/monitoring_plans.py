"""Run metrics, payload drift monitoring, redaction, itinerary layovers and label-part parsers
(snk_run_metrics, fn_payload_shape, fn_redact_code, win_trip_layover, fn_price_text, fn_stops_text)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import reports, text_parse
from milesbase.plans import domain as D
from milesbase.plans.matching_plans import _labels
from milesbase.plans.registry import query
from milesbase.plans.report_plans import _RUN_CTE
from milesbase.sources.fixtures import AS_OF

# --- fixed values: redaction and drift-monitoring patterns ---
SAFE_KEY = r"^[A-Za-z][A-Za-z0-9_]{0,39}$"
SAFE_CODE = r"^[A-Za-z0-9_.:-]{1,40}$"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$"
SECRET_HINTS = ("secret", "token", "bearer", "cookie", "authorization", "password")
MAX_KEYS = 20
# --- end fixed values ---
WS = r"[ \t\n\r\f]+"


# ------------------------------------------------------------------ run metrics
@query("snk_run_metrics", f"""
WITH pr AS (SELECT run_id, origin, dest, bool_and(NOT coalesce(b_seq IS NOT NULL AND origin = b_origin AND dest = b_dest, false)) AS counted,
  sum(records) AS records, count(*) FILTER (WHERE outcome = 'error') AS errors FROM ra GROUP BY run_id, origin, dest),
pru AS (SELECT run_id, sum(records) AS records, sum(errors) AS errors, count(*) FILTER (WHERE counted) AS routes_scraped FROM pr GROUP BY run_id),
fr AS (SELECT source, count(*) AS source_rows, count(*) FILTER (WHERE expires_at_utc > TIMESTAMP '{AS_OF}') AS unexpired_rows,
  round(epoch(TIMESTAMP '{AS_OF}' - max(scraped_at_utc)) / 3600.0, 1) AS newest_age_h FROM flights GROUP BY source)
SELECT 'scrape_run' AS event, runs.run_id, CASE runs.run_id % 6 WHEN 0 THEN 'alaska' WHEN 1 THEN 'delta' WHEN 2 THEN 'jetblue'
  WHEN 3 THEN 'turkish' WHEN 4 THEN 'etihad' ELSE 'southwest' END AS source, runs.nb > 0 AS blocked,
 CAST(coalesce(pru.records, 0) AS BIGINT) AS records, CAST(coalesce(pru.errors, 0) AS BIGINT) AS errors,
 CAST(coalesce(pru.routes_scraped, 0) AS BIGINT) AS routes_scraped, fr.source_rows, fr.unexpired_rows, fr.newest_age_h
FROM runs LEFT JOIN pru USING (run_id) LEFT JOIN fr ON fr.source = CASE runs.run_id % 6 WHEN 0 THEN 'alaska' WHEN 1 THEN 'delta'
  WHEN 2 THEN 'jetblue' WHEN 3 THEN 'turkish' WHEN 4 THEN 'etihad' ELSE 'southwest' END""", D.FLIGHTS_CTE + "," + _RUN_CTE)
def snk_run_metrics(spark, sf_dir):
    """One metric event per run: outcome counts plus the freshness snapshot of the run's source
    (the snapshot has one row per source, so it is broadcast)."""
    L = D.lk(spark, sf_dir)
    out = reports.run_outcome(L.fx_attempt)
    src = X.case_map(F.pmod("run_id", F.lit(6)), {i: s for i, s in enumerate(["alaska", "delta", "jetblue", "turkish", "etihad"])},
                     "southwest")
    fr = reports.freshness(D.flights_table(L), AS_OF).select("source", F.col("rows").alias("source_rows"), "unexpired_rows", "newest_age_h")
    return out.withColumn("source", src).join(F.broadcast(fr), "source", "left").select(
        F.lit("scrape_run").alias("event"), "run_id", "source", "blocked", "records", "errors", "routes_scraped",
        "source_rows", "unexpired_rows", "newest_age_h")


# ------------------------------------------------------------------ payload drift
_TYPE_SQL = """CASE WHEN json_type(props, '$.k') IS NULL THEN 'missing' WHEN json_type(props, '$.k') IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'int'
 WHEN json_type(props, '$.k') = 'DOUBLE' THEN 'float' WHEN json_type(props, '$.k') = 'VARCHAR' THEN 'str' WHEN json_type(props, '$.k') = 'OBJECT' THEN 'dict'
 WHEN json_type(props, '$.k') = 'ARRAY' THEN 'list' WHEN json_type(props, '$.k') = 'BOOLEAN' THEN 'bool' ELSE 'NoneType' END"""


@query("fn_payload_shape", f"""
SELECT keys, k_type, count(*) AS events FROM (
 SELECT array_to_string(list_sort(list_filter(json_keys(props), lambda x: regexp_full_match(x, '{SAFE_KEY[1:-1]}')))[1:{MAX_KEYS}], ',') AS keys,
  {_TYPE_SQL} AS k_type FROM events) GROUP BY keys, k_type""")
def fn_payload_shape(spark, sf_dir):
    """Drift report over event payloads: sorted safe top-level keys (<= 20) and the JSON type of field k."""
    e = D.lk(spark, sf_dir).events
    keys = F.slice(F.array_sort(F.filter(F.json_object_keys("props"), lambda k: k.rlike(SAFE_KEY))), 1, MAX_KEYS)
    # the type of the top-level field itself, whatever nested fields share its name
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("props"), "$.k", "variant"))
    has_k = F.array_contains(F.coalesce(F.json_object_keys("props"), F.array().cast("array<string>")), "k")
    typ = (F.when(~has_k, "missing").when(kind == "STRING", "str").when(kind.startswith("OBJECT"), "dict")
            .when(kind.startswith("ARRAY"), "list").when(kind == "BOOLEAN", "bool").when(kind == "VOID", "NoneType")
            .when(kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"), "int").otherwise("float"))
    s = e.select(F.array_join(keys, ",").alias("keys"), typ.alias("k_type"))
    return s.groupBy("keys", "k_type").agg(F.count(F.lit(1)).alias("events"))


# ------------------------------------------------------------------ redaction over whole document texts
_HINTS_SQL = " OR ".join(f"contains(lower(t), '{h}')" for h in SECRET_HINTS)


@query("fn_redact_code", f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '{WS}'), lambda t: t <> '') AS toks FROM documents)
SELECT doc_id, len(toks) AS tokens,
 len(list_filter(toks, lambda t: regexp_full_match(t, '{SAFE_CODE[1:-1]}') AND NOT regexp_full_match(t, '{UUID[1:-1]}') AND NOT ({_HINTS_SQL}))) AS safe_codes,
 len(list_filter(toks, lambda t: regexp_full_match(t, '{UUID[1:-1]}'))) AS uuids,
 len(list_filter(toks, lambda t: regexp_full_match(t, '{SAFE_CODE[1:-1]}') AND ({_HINTS_SQL}))) AS secret_shaped
FROM d""")
def fn_redact_code(spark, sf_dir):
    """Per document (whole text): tokens, code-like tokens that may be kept, UUIDs and
    secret-shaped tokens that must be dropped. Pure array expressions: no shuffle."""
    d = D.lk(spark, sf_dir).documents
    toks = F.filter(F.split(F.coalesce("text", F.lit("")), WS), lambda t: t != "")
    hint = lambda t: X.any_of([F.lower(t).contains(h) for h in SECRET_HINTS])
    d = d.select("doc_id", toks.alias("toks"))
    n = lambda c: F.size(c).cast("bigint")
    return d.select("doc_id", n("toks").alias("tokens"),
                    n(F.filter("toks", lambda t: t.rlike(SAFE_CODE) & ~t.rlike(UUID) & ~hint(t))).alias("safe_codes"),
                    n(F.filter("toks", lambda t: t.rlike(UUID))).alias("uuids"),
                    n(F.filter("toks", lambda t: t.rlike(SAFE_CODE) & hint(t))).alias("secret_shaped"))


# ------------------------------------------------------------------ itinerary layovers
@query("win_trip_layover", """
SELECT itin_id, CAST(sum(CASE WHEN gap > 0 THEN gap END) AS BIGINT) AS layover_positive, CAST(sum(gap) AS BIGINT) AS layover_all FROM (
 SELECT itin_id, lead(dep_min) OVER (PARTITION BY itin_id ORDER BY leg_no) - arr_min AS gap FROM fx_legs) GROUP BY itin_id""")
def win_trip_layover(spark, sf_dir):
    """Sum of gaps between consecutive legs: positive gaps only (first form) and all gaps (second form);
    null when an itinerary has no such gap."""
    legs = D.lk(spark, sf_dir).fx_legs
    w = Window.partitionBy("itin_id").orderBy("leg_no")
    g = legs.withColumn("gap", F.lead("dep_min").over(w) - F.col("arr_min"))
    return g.groupBy("itin_id").agg(F.sum(F.when(F.col("gap") > 0, F.col("gap"))).cast("bigint").alias("layover_positive"),
                                    F.sum("gap").cast("bigint").alias("layover_all"))


# ------------------------------------------------------------------ label parts
@query("fn_price_text", "SELECT fare_id, CAST(price AS DOUBLE) AS price FROM fx_fare")
def fn_price_text(spark, sf_dir):
    """'1,234 US dollars' -> 1234.0 from each fare's rendered label (bare chips parse too)."""
    lab = _labels(D.lk(spark, sf_dir)).filter(F.col("label").startswith("From "))
    return lab.select("fare_id", text_parse.price_text("label").alias("price"))


@query("fn_stops_text", "SELECT fare_id, carrier, nonstop FROM fx_fare")
def fn_stops_text(spark, sf_dir):
    """'Nonstop flight with X.' / 'N stop(s) flight with X.' -> (carrier, nonstop)."""
    lab = _labels(D.lk(spark, sf_dir)).filter(F.col("label").rlike(text_parse.STOPS_RE))
    t = F.col("label")
    return lab.select("fare_id", F.trim(F.regexp_extract(t, text_parse.STOPS_RE, 3)).alias("carrier"),
                      (F.regexp_extract(t, text_parse.STOPS_RE, 1) == "Nonstop").alias("nonstop"))
