"""Transfer partner / bonus plans."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from milesbase.functions import exprs as X
from milesbase.operators import html_tables, intervals, merge, transfers as T
from milesbase.plans import domain as D
from milesbase.plans.registry import query
from milesbase.sources.fixtures import AS_OF_DATE

PAGE_ROWS = 50  # partner rows per generated page (bounds every page)

# --- fixed values: cell texts used when rendering the bonus page ---
BANK_TEXT = {1: "Chase Ultimate Rewards", 2: "Amex Membership Rewards", 3: "Capital One Miles",
             4: "Citi ThankYou Points", 5: "Bilt Rewards", 6: "Marriott Bonvoy", 7: "Wells Fargo Rewards"}
AIRLINE_TEXT = {"AS": "Alaska Airlines", "DL": "Delta SkyMiles", "B6": "JetBlue TrueBlue",
                "TK": "Turkish Airlines Miles&Smiles", "EY": "Etihad", "WN": "Southwest Rapid Rewards"}
# --- end fixed values ---


def _esc(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def _ordered_concat(struct_col, field):
    return F.array_join(F.transform(F.array_sort(F.collect_list(struct_col)), lambda x: x[field]), "")


# ------------------------------------------------------------------ generated pages
def partner_pages(L):
    """Bank sections rendered from partner rows, PAGE_ROWS rows per page."""
    r = L.fx_partner_rows.withColumn("page_id", X.idiv("row_id", F.lit(PAGE_ROWS)))
    tr = F.concat(F.lit("<tr><td>"), _esc(F.col("program_raw")), F.lit("</td><td>"), F.col("type_raw"),
                  F.lit("</td><td>"), F.col("ratio_raw"), F.lit("</td><td>2 days</td></tr>"))
    sec = r.groupBy("page_id", "bank_marker").agg(_ordered_concat(F.struct("row_id", tr.alias("h")), "h").alias("rows"))
    sec = sec.withColumn("section", F.concat(
        F.lit("<h2>"), F.initcap("bank_marker"), F.lit(" Transfer Partners</h2><table><tr><th>Program</th><th>Type</th>"
                                                     "<th>Transfer Ratio</th><th>Transfer Time</th></tr>"),
        F.col("rows"), F.lit("</table><p>Transfers are usually instant.</p>")))
    page = sec.groupBy("page_id").agg(_ordered_concat(F.struct("bank_marker", "section"), "section").alias("body"))
    return page.select("page_id", F.concat(F.lit("<html><body><h1>Credit card transfer partners</h1>"
                                                 "<h2>How to Earn Points</h2>"), F.col("body"),
                                           F.lit("</body></html>")).alias("html"))


def bonus_cells(L):
    """Cell texts of the bonus table, one row per bonus (marks appended to some airlines)."""
    b = L.fx_bonus
    airline = X.case_map("airline_code", AIRLINE_TEXT)
    return b.select("bank_program_id", "airline_code", "starts_at", "bonus_pct", "ends_at",
                    X.case_map("bank_program_id", BANK_TEXT).alias("bank_text"),
                    F.concat(F.col("bonus_pct").cast("string"), F.lit("%")).alias("pct_text"),
                    F.when(F.pmod("bonus_pct", F.lit(10)) == 5, F.concat(airline, F.lit("*"))).otherwise(airline).alias("airline_text"),
                    F.date_format("ends_at", "M/d/yy").alias("date_text"))


def bonus_pages(L):
    """One generated page per bank (first table = bonus list, with a hotel row and a short row),
    plus the crawled ``pages`` table, which carries no table at all."""
    c = bonus_cells(L)
    tr = F.concat(F.lit("<tr><td>"), F.col("bank_text"), F.lit("</td><td>"), F.col("pct_text"), F.lit("</td><td>"),
                  _esc(F.col("airline_text")), F.lit("</td><td>"), F.col("date_text"), F.lit("</td></tr>"))
    g = c.groupBy("bank_program_id").agg(
        _ordered_concat(F.struct("airline_code", "starts_at", tr.alias("h")), "h").alias("rows"),
        F.first("bank_text").alias("bank_text"))
    html = F.concat(F.lit("<html><body><h1>Current transfer bonuses</h1><table><tr><th>Point Program</th>"
                          "<th>Bonus Rate</th><th>Airline / Hotel Program</th><th>End Date</th></tr>"),
                    F.col("rows"), F.lit("<tr><td>"), F.col("bank_text"),
                    F.lit("</td><td>20%</td><td>Hilton Honors</td><td>12/31/24</td></tr><tr><td>More soon</td></tr>"
                          "</table><table><tr><td>x</td></tr></table></body></html>"))
    gen = g.select((-F.col("bank_program_id")).cast("bigint").alias("page_id"), html.alias("html"))
    return gen.unionByName(L.pages.select("page_id", "html"))


def parsed_partner_rows(spark, L):
    rows = html_tables.bank_table_rows(partner_pages(L)).filter(F.col("row_idx").isNotNull() & (F.size("cells") >= 3))
    return rows.select("page_id", "row_idx", F.col("section_id").alias("bank_program_id"),
                       F.col("cells")[0].alias("program_raw"), F.col("cells")[1].alias("type_raw"),
                       F.col("cells")[2].alias("ratio_raw"))


def parsed_bonuses(spark, L):
    """htm_bonus_table: records from every page's first table; a page without a table is an error row."""
    rows = html_tables.first_table_rows(bonus_pages(L))
    errors = rows.filter(~F.col("table_found")).select("page_id", F.lit("no_table").alias("error"))
    r = rows.filter(F.col("row_idx").isNotNull() & (F.size("cells") >= 4)).select(
        "page_id", "row_idx", F.col("cells")[0].alias("bank_raw"), F.col("cells")[1].alias("bonus_raw"),
        F.col("cells")[2].alias("airline_raw"), F.col("cells")[3].alias("end_raw"))
    r = T.lookup(spark, r, F.lower(F.trim("bank_raw")), T.BANK_MAP, "bank_program_id", "int")
    r = r.withColumn("_clean", T.clean_airline("airline_raw"))
    r = T.lookup(spark, r, F.lower("_clean"), T.AIRLINE_MAP, "airline_code", "string")
    r = r.withColumn("bonus_pct", T.parse_pct("bonus_raw")).withColumn("ends_at", T.parse_us_date("end_raw"))
    r = r.filter(F.col("bank_program_id").isNotNull() & F.col("airline_code").isNotNull()
                 & F.col("bonus_pct").isNotNull() & F.col("ends_at").isNotNull())
    recs = r.select("page_id", "row_idx", "bank_program_id", "airline_code", "bonus_pct",
                    F.lit(AS_OF_DATE).cast("date").alias("starts_at"), "ends_at",
                    F.when(F.col("airline_raw") != F.col("_clean"), F.col("airline_raw")).alias("notes"),
                    F.lit(None).cast("string").alias("error"))
    return recs, errors


def partner_snapshot(spark, L):
    """Parsed partner records, last row per (bank, airline) in page order (the upsert net effect)."""
    cls = T.classify_partner_rows(parsed_partner_rows(spark, L).withColumn(
        "row_id", F.col("page_id") * 1000000 + F.col("row_idx")))
    recs = T.partner_records(cls)
    return merge.latest_per_key(recs, ["bank_program_id", "airline_code"], ["row_id"],
                                ["program_name", "transfer_ratio", "min_transfer", "transfer_increment"])


def partner_matrix(spark, L):
    """jn_partner_matrix: partners JOIN banks LEFT JOIN active bonus."""
    return T.partners_with_bonus(partner_snapshot(spark, L), T.banks(spark), L.fx_bonus, AS_OF_DATE)


# ------------------------------------------------------------------ DuckDB twins
def _case(col, mapping, default="NULL"):
    parts = " ".join(f"WHEN {repr(k) if isinstance(k, str) else k} THEN {repr(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"CASE {col} {parts} ELSE {default} END"


def _match_sql(col):
    cases = " ".join(f"WHEN regexp_matches(lower({col}), '\\b{k}\\b') THEN '{code}'" for code, _, kws in T.AIRLINE_MATCHERS for k in kws)
    return f"CASE {cases} END"


_NAME_SQL = _case("airline_code", {c: n for c, n, _ in T.AIRLINE_MATCHERS})
_BANKS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{s}')" for i, n, s in T.BANK_PROGRAMS) + \
             ") AS t(bank_program_id, bank_name, short_code)"
_RATIO_SQL = """CASE WHEN position(':' IN ratio_raw) > 0 AND lft > 0 AND rgt > 0 AND round(lft / rgt, 2) BETWEEN 0.1 AND 10
  THEN round(lft / rgt, 2) END"""
_PR_CTE = f"""
banks AS ({_BANKS_SQL}),
pr0 AS (SELECT *, row_id // {PAGE_ROWS} AS page_id, {_case("bank_marker", dict(T.BANK_SECTIONS))} AS bank_program_id,
  TRY_CAST(trim(replace(split_part(ratio_raw, ':', 1), ',', '')) AS DOUBLE) AS lft,
  TRY_CAST(trim(replace(substr(ratio_raw, position(':' IN ratio_raw) + 1), ',', '')) AS DOUBLE) AS rgt,
  {_match_sql("program_raw")} AS airline_code FROM fx_partner_rows),
pr AS (SELECT *, {_RATIO_SQL} AS transfer_ratio, {_NAME_SQL} AS program_name,
  CASE WHEN lower(trim(type_raw)) <> 'airline' THEN 'skipped_hotel' WHEN airline_code IS NULL THEN 'skipped_unmapped'
   WHEN ({_RATIO_SQL}) IS NULL THEN 'ratio_dropped' ELSE 'mapped' END AS status FROM pr0),
partners AS (SELECT bank_program_id, airline_code, program_name, transfer_ratio, 1000 AS min_transfer, 1000 AS transfer_increment
  FROM pr WHERE status = 'mapped' AND bank_program_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY bank_program_id, airline_code ORDER BY row_id DESC) = 1),
active AS (SELECT * FROM fx_bonus WHERE starts_at <= DATE '2024-01-31' AND ends_at >= DATE '2024-01-31'),
matrix AS (SELECT p.*, b.bank_name, b.short_code, a.bonus_pct, a.ends_at AS bonus_ends FROM partners p
  JOIN banks b USING (bank_program_id) LEFT JOIN active a USING (bank_program_id, airline_code))"""

_MATRIX_COLS = ["bank_program_id", "bank_name", "short_code", "airline_code", "program_name", "transfer_ratio",
                "min_transfer", "transfer_increment", "bonus_pct", "bonus_ends"]


# ------------------------------------------------------------------ parsing
@query("fn_match_airline", f"""SELECT row_id, airline_code, {_NAME_SQL} AS program_name FROM pr0""", _PR_CTE)
def fn_match_airline(spark, sf_dir):
    """Program cell -> (IATA code, canonical program) by the first whole-word keyword match."""
    r = D.lk(spark, sf_dir).fx_partner_rows.withColumn("_m", T.match_airline("program_raw"))
    return r.select("row_id", F.col("_m.airline_code").alias("airline_code"), F.col("_m.program_name").alias("program_name"))


@query("fn_parse_ratio", f"""SELECT row_id, ratio_raw, {_RATIO_SQL} AS transfer_ratio FROM pr0""", _PR_CTE)
def fn_parse_ratio(spark, sf_dir):
    """'bank:partner' ratio -> points per mile, 2 dp half-up; null outside (0, 10] rules."""
    r = D.lk(spark, sf_dir).fx_partner_rows
    return r.select("row_id", "ratio_raw", T.parse_ratio("ratio_raw").alias("transfer_ratio"))


@query("htm_bank_tables", """
SELECT page_id, bank_program_id, program_raw, type_raw, ratio_raw FROM pr0 WHERE bank_program_id IS NOT NULL""", _PR_CTE)
def htm_bank_tables(spark, sf_dir):
    """Rows of each managed bank's own table, found by heading marker."""
    return parsed_partner_rows(spark, D.lk(spark, sf_dir)).drop("row_idx")


@query("agg_parse_stats", f"""
SELECT page_id, count(DISTINCT bank_program_id) AS banks_found, {len(T.BANK_SECTIONS)} - count(DISTINCT bank_program_id) AS banks_missing,
 count(*) FILTER (WHERE status <> 'skipped_hotel') AS airline_rows_seen, count(*) FILTER (WHERE status = 'skipped_hotel') AS rows_skipped_hotel,
 count(*) FILTER (WHERE status = 'skipped_unmapped') AS rows_skipped_unmapped, count(*) FILTER (WHERE status = 'ratio_dropped') AS rows_ratio_dropped,
 count(*) FILTER (WHERE status = 'mapped') AS records
FROM pr WHERE bank_program_id IS NOT NULL GROUP BY page_id""", _PR_CTE)
def agg_parse_stats(spark, sf_dir):
    """Per page: banks found / missing and row classification counts."""
    L = D.lk(spark, sf_dir)
    raw = html_tables.bank_table_rows(partner_pages(L))
    banks = raw.filter(F.col("row_idx").isNull()).groupBy("page_id").agg(
        F.count_if("table_found").alias("banks_found"))
    cls = T.classify_partner_rows(parsed_partner_rows(spark, L))
    rows = cls.groupBy("page_id").agg(
        F.count_if(F.col("status") != "skipped_hotel").alias("airline_rows_seen"),
        F.count_if(F.col("status") == "skipped_hotel").alias("rows_skipped_hotel"),
        F.count_if(F.col("status") == "skipped_unmapped").alias("rows_skipped_unmapped"),
        F.count_if(F.col("status") == "ratio_dropped").alias("rows_ratio_dropped"),
        F.count_if(F.col("status") == "mapped").alias("records"))
    counts = ["airline_rows_seen", "rows_skipped_hotel", "rows_skipped_unmapped", "rows_ratio_dropped", "records"]
    # a page on which no table or no row is found stays, with zeros: that is the failure to report
    return banks.join(rows, "page_id", "left").select(
        "page_id", "banks_found", (F.lit(len(T.BANK_SECTIONS)) - F.col("banks_found")).alias("banks_missing"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


_BONUS_CELLS_CTE = f"""
bcells AS (SELECT bank_program_id, airline_code, starts_at, bonus_pct, ends_at, {_case("bank_program_id", BANK_TEXT)} AS bank_text,
  CAST(bonus_pct AS VARCHAR) || '%' AS pct_text,
  CASE WHEN bonus_pct % 10 = 5 THEN {_case("airline_code", AIRLINE_TEXT)} || '*' ELSE {_case("airline_code", AIRLINE_TEXT)} END AS airline_text,
  strftime(ends_at, '%-m/%-d/%y') AS date_text FROM fx_bonus)"""


@query("htm_bonus_table", """
SELECT -bank_program_id AS page_id, bank_program_id, airline_code, bonus_pct, DATE '2024-01-31' AS starts_at, ends_at,
 CASE WHEN bonus_pct % 10 = 5 THEN airline_text END AS notes, CAST(NULL AS VARCHAR) AS error FROM bcells
UNION ALL SELECT page_id, NULL, NULL, NULL, NULL, NULL, NULL, 'no_table' FROM pages""", _BONUS_CELLS_CTE)
def htm_bonus_table(spark, sf_dir):
    """First table of every page -> bonus records; hotels / unknown banks / short rows skipped;
    a page with no table yields an error row instead of failing the job."""
    L = D.lk(spark, sf_dir)
    recs, errors = parsed_bonuses(spark, L)
    err = errors.select("page_id", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("bank_program_id", "int"), ("airline_code", "string"), ("bonus_pct", "int"), ("starts_at", "date"),
        ("ends_at", "date"), ("notes", "string"))], "error")
    return recs.drop("row_idx").unionByName(err)


@query("fn_bank_lookup", f"""
SELECT bank_program_id AS expected_id, bank_text, {_case("lower(trim(bank_text))", T.BANK_MAP)} AS bank_id FROM bcells""",
       _BONUS_CELLS_CTE)
def fn_bank_lookup(spark, sf_dir):
    """Bank cell text -> bank program id via lower-trim exact lookup."""
    c = bonus_cells(D.lk(spark, sf_dir)).select(F.col("bank_program_id").alias("expected_id"), "bank_text")
    return T.lookup(spark, c, F.lower(F.trim("bank_text")), T.BANK_MAP, "bank_id", "int")


@query("fn_airline_lookup", f"""
SELECT airline_text, {_case("lower(trim(regexp_replace(airline_text, '[*†‡§]+$', '')))", T.AIRLINE_MAP)} AS airline_code,
 CASE WHEN airline_text <> trim(regexp_replace(airline_text, '[*†‡§]+$', '')) THEN airline_text END AS notes FROM bcells""",
       _BONUS_CELLS_CTE)
def fn_airline_lookup(spark, sf_dir):
    """Trailing footnote marks stripped before the lookup; the original text kept as notes."""
    c = bonus_cells(D.lk(spark, sf_dir)).select("airline_text").withColumn("_clean", T.clean_airline("airline_text"))
    c = T.lookup(spark, c, F.lower("_clean"), T.AIRLINE_MAP, "airline_code", "string")
    return c.select("airline_text", "airline_code",
                    F.when(F.col("airline_text") != F.col("_clean"), F.col("airline_text")).alias("notes"))


@query("fn_parse_pct", """
SELECT bank_program_id, airline_code, starts_at, CASE WHEN bonus_pct % 20 = 0 THEN 'TBD' ELSE pct_text END AS pct_text,
 CASE WHEN bonus_pct % 20 = 0 THEN NULL ELSE bonus_pct END AS bonus_pct FROM bcells""", _BONUS_CELLS_CTE)
def fn_parse_pct(spark, sf_dir):
    """'25%' -> 25; anything else null."""
    c = bonus_cells(D.lk(spark, sf_dir))
    c = c.withColumn("pct_text", F.when(F.pmod("bonus_pct", F.lit(20)) == 0, F.lit("TBD")).otherwise(F.col("pct_text")))
    return c.select("bank_program_id", "airline_code", "starts_at", "pct_text", T.parse_pct("pct_text").alias("bonus_pct"))


@query("fn_parse_us_date", """
SELECT bank_program_id, airline_code, starts_at, CASE WHEN bonus_pct = 40 THEN date_text || 'x' ELSE date_text END AS date_text,
 CASE WHEN bonus_pct = 40 THEN NULL ELSE ends_at END AS ends_at FROM bcells""", _BONUS_CELLS_CTE)
def fn_parse_us_date(spark, sf_dir):
    """'M/D/YY' -> date; malformed -> null."""
    c = bonus_cells(D.lk(spark, sf_dir))
    c = c.withColumn("date_text", F.when(F.col("bonus_pct") == 40, F.concat("date_text", F.lit("x"))).otherwise(F.col("date_text")))
    return c.select("bank_program_id", "airline_code", "starts_at", "date_text", T.parse_us_date("date_text").alias("ends_at"))


# ------------------------------------------------------------------ sinks
@query("snk_snapshot_replace", """SELECT * FROM partners""", _PR_CTE)
def snk_snapshot_replace(spark, sf_dir):
    """The partner table after a full snapshot replace: exactly the parsed batch (last row per key)."""
    return partner_snapshot(spark, D.lk(spark, sf_dir))


@query("snk_snapshot_counts", """
SELECT 'replace' AS mode, (SELECT count(*) FROM dim_partner) AS deleted,
 (SELECT count(*) FROM pr WHERE status = 'mapped' AND bank_program_id IS NOT NULL) AS inserted
UNION ALL SELECT 'dry_run', 0, 0""", _PR_CTE)
def snk_snapshot_counts(spark, sf_dir):
    """(deleted, inserted) of the partner snapshot replace over the stored partners, for real and as a dry run; every parsed record
    counts as inserted, those of one key too."""
    L = D.lk(spark, sf_dir)
    recs = T.partner_records(T.classify_partner_rows(parsed_partner_rows(spark, L).withColumn("row_id", F.col("page_id") * 1000000 + F.col("row_idx"))))
    cur = L.dim_partner.select("bank_program_id", "airline_code")
    out = [merge.snapshot_replace(cur, recs, dry_run=dry)[1].select(F.lit(mode).alias("mode"), "deleted", "inserted")
           for mode, dry in (("replace", False), ("dry_run", True))]
    return out[0].unionByName(out[1])


_BONUS_BATCH_CTE = _PR_CTE + "," + _BONUS_CELLS_CTE + """,
bbatch AS (SELECT bank_program_id, airline_code, DATE '2024-01-31' AS starts_at, bonus_pct, ends_at,
  CASE WHEN bonus_pct % 10 = 5 THEN airline_text END AS notes FROM bcells
  QUALIFY row_number() OVER (PARTITION BY bank_program_id, airline_code ORDER BY starts_at DESC) = 1)"""


def _bonus_batch(spark, L):
    recs, _ = parsed_bonuses(spark, L)
    return merge.latest_per_key(recs, ["bank_program_id", "airline_code", "starts_at"], ["page_id", "row_idx"],
                                ["bonus_pct", "ends_at", "notes"])


@query("snk_scoped_replace", """
SELECT * FROM (SELECT bank_program_id, airline_code, starts_at, bonus_pct, ends_at, CAST(NULL AS VARCHAR) AS notes FROM fx_bonus
  WHERE airline_code NOT IN (SELECT airline_code FROM partners)) k
WHERE NOT EXISTS (SELECT 1 FROM bbatch b WHERE b.bank_program_id = k.bank_program_id AND b.airline_code = k.airline_code AND b.starts_at = k.starts_at)
UNION ALL SELECT * FROM bbatch""", _BONUS_BATCH_CTE)
def snk_scoped_replace(spark, sf_dir):
    """Bonuses: delete rows of airlines tracked by partners, keep the rest, upsert the batch."""
    L = D.lk(spark, sf_dir)
    cur = L.fx_bonus.select("bank_program_id", "airline_code", "starts_at", "bonus_pct", "ends_at",
                            F.lit(None).cast("string").alias("notes"))
    tracked = partner_snapshot(spark, L).select("airline_code")
    kept = cur.join(tracked.distinct(), "airline_code", "left_anti")
    return merge.unconditional_merge(kept.select(*cur.columns), _bonus_batch(spark, L).select(*cur.columns),
                                     ["bank_program_id", "airline_code", "starts_at"], ["starts_at"])


@query("snk_dim_merge", f"""
WITH cur AS (SELECT bank_program_id, airline_code, {_NAME_SQL} AS program_name, ratio_cents / 100.0 AS transfer_ratio,
  1000 AS min_transfer, 1000 AS transfer_increment FROM dim_partner)
SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM partners p WHERE p.bank_program_id = cur.bank_program_id AND p.airline_code = cur.airline_code)
UNION ALL SELECT * FROM partners""", _PR_CTE)
def snk_dim_merge(spark, sf_dir):
    """Unconditional upsert of parsed partners into the seeded partner dimension."""
    L = D.lk(spark, sf_dir)
    names = T.program_names(spark)
    cur = L.dim_partner.join(F.broadcast(names), "airline_code", "left").select(
        "bank_program_id", "airline_code", "program_name", (F.col("ratio_cents") / 100.0).alias("transfer_ratio"),
        F.lit(T.MIN_TRANSFER).alias("min_transfer"), F.lit(T.TRANSFER_INCREMENT).alias("transfer_increment"))
    batch = partner_snapshot(spark, L).withColumn("_o", F.lit(0))
    return merge.unconditional_merge(cur, batch, ["bank_program_id", "airline_code"], ["_o"])


@query("jn_semi_tracked", """
SELECT * FROM fx_bonus WHERE airline_code IN (SELECT airline_code FROM partners)""", _PR_CTE)
def jn_semi_tracked(spark, sf_dir):
    """Bonus rows whose airline is tracked by a partner (left semi join, no distinct needed)."""
    L = D.lk(spark, sf_dir)
    return L.fx_bonus.join(partner_snapshot(spark, L).select("airline_code"), "airline_code", "left_semi")


# ------------------------------------------------------------------ serving: matrix, bonuses, options
@query("jn_partner_matrix", "SELECT " + ", ".join(_MATRIX_COLS) + " FROM matrix", _PR_CTE)
def jn_partner_matrix(spark, sf_dir):
    """Bank x airline partner matrix with ratios and the active bonus."""
    return partner_matrix(spark, D.lk(spark, sf_dir)).select(*_MATRIX_COLS)


@query("top_partner_matrix", "SELECT " + ", ".join(_MATRIX_COLS) + " FROM matrix ORDER BY bank_name, transfer_ratio, airline_code", _PR_CTE)
def top_partner_matrix(spark, sf_dir):
    """The matrix ordered by bank name, best ratio first."""
    return partner_matrix(spark, D.lk(spark, sf_dir)).select(*_MATRIX_COLS).orderBy("bank_name", "transfer_ratio", "airline_code")


@query("jn_active_bonus", """
SELECT bank_program_id, bank_name, airline_code, program_name, transfer_ratio, bonus_pct, bonus_ends FROM matrix""", _PR_CTE)
def jn_active_bonus(spark, sf_dir):
    """Partners JOIN banks LEFT JOIN bonuses valid at as_of (interval predicate, both ends inclusive)."""
    return partner_matrix(spark, D.lk(spark, sf_dir)).select(
        "bank_program_id", "bank_name", "airline_code", "program_name", "transfer_ratio", "bonus_pct", "bonus_ends")


@query("flt_partner_search", """
SELECT 'bank:express' AS search, * FROM (SELECT """ + ", ".join(_MATRIX_COLS) + """ FROM matrix) m WHERE short_code ILIKE '%express%' OR bank_name ILIKE '%express%'
UNION ALL SELECT 'airline:as', * FROM (SELECT """ + ", ".join(_MATRIX_COLS) + """ FROM matrix) m WHERE airline_code = 'AS' OR program_name ILIKE '%as%'""",
       _PR_CTE)
def flt_partner_search(spark, sf_dir):
    """Either-direction search: a bank term, and an airline term that is also a name substring."""
    m = partner_matrix(spark, D.lk(spark, sf_dir)).select(*_MATRIX_COLS)
    a = T.search_partners(m, bank="express").select(F.lit("bank:express").alias("search"), *_MATRIX_COLS)
    b = T.search_partners(m, airline="as").select(F.lit("airline:as").alias("search"), *_MATRIX_COLS)
    return a.unionByName(b)


_BONUS_REPORT_SQL = """
SELECT b.bank_name, b.short_code, a.airline_code, p.program_name, a.bonus_pct, a.starts_at, a.ends_at
FROM active a JOIN banks b USING (bank_program_id) LEFT JOIN partners p USING (bank_program_id, airline_code)"""


def _bonus_report(spark, L):
    a = T.active_bonuses(L.fx_bonus, AS_OF_DATE)
    p = partner_snapshot(spark, L).select("bank_program_id", "airline_code", "program_name")
    return a.join(F.broadcast(T.banks(spark)), "bank_program_id").join(p, ["bank_program_id", "airline_code"], "left") \
            .select("bank_name", "short_code", "airline_code", "program_name", "bonus_pct", "starts_at", "ends_at")


@query("jn_active_bonuses_report", _BONUS_REPORT_SQL, _PR_CTE)
def jn_active_bonuses_report(spark, sf_dir):
    """Active bonuses JOIN banks LEFT JOIN partners (program names)."""
    return _bonus_report(spark, D.lk(spark, sf_dir))


@query("top_bonuses", _BONUS_REPORT_SQL + " ORDER BY a.bonus_pct DESC, a.ends_at, b.bank_name, a.airline_code, a.starts_at", _PR_CTE)
def top_bonuses(spark, sf_dir):
    """Active bonuses, biggest first, soonest-ending first among equals."""
    return _bonus_report(spark, D.lk(spark, sf_dir)).orderBy(
        F.col("bonus_pct").desc(), "ends_at", "bank_name", "airline_code", "starts_at")


_OPTIONS_CTE = D.FLIGHTS_CTE + """,
active AS (SELECT * FROM fx_bonus WHERE starts_at <= DATE '2024-01-31' AND ends_at >= DATE '2024-01-31'),
opts AS (SELECT f.origin, f.destination, f.date, f.airline, f.cabin_class, f.raw_flight_number, f.points_cost,
  p.bank_program_id, a.bonus_pct,
  (CAST(f.points_cost AS BIGINT) * p.ratio_cents + 99) // 100 AS base_points_needed,
  (CAST(f.points_cost AS BIGINT) * p.ratio_cents + 100 + coalesce(a.bonus_pct, 0) - 1) // (100 + coalesce(a.bonus_pct, 0)) AS effective_points_needed
  FROM flights f JOIN dim_partner p ON p.airline_code = f.airline
  LEFT JOIN active a ON a.bank_program_id = p.bank_program_id AND a.airline_code = p.airline_code)"""


def _options(spark, L):
    a = T.active_bonuses(L.fx_bonus, AS_OF_DATE).select("bank_program_id", "airline_code", "bonus_pct")
    pb = L.dim_partner.join(a, ["bank_program_id", "airline_code"], "left").withColumnRenamed("airline_code", "airline")
    awards = D.flights_table(L).select(*D.AWARD_KEY, "points_cost")
    return T.transfer_options(awards, pb, "ratio_cents")


@query("jn_transfer_options", "SELECT * FROM opts", _OPTIONS_CTE)
def jn_transfer_options(spark, sf_dir):
    """Every award row x every bank partnering its airline: base and effective bank points.
    The partner side is keyed by (bank, airline) plus active bonuses; Spark broadcasts it when it is small."""
    return _options(spark, D.lk(spark, sf_dir)).select(
        *D.AWARD_KEY, "points_cost", "bank_program_id", "bonus_pct", "base_points_needed", "effective_points_needed")


@query("fn_base_points", "SELECT origin, destination, date, airline, cabin_class, raw_flight_number, bank_program_id, bonus_pct, base_points_needed FROM opts",
       _OPTIONS_CTE)
def fn_base_points(spark, sf_dir):
    """CEIL(points x ratio) per award row and partner bank, exact integer arithmetic."""
    return _options(spark, D.lk(spark, sf_dir)).select(*D.AWARD_KEY, "bank_program_id", "bonus_pct", "base_points_needed")


@query("fn_effective_points", "SELECT origin, destination, date, airline, cabin_class, raw_flight_number, bank_program_id, bonus_pct, effective_points_needed FROM opts",
       _OPTIONS_CTE)
def fn_effective_points(spark, sf_dir):
    """CEIL(points x ratio / (1 + bonus/100)) with the active bonus, exact integer arithmetic."""
    return _options(spark, D.lk(spark, sf_dir)).select(*D.AWARD_KEY, "bank_program_id", "bonus_pct", "effective_points_needed")


_RANKED = """row_number() OVER (PARTITION BY origin, destination, date, airline, cabin_class, raw_flight_number
 ORDER BY effective_points_needed, bank_program_id, coalesce(bonus_pct, 0) DESC)"""


@query("top_transfer", f"""
SELECT origin, destination, date, airline, cabin_class, raw_flight_number, CAST({_RANKED} AS INTEGER) AS rank, bank_program_id, bonus_pct,
 base_points_needed, effective_points_needed FROM opts""", _OPTIONS_CTE)
def top_transfer(spark, sf_dir):
    """Every bank option of each award row, fewest effective points first (ties: lower bank id). A window holds one
    award's options, at most one per bank and bonus."""
    w = Window.partitionBy(*D.AWARD_KEY).orderBy("effective_points_needed", "bank_program_id", F.coalesce("bonus_pct", F.lit(0)).desc())
    return _options(spark, D.lk(spark, sf_dir)).select(
        *D.AWARD_KEY, F.row_number().over(w).alias("rank"), "bank_program_id", "bonus_pct", "base_points_needed", "effective_points_needed")


@query("jn_bonus_at_scrape", """
SELECT f.origin, f.destination, f.date, f.airline, f.cabin_class, f.raw_flight_number, f.points_cost, CAST(f.scraped_at_utc AS DATE) AS seen_on,
 p.bank_program_id, b.bonus_pct, b.starts_at AS bonus_starts, b.ends_at AS bonus_ends,
 (CAST(f.points_cost AS BIGINT) * p.ratio_cents + 100 + coalesce(b.bonus_pct, 0) - 1) // (100 + coalesce(b.bonus_pct, 0)) AS effective_points_needed
FROM flights f JOIN dim_partner p ON p.airline_code = f.airline
LEFT JOIN fx_bonus b ON b.bank_program_id = p.bank_program_id AND b.airline_code = p.airline_code AND CAST(f.scraped_at_utc AS DATE) BETWEEN b.starts_at AND b.ends_at""",
       D.FLIGHTS_CTE)
def jn_bonus_at_scrape(spark, sf_dir):
    """Every award with each partner bank and the bonuses valid on the day the award was seen (not at one as_of), by a stabbing
    join of (airline, day) with the bonus intervals."""
    L = D.lk(spark, sf_dir)
    awards = D.flights_table(L).select(*D.AWARD_KEY, "points_cost", F.to_date("scraped_at_utc").alias("seen_on"))
    bonuses = L.fx_bonus.select(F.col("airline_code").alias("airline"), "bank_program_id", "bonus_pct", "starts_at", "ends_at")
    valid = intervals.stabbed(awards, bonuses, ["airline"], "seen_on", "starts_at", "ends_at")
    banks = L.dim_partner.select(F.col("airline_code").alias("airline"), "bank_program_id", "ratio_cents")
    out = awards.join(banks, "airline").join(valid, ["airline", "seen_on", "bank_program_id"], "left")
    return out.select(*D.AWARD_KEY, "points_cost", "seen_on", "bank_program_id", "bonus_pct", F.col("starts_at").alias("bonus_starts"),
                      F.col("ends_at").alias("bonus_ends"), X.effective_points("points_cost", "ratio_cents", "bonus_pct").alias("effective_points_needed"))
