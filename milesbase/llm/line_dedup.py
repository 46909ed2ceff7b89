"""Site-relative line dedup (DataFrame functions only).

A line is boilerplate of its host when more than ``max_ratio`` of the host's pages
contain it (and at least ``min_pages`` pages do). Lines compare without surrounding
ASCII white space, by two 64-bit hashes; blank lines are never boilerplate.

Scale: the counts are partially aggregated per task before their shuffle, so a hot
host or line arrives as one row per task. A host has at most
(mean lines per page) / ``max_ratio`` boilerplate lines, whatever its size, so their
set per host is small by construction. Texts are joined with it by host and a row-number salt
(each host's set is repeated ``SALTS`` times), so that a hot host's texts spread over many tasks.

Edge cases: null text stays null; a null host has no page total, so its lines stay;
empty tables give empty results; repeated rows count as pages each; other columns
pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import WS, free_name

MAX_RATIO = 0.1
MIN_PAGES = 3
SALTS = 32


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(WS))


def boilerplate(docs: DataFrame, text_col: str, host_col: str, max_ratio: float, min_pages: int) -> DataFrame:
    """host, pages, line keys (array of struct) of every host with boilerplate."""
    host = F.col(f"`{host_col}`").alias("host")
    pages = docs.select(host).where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = F.array_distinct(F.filter(F.transform(F.split(F.col(f"`{text_col}`"), "\n"), _bare), lambda x: x != ""))
    counts = (docs.where(F.col(f"`{host_col}`").isNotNull()).select(host, F.explode(lines).alias("line"))
              .groupBy("host", _key(F.col("line")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_pages))
    return (counts.join(pages, "host").where(F.col("n") > max_ratio * F.col("pages"))
            .groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list("key").alias("keys")))


def line_dedup(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_ratio: float = MAX_RATIO,
               min_pages: int = MIN_PAGES) -> tuple[DataFrame, str]:
    """``docs`` with boilerplate lines removed from ``text_col``, and a struct column (its name is returned)
    with n_lines and n_dropped (long)."""
    h, p, k, s, x, y = (free_name(docs, n) for n in ("_l_host", "_l_pages", "_l_keys", "_l_stats", "_l_salt", "_l_part"))
    found = boilerplate(docs, text_col, host_col, max_ratio, min_pages).toDF(h, p, k)
    found = found.withColumn(x, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop(p)
    out = docs.withColumn(y, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    out = out.join(found, (out[f"`{host_col}`"] == found[h]) & (out[y] == found[x]), "left").drop(h, x, y)
    text = F.col(f"`{text_col}`")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x: (_bare(x) == "") | ~F.array_contains(F.col(k), _key(_bare(x))))
    kept = F.when(F.col(k).isNull(), lines).otherwise(kept)
    s_kept = free_name(docs, "_l_kept")
    out = out.withColumn(s_kept, kept)
    n = F.coalesce(F.size(lines), F.lit(0))
    n = F.when(text.isNull(), F.lit(0)).otherwise(n)
    m = F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.col(s_kept)))
    out = out.withColumn(s, F.struct(n.cast("bigint").alias("n_lines"), (n - m).cast("bigint").alias("n_dropped")))
    out = out.withColumn(text_col, F.when(F.col(k).isNull(), text).otherwise(F.array_join(F.col(s_kept), "\n")))
    return out.drop(k, s_kept), s
