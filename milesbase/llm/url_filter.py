"""URL filter: host and path rules, then a character language-model ratio (DataFrame functions only).

URLs that a rule decides train two variable-order Markov models, one of accepted and one
of rejected URLs, over the characters of the whole URL (its host in lower case). Every row counts, in the
n-grams as in the calibration. Order d is Witten-Bell smoothed with order d - 1 (a context seen fewer than ``min_context`` times falls back whole), order 0
with a uniform start. A URL's score is the mean over its characters of
ln p(accepted) - ln p(rejected); the cutoff is calibrated on a fifth of the ruled URLs that
training leaves out (best mean of the two classes' accuracies, over 0.005-wide score steps).
URLs without a rule get ``allow`` at or above the cutoff.

Scale: models are tables of n-grams with their counts, which grow with the variety of n-grams
and not with the URLs; positions are joined with the scores of their n-gram. A single n-gram holds
at most a few percent of all positions, and equal URLs are scored once, with their number of rows as weight. The counts of the n-grams
and the URLs' scores are each worked out once and written to the shared folder.

Edge cases: URLs without ``://`` have empty host and path and no rule, and are scored as they stand; null and
empty URLs have score 0 (``allow``);
with no accepted or no rejected training URL every score is 0 and the verdict ``allow``;
repeated rows get a row each; a very long URL is modelled whole, one n-gram per character; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milesbase.llm.common import free_name, staged

#: (verdict, host, path) of the production rule list
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ORDER = 4
MIN_CONTEXT = 2
ALPHABET = 256.0
STEP = 0.005
SPAN = 5.0
START, END = "\x02", "\x03"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def text_of(url: Column, host: Column) -> Column:
    """The whole URL with its host (``host_of``) in lower case; empty for null."""
    url, at = F.coalesce(url, F.lit("")), F.instr(F.coalesce(url, F.lit("")), "://")
    lowered = F.concat(F.substring(url, F.lit(1), at + 2), host, F.substring(url, at + 3 + F.length(host), F.length(url)))
    return F.when(at > 0, lowered).otherwise(url)


def rule_of(host: Column, path: Column, rules: list) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(text: Column, order: int) -> Column:
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, order + 1))


def gram_scores(train: DataFrame, wanted: DataFrame, order: int = ORDER, min_context: int = MIN_CONTEXT) -> DataFrame:
    """train: gram, a, r (its counts in accepted and rejected URLs); wanted: distinct gram.
    Returns gram, ratio = ln p(accepted) - ln p(rejected) of its last character after its context."""
    out = wanted.withColumns({"pa": F.lit(1.0 / ALPHABET), "pr": F.lit(1.0 / ALPHABET)})
    for d in range(order + 1):
        tail = lambda c, d=d: F.substring(F.col(c), order + 1 - d, d + 1)
        grams = train.groupBy(tail("gram").alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        contexts = grams.groupBy(F.substring("g", 1, d).alias("ctx")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"),
            F.count_if(F.col("r") > 0).alias("tr"))
        out = out.withColumn("g", tail("gram")).withColumn("ctx", F.substring("g", 1, d))
        out = out.join(grams, "g", "left")
        # the empty context is one row
        out = out.join(F.broadcast(contexts) if d == 0 else contexts, "ctx", "left")
        for p, n, total, types in (("pa", "a", "na", "ta"), ("pr", "r", "nr", "tr")):
            smoothed = (F.coalesce(F.col(n), F.lit(0)) + F.col(types) * F.col(p)) / (F.col(total) + F.col(types))
            out = out.withColumn(p, F.when(F.col(total) >= (min_context if d else 1), smoothed).otherwise(F.col(p)))
        out = out.select("gram", "pa", "pr")
    return out.select("gram", (F.log("pa") - F.log("pr")).alias("ratio"))


def _calibrated(scored: DataFrame) -> DataFrame:
    """One row: the cutoff, from score, accepted and rows of the held-out ruled URLs (0 where a class is missing)."""
    steps = int(SPAN / STEP)
    b = F.floor(F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), F.col("score"))) / STEP).cast("int")
    bins = scored.groupBy(b.alias("b")).agg(
        F.sum(F.when(F.col("accepted"), F.col("rows")).otherwise(0)).alias("a"),
        F.sum(F.when(~F.col("accepted"), F.col("rows")).otherwise(0)).alias("r"))
    w = Window.orderBy("b")  # at most 2 * SPAN / STEP + 1 rows
    below = w.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bins = bins.withColumns({
        "na": F.sum("a").over(every), "nr": F.sum("r").over(every),
        "ca": F.coalesce(F.sum("a").over(below), F.lit(0)), "cr": F.coalesce(F.sum("r").over(below), F.lit(0))})
    good = (F.col("na") - F.col("ca")) / F.col("na") + F.col("cr") / F.col("nr")
    # every step from above the last bin to this one cuts alike: the one next to 0, also among equal accuracies
    bins = bins.withColumn("c", F.greatest(F.lag("b").over(Window.orderBy("b")) + 1, F.least(F.col("b"), F.lit(0))))
    best = F.max_by(F.col("c") * F.lit(STEP), F.struct(good, -F.abs(F.col("c")), F.col("c")))
    return bins.where("na > 0 AND nr > 0").agg(F.coalesce(best, F.lit(0.0)).cast("double").alias("cutoff"))


def url_verdicts(pages: DataFrame, url_col: str = "url", rules: list = RULES, order: int = ORDER,
                 min_context: int = MIN_CONTEXT) -> tuple[DataFrame, str]:
    """``pages`` with a struct column (its name is returned) host, path, rule, score, cutoff, verdict."""
    s, t = free_name(pages, "_u"), free_name(pages, "_u_text")
    url = F.col(f"`{url_col}`")
    out = pages.withColumn(s, F.struct(host_of(url).alias("host"), path_of(url).alias("path")))
    host, path = F.col(s)["host"], F.col(s)["path"]
    out = out.withColumn(s, F.struct(host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias("rule")))
    out = out.withColumn(t, text_of(url, host))

    texts = (out.where(F.col(t) != "").groupBy(F.col(t).alias("text"))
             .agg(F.first(F.col(s)["rule"]["verdict"]).alias("verdict"),  # the text fixes the rule
                  F.count(F.lit(1)).alias("rows")))
    held = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    grams = texts.select("text", "verdict", "rows", held.alias("held"), F.explode(_grams(F.col("text"), order)).alias("gram"))
    # one shuffle of pre-aggregated n-grams gives the training counts and the list of those to score; written once, like the
    # scores, since the models of all orders, the calibration and the verdicts read them again
    counts = staged(grams.groupBy("gram").agg(
        F.sum(F.when(~F.col("held") & (F.col("verdict") == "allow"), F.col("rows")).otherwise(0)).alias("a"),
        F.sum(F.when(~F.col("held") & (F.col("verdict") == "block"), F.col("rows")).otherwise(0)).alias("r")), "url-grams")
    train = counts.where("a > 0 OR r > 0")
    ratios = gram_scores(train, counts.select("gram"), order, min_context)
    scored = staged(grams.join(ratios, "gram").groupBy("text")
              .agg(F.first("verdict").alias("verdict"), F.first("held").alias("held"), F.first("rows").alias("rows"),
                   # exact decimals add up alike in any order
                   (F.sum(F.col("ratio").cast("decimal(18,12)")) / F.count(F.lit(1))).cast("double").alias("score")), "url-scores")
    both = train.agg((F.max("a") > 0).alias("has_a"), (F.max("r") > 0).alias("has_r"))
    cut = _calibrated(scored.where("held AND verdict IS NOT NULL")
                      .select("score", "rows", (F.col("verdict") == "allow").alias("accepted")))
    sc, cu, tr, tx = (free_name(out, x) for x in ("_u_score", "_u_cutoff", "_u_trained", "_u_joined"))
    out = out.join(scored.select(F.col("text").alias(tx), F.col("score").alias(sc)), F.col(t) == F.col(tx), "left")
    out = out.withColumn(cu, F.coalesce(cut.scalar(), F.lit(0.0)))
    out = out.withColumn(tr, F.coalesce(both.select(F.col("has_a") & F.col("has_r")).scalar(), F.lit(False)))
    score = F.when(F.col(tr), F.coalesce(F.col(sc), F.lit(0.0))).otherwise(F.lit(0.0))
    model = F.when(F.col(tr) & (F.col(t) != "") & (score < F.col(cu)), F.lit("block")).otherwise(F.lit("allow"))
    out = out.withColumn(s, F.struct(
        host.alias("host"), path.alias("path"), F.col(s)["rule"]["rule"].alias("rule"), score.alias("score"),
        F.col(cu).alias("cutoff"), F.coalesce(F.col(s)["rule"]["verdict"], model).alias("verdict")))
    return out.drop(t, tx, sc, cu, tr), s


def accepted_urls(pages: DataFrame, **kw) -> DataFrame:
    """The rows whose URL is allowed, with the columns of ``pages``."""
    out, s = url_verdicts(pages, **kw)
    return out.where(F.col(s)["verdict"] == "allow").drop(s)
