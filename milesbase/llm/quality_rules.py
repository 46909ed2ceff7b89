"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Text statistics feed a fixed grid of (rule, cutoff) candidates. On a labelled
holdout, a candidate's false rejections among good documents of a stratum are
binomial; the exact one-sided test of "false rejection rate > alpha" has the p-value
P(Bin(n, alpha) <= k). A candidate is certified when that p-value is at most
delta / (strata x rules x cutoffs) (Bonferroni), so with probability 1 - delta every
certified rule wrongly rejects at most ``alpha`` of its stratum's good documents, and
all rules together at most ``alpha x rules``. Per stratum and rule the certified
cutoff that rejects most bad holdout documents is applied (ties: the laxest). A
cutoff that no holdout can certify is not applied.

Edge cases: null text counts as empty; a null stratum is a stratum of its own;
labels with null id or quality are ignored, several labels of one id count as the
worst one; an empty label table certifies nothing, so only the base rules reject;
repeated document rows are judged each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milesbase.llm.common import WS, free_name, staged, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

#: measure -> candidate cutoffs (reject above); fixed beforehand, so the whole holdout tests them
GRID = {
    "symbols_per_word": [0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0],
    "dup_line_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 0.9],
    "repeat_share": [0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.18, 0.2],
    "upper_share": [0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8],
    "word_length": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0, 100.0, 1000.0],
}
ALPHA = 0.01
DELTA = 0.05


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words inside 5-word windows whose hash occurs twice or more; ``hashes``: one per window, in order."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s):
        same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(s):
        return F.aggregate(s, F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
                           lambda a, i: F.struct((i + WINDOW).alias("end"),
                                                 (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")))["n"]

    # one-element arrays bind the sorted lists once, so that the lambdas do not sort again for each element
    listed = F.flatten(F.transform(F.array(pairs), starts))
    counted = F.get(F.transform(F.array(listed), covered), 0)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(counted)


def text_stats(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus one struct column (its name is returned, chosen free of clashes) with n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper (long) and base_failed."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    w, ln, h, s = (free_name(docs, x) for x in ("_q_words", "_q_lines", "_q_hashes", "_q_stats"))
    out = docs.withColumns({
        w: words_of(text),
        ln: F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS)) != ""),
    })
    words = F.col(w)
    out = out.withColumn(h, F.when(
        F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]))))
    n_words = F.size(words).cast("bigint")
    stats = F.struct(
        n_words.alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(F.col(ln)) - F.size(F.array_distinct(F.col(ln)))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(words, F.col(h)).alias("n_repeat_words"),
        F.size(F.col(ln)).cast("bigint").alias("n_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("bigint").alias("n_upper"),
    )
    out = out.withColumn(s, stats).drop(w, ln, h)
    failed = (F.col(s)["n_words"] < MIN_WORDS) | (
        100 * F.col(s)["n_repeat_words"] > MAX_REPEAT_PCT * F.col(s)["n_words"])
    return out.withColumn(s, F.col(s).withField("base_failed", failed)), s


def measures(stats: Column) -> dict[str, Column]:
    n = F.greatest(stats["n_words"], F.lit(1))
    return {
        "symbols_per_word": stats["n_symbols"] / n,
        "dup_line_share": stats["n_dup_lines"] / F.greatest(stats["n_lines"], F.lit(1)),
        "repeat_share": stats["n_repeat_words"] / n,
        "upper_share": stats["n_upper"] / F.greatest(stats["word_chars"], F.lit(1)),
        "word_length": stats["word_chars"] / n,
    }


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed exactly term by term in logarithms (k below n x p; else 1 is returned,
    as such a count never certifies anything)."""
    odds = F.lit(p / (1 - p))
    # s holds the sum of the terms so far divided by the last one, whose logarithm is lt
    first = F.struct((n * F.log(F.lit(1 - p))).alias("lt"), F.lit(1.0).alias("s"))

    def step(a, i):
        up = F.log((n - i + 1) / i * odds)
        return F.struct((a["lt"] + up).alias("lt"), (a["s"] * F.exp(-up) + 1.0).alias("s"))

    last = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1)).cast("bigint")), first, step)).otherwise(first)
    value = F.get(F.transform(F.array(last), lambda x: F.exp(x["lt"] + F.log(x["s"]))), 0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(value, F.lit(1.0)))


def certified_cutoffs(holdout: DataFrame, grid: dict = GRID, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """holdout: stratum, good (boolean) and one double column per rule of ``grid``.
    Returns stratum, rule, cutoff, n_good, false_rejected, bad_rejected, p_value of the chosen cutoffs."""
    cells = F.array(*[
        F.struct(F.lit(rule).alias("rule"),
                 # how many cutoffs of the rule reject this document
                 F.size(F.array_compact(F.array(*[F.when(F.col(rule) > c, F.lit(1)) for c in cuts]))).alias("over"))
        for rule, cuts in grid.items()])
    counts = (holdout.select("stratum", "good", F.explode(cells).alias("x"))
              .groupBy("stratum", "x.rule", "x.over")
              .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    # one row per stratum and rule: bounded arrays over the grid positions
    per_rule = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("over", "good", "bad")).alias("bins"))
    all_cuts = F.create_map(*[v for rule, cuts in grid.items()
                              for v in (F.lit(rule), F.array(*[F.lit(float(c)) for c in cuts]))])
    rows = per_rule.select("stratum", "rule", "n_good", "bins", F.posexplode(all_cuts[F.col("rule")]).alias("pos", "cutoff"))
    over = F.filter("bins", lambda b: b["over"] > F.col("pos"))
    rows = rows.select(
        "stratum", "rule", "cutoff", "n_good",
        F.aggregate(over, F.lit(0).cast("bigint"), lambda a, b: a + b["good"]).alias("false_rejected"),
        F.aggregate(over, F.lit(0).cast("bigint"), lambda a, b: a + b["bad"]).alias("bad_rejected"))
    strata = counts.select("stratum").distinct().agg(F.count(F.lit(1)).alias("n_strata"))
    tests = sum(len(c) for c in grid.values())
    rows = rows.withColumn("p_value", binomial_cdf(F.col("n_good"), F.col("false_rejected"), alpha))
    certified = rows.where((F.col("p_value") <= F.lit(delta) / (strata.scalar() * tests)) & (F.col("bad_rejected") > 0))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("bad_rejected"), F.desc("cutoff"))
    return (certified.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r"))


def judged(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
           text_col: str = "text", stats: tuple[DataFrame, str] | None = None,
           grid: dict = GRID, alpha: float = ALPHA, delta: float = DELTA) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned) of the statistics, base_failed, reasons and kept."""
    with_stats, s = stats or text_stats(docs, text_col)
    truth = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.min("quality") == 1).alias("good")))
    holdout = with_stats.where(~F.col(s)["base_failed"]).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{stratum_col}`").cast("string").alias("stratum"),
        *[m.alias(k) for k, m in measures(F.col(s)).items()]).join(truth, "_id").drop("_id")
    # a table of at most a few rows per stratum, written so that it is worked out once
    cut = staged(certified_cutoffs(holdout, grid, alpha, delta), "quality-cutoffs")
    # one value for the job: certifying a stratum takes hundreds of its labelled documents, so there are few;
    # "=" marks a stratum that is not null, as maps have no null keys
    def key(c):
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))

    chosen = (cut.groupBy(key(F.col("stratum")).alias("k"))
              .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("v"))
              .agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).scalar())
    c = free_name(with_stats, "_q_cut")
    out = with_stats.withColumn(c, F.try_element_at(chosen, key(F.col(f"`{stratum_col}`"))))
    reasons = F.filter(F.array(*[F.when(m > F.try_element_at(F.col(c), F.lit(k)), F.lit(k)) for k, m in measures(F.col(s)).items()]),
                       lambda x: x.isNotNull())
    reasons = F.coalesce(reasons, F.array().cast("array<string>"))
    out = out.withColumn(s, F.col(s).withField("reasons", reasons))
    out = out.withColumn(s, F.col(s).withField("kept", ~F.col(s)["base_failed"] & (F.size(F.col(s)["reasons"]) == 0)))
    return out.drop(c), s


def keep_good(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``. The statistics are written once with their
    documents: inlined into the filter, they would be evaluated again for every rule."""
    with_stats, s = text_stats(docs, kw.get("text_col", "text"))
    with_stats = staged(with_stats, "quality-stats")
    out, s = judged(with_stats, labels, stats=(with_stats, s), **kw)
    return out.where(F.col(s)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
