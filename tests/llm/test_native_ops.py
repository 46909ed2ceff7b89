"""Quality rules, line dedup and URL filter against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from milesbase.llm import line_dedup, quality_rules, url_filter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", "   ", "\n\n", "one", "a b c d", "a b c d e", "a b c d e a b c d e f", "x " * 60, "x y z x y z x y z x y z x y",
         "Ünï cödé wörds 漢字 😀 end", "l1 w\nl1 w\n \n\nl2\nl1 w", "#$% a|b <c> && **", "tab\tsep\x0bvt\x0cff\rcr",
         "\u00a0nbsp\u00a0word", "A B C " * 400 + "tail", " ".join(f"w{i}" for i in range(5000))]


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep,
            n < 10 or 100 * rep > 20 * n)


def test_statistics_match_python(spark):
    # extra columns named like the operator's own
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, _q_stats string, n_words int")
    out, s = quality_rules.text_stats(df)
    assert s != "_q_stats" and {"_q_stats", "n_words"} <= set(out.columns)
    got = {r["doc_id"]: tuple(r[s][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
           for r in out.collect()}
    assert got == {i: base(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("n,k", [(1, 0), (50, 0), (900, 3), (4000, 25), (100000, 900), (10, 9)])
def test_binomial_tail(spark, n, k):
    p = 0.01
    got = spark.range(1).select(quality_rules.binomial_cdf(F.lit(n), F.lit(k), p)).first()[0]
    if k >= n * p:
        assert got == 1.0
        return
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p) for i in range(k + 1)]
    assert got == pytest.approx(sum(map(math.exp, logs)), rel=1e-6)


def corpus(spark, good=2000, bad=400):
    words = " ".join(f"word{i}" for i in range(12))
    rows = [(i, "en", words, 1) for i in range(good)]
    rows += [(good + i, "en", " ".join(w + "###" for w in words.split()), 0) for i in range(bad)]
    rows += [(10**6 + i, None, " ".join(w + "###" for w in words.split()), None) for i in range(3)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, quality int")


def test_rules_reject_what_the_holdout_certifies(spark):
    docs = corpus(spark)
    out, s = quality_rules.judged(docs.drop("quality"), docs.select("doc_id", "quality"))
    kept = {r["doc_id"] for r in out.where(F.col(s)["kept"]).collect()}
    # bad ones of the certified stratum go; the null stratum has no holdout, so nothing is certified there
    assert kept == set(range(2000)) | {10**6, 10**6 + 1, 10**6 + 2}
    cut = quality_rules.certified_cutoffs(
        quality_rules.text_stats(docs)[0].select(F.col("lang").alias("stratum"), (F.col("quality") == 1).alias("good"),
                                                 *[m.alias(k) for k, m in quality_rules.measures(F.col("_q_stats")).items()]).where("good IS NOT NULL"))
    for r in cut.collect():
        tests = sum(map(len, quality_rules.GRID.values()))
        assert r["p_value"] <= quality_rules.DELTA / tests and r["false_rejected"] < quality_rules.ALPHA * r["n_good"]


def test_small_holdout_certifies_nothing(spark):
    docs = corpus(spark, 100, 50)
    kept = quality_rules.keep_good(docs.drop("quality"), docs.select("doc_id", "quality"))
    assert kept.count() == 153 and kept.columns == ["doc_id", "lang", "text"]
    empty = docs.drop("quality").limit(0)
    assert quality_rules.keep_good(empty, docs.select("doc_id", "quality")).count() == 0
    assert quality_rules.keep_good(docs.drop("quality"), docs.select("doc_id", "quality").limit(0)).count() == 153


def test_line_dedup_matches_python(spark):
    rows = [(i, "hot" if i % 3 else "b", f"common line\nown {i}\n\n  common line  \nrare {i % 20}") for i in range(60)]
    rows += [(100, None, "common line"), (101, "hot", None), (102, "hot", ""), (103, "hot", "common line"), (103, "hot", "common line"),
             (104, "solo", "a\na\na")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, source string, text string, _l_keys string")
    out, s = line_dedup.line_dedup(df)
    got = sorted((r["doc_id"], r["source"] or "", r["text"], r[s]["n_lines"], r[s]["n_dropped"], r["_l_keys"]) for r in out.collect() if r["text"] is not None)

    pages, counts = Counter(h for _, h, _ in rows if h), Counter()
    for _, h, t in rows:
        for line in {x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")} - {""}:
            counts[h, line] += h is not None
    want = []
    for i, h, t in rows:
        if t is None:
            continue
        keep = [x for x in t.split("\n") if not (counts[h, x.strip()] >= 3 and counts[h, x.strip()] > 0.1 * pages[h])] if h else t.split("\n")
        want.append((i, h or "", "\n".join(keep), len(t.split("\n")), len(t.split("\n")) - len(keep), "k"))
    assert got == sorted(want)
    assert out.where("text IS NULL").count() == 1
    assert line_dedup.line_dedup(df.limit(0))[0].count() == 0


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?q=/de/#f", "http://example.net/en", "https://net", "https://net/", "http://sub.example.com/de/1",
            "http://myexample.com/de/1", "http://x.org/fr/://y", "a://b://c/d", "http://ÄB.org/fr/é", "http://h?x", "http://q.net:80/p"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    out, s = url_filter.url_verdicts(df)

    def parse(u):
        if not u or "://" not in u:
            return "", ""
        m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]

    def rule(h, p):
        fit = [(rh + rp, v) for v, rh, rp in url_filter.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        return max(fit, key=lambda x: len(x[0])) if fit else (None, None)

    for r in out.collect():
        h, p = parse(r["url"])
        assert (r[s]["host"], r[s]["path"], r[s]["rule"]) == (h, p, rule(h, p)[0])
        if r[s]["rule"]:
            assert r[s]["verdict"] == rule(h, p)[1]
        else:
            assert r[s]["verdict"] in ("allow", "block")


def ln_p(counts, gram, order, min_context):
    p = 1.0 / url_filter.ALPHABET
    for d in range(order + 1):
        g = gram[order - d:]
        ctx = {k: n for k, n in counts[d].items() if k[:d] == g[:d]}
        total = sum(ctx.values())
        if total >= (min_context if d else 1):
            p = (ctx.get(g, 0) + len(ctx) * p) / (total + len(ctx))
    return math.log(p)


def test_markov_ratios_match_python(spark):
    order, good, bad = 2, ["abab/x", "abc"], ["zzz/y", "zab"]

    def grams(t):
        t = url_filter.START * order + t + url_filter.END
        return [t[i:i + order + 1] for i in range(len(t) - order)]

    rows = Counter(("a", g) for t in good for g in grams(t)) + Counter(("r", g) for t in bad for g in grams(t))
    train = spark.createDataFrame([(g, rows["a", g], rows["r", g]) for g in {g for _, g in rows}], "gram string, a long, r long")
    wanted = sorted({g for t in good + bad + ["new/q", "ab"] for g in grams(t)})
    got = {r["gram"]: r["ratio"] for r in url_filter.gram_scores(train, spark.createDataFrame([(g,) for g in wanted], "gram string"), order, 2).collect()}
    models = {}
    for c in "ar":
        models[c] = [Counter() for _ in range(order + 1)]
        for (k, g), n in rows.items():
            if k == c:
                for d in range(order + 1):
                    models[c][d][g[order - d:]] += n
    for g in wanted:
        assert got[g] == pytest.approx(ln_p(models["a"], g, order, 2) - ln_p(models["r"], g, order, 2), abs=1e-9)


def test_model_separates_unruled_urls(spark):
    rows = [f"http://good{i % 7}.example.net/en/{i}" for i in range(300)] + [f"http://spam{i % 9}.net/win/{i}" for i in range(300)]
    rows += ["http://good1.example.info/en/7"] * 5 + ["http://spam3.info/win/5"] * 5 + [None] * 5
    df = spark.createDataFrame([(i, u, "s") for i, u in enumerate(rows)], "page_id long, url string, _u string")
    out, s = url_filter.url_verdicts(df)
    got = [r[s]["verdict"] for r in out.where("page_id >= 600").orderBy("page_id").collect()]
    assert got == ["allow"] * 5 + ["block"] * 5 + ["allow"] * 5
    assert url_filter.accepted_urls(df).columns == df.columns
    # one class only: no model, all allowed
    one, s = url_filter.url_verdicts(df.where("page_id < 300 OR page_id >= 600"))
    assert one.where(F.col(s)["verdict"] == "block").count() == 0
    assert url_filter.url_verdicts(df.limit(0))[0].count() == 0


def test_model_counts_whole_urls_and_every_row(spark):
    order, r = 2, random.Random(5)
    path = lambda a: "/" + "".join(r.choice(a) for _ in range(4))
    urls = [f"http://Good.example.net/en{path('abc')}?q={path('ab')}" for _ in range(40)] + [f"http://bad.net{path('xyz')}#{path('yz')}" for _ in range(40)]
    urls = [u for u in urls for _ in range(r.choice([1, 1, 1, 6]))] + [urls[0]] * 200
    odd = ["http://h.info/p?q=aabb", "http://h.info/p?q=zzyy", "http://h.info/p#zzyy", "aabb", "zzyyzz", "", None]
    df = spark.createDataFrame(list(enumerate(urls + odd)), "page_id long, url string")
    out, s = url_filter.url_verdicts(df, order=order)
    out = out.withColumn("text", url_filter.text_of(F.col("url"), F.col(s)["host"]))
    got = out.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(5)) == 0).orderBy("page_id").collect()
    assert got[0]["text"] == urls[0].replace("Good", "good") and got[-3]["text"] == "zzyyzz"

    def grams(t):
        t = url_filter.START * order + t + url_filter.END
        return [t[i:i + order + 1] for i in range(len(t) - order)]

    models = {"allow": [Counter() for _ in range(order + 1)], "block": [Counter() for _ in range(order + 1)]}
    for x in got:
        if x[s]["rule"] and not x["held"]:
            for g in grams(x["text"]):
                for d in range(order + 1):
                    models[x[s]["verdict"]][d][g[order - d:]] += 1
    ratio = {g: ln_p(models["allow"], g, order, 2) - ln_p(models["block"], g, order, 2) for g in {g for x in got for g in grams(x["text"])}}
    for x in got:
        want = sum(ratio[g] for g in grams(x["text"])) / len(grams(x["text"])) if x["text"] else 0.0
        assert x[s]["score"] == pytest.approx(want, abs=1e-9)
    held = [(x[s]["score"], x[s]["verdict"] == "allow") for x in got if x[s]["rule"] and x["held"]]
    bins = [(math.floor(v / url_filter.STEP), a) for v, a in held]
    good, bad = sum(a for _, a in bins), sum(not a for _, a in bins)
    best = max((sum(a and b >= c for b, a in bins) / good + sum(not a and b < c for b, a in bins) / bad, -abs(c), c) for c in range(-1000, 1001))
    assert [x[s]["cutoff"] for x in got] == pytest.approx([best[2] * url_filter.STEP] * len(got))
    last = [x[s]["verdict"] for x in got[-7:]]
    assert last == ["allow" if x["text"] == "" or x[s]["score"] >= x[s]["cutoff"] else "block" for x in got[-7:]]
    assert last[3:] == ["allow", "block", "allow", "allow"] and len({x[s]["score"] for x in got[-7:-4]}) == 3
