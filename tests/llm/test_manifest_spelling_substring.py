"""Merkle manifest, spelling variants and substring dedup against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from milesbase.llm import fm_index, merkle, packing, spelling, substring_dedup
from milesbase.llm.plans import QUERIES, token_pattern, tokenizer
from milesbase.operators.numbering import numbered

SMOKE = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def text_key(r):
    return tuple(str(x) for x in r)


# ---- row numbers and manifest -----------------------------------------------------------------------------

def test_numbers_equal_row_number(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "hot", "hot", "hot", "a", "b"]), rng.choice([None, i]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o int, pos int").repartition(7)
    got = {(r.g, r.pos): (r._pos, r.n) for r in numbered(df, ["g"], ["o", "pos"], "_pos", "n").collect()}
    for g in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[g, r[2]] for r in mine] == [(i, len(mine)) for i in range(len(mine))]
    assert sorted(r.p for r in numbered(df, [], ["pos"], "p").collect()) == list(range(500))
    assert numbered(df.limit(0), ["g"], ["o"], "p").count() == 0


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def grown(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for row in levels[:-1]:
        a = i // 3 * 3
        out.append((row[a:i], row[i + 1:a + 3]))
        i //= 3
    return out


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, h(*map(field, r))))
    trees = [grown([h(*map(field, r)) for r in groups[s]]) for s in order]
    top = grown([t[-1][0] for t in trees])
    out = []
    for g, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            steps = path(trees[g], i) + path(top, g)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            f = h(*map(field, (*r[:4], text)))
            for left, right in steps:
                f = h(*left, f, *right)
            out.append((r[0], trees[g][0][i], trees[g][-1][0], top[-1][0], h(*[x for a, b in steps for x in a + b]), f, f == top[-1][0]))
    return out


@pytest.mark.parametrize("floor", [10_000, 3])
@pytest.mark.parametrize("n,sources", [(0, 1), (1, 0), (4, 0), (150, 4), (60, 50)])
def test_manifest_matches_python(spark, monkeypatch, floor, n, sources):
    monkeypatch.setattr(merkle, "FLOOR", floor)
    rng = random.Random(n + sources)
    rows = [(None if sources and i % 40 == 7 else i, rng.choice([None, "s0", "s0", *[f"s{j}é" for j in range(sources)]]) if sources else "one",
             rng.choice([None, "en"]), rng.choice([None, i]), rng.choice([None, "", "a\nb", "x\n", "zz é", "long " * 30_000 + "\n"])) for i in range(n)]
    rows += rows[:2] if n > 100 else []  # repeated rows
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree int").repartition(5)
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got, _ = merkle.manifest(df, tampered=cut)
    assert sorted([tuple(r) for r in got.collect()], key=text_key) == sorted(manifest(rows), key=text_key)


def test_untouched_manifest_verifies(spark):
    df = spark.createDataFrame([(i, "s" if i % 3 else "t", None, i, f"text {i}") for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    got, m = merkle.manifest(df)
    assert all(r.verified and r.root == m.root for r in got.collect())


# ---- spelling ---------------------------------------------------------------------------------------------

def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def spelled(counts):
    out = {}
    for w, n in counts.items():
        some = [v for v in counts if near(w, v)]
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best and counts[best] >= 5 * n else None, n, len(some))
    rows = []
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, counts[form] if form else None))
    return rows


@pytest.mark.parametrize("most", [250_000, 6])
def test_variants_match_all_pairs(spark, most):
    rng = random.Random(2)
    counts = {}
    for _ in range(120):
        base = "".join(rng.choice("abéÿ") for _ in range(rng.choice([6, 6, 7, 8, 11])))
        counts[base] = rng.choice([5, 30, 500, 500, 4000])
        for _ in range(4):
            i = rng.randrange(len(base) + 1)
            v = rng.choice([base[:i] + rng.choice("abé") + base[i:], base[:i] + base[i + 1:], base[:i] + "ÿ" + base[i + 1:]])
            if len(v) >= 6:
                counts[v] = rng.choice([5, 6, 100])
    counts |= {"x" * 40_000: 5, "x" * 39_999 + "y": 60, "x" * 40_001: 5}
    df = spark.createDataFrame([(*x, "e") for x in counts.items()], "word string, n int, head string")
    got = [tuple(r) for r in spelling.variants(df, most=most).collect()]
    assert sorted(got, key=text_key) == sorted(spelled(counts), key=text_key)
    assert spelling.variants(df.limit(0)).count() == 0


def test_words_and_altered_runs(spark):
    rng = random.Random(5)
    vocabulary = ["Letters", "ÀÉîôÿßx", "shorty", "tiny", "WORDED×÷", "anothér"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "1", "\n"]) for _ in range(200)) for _ in range(30)] + [None, "", "   ", "q" * 300_000]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(1, texts[1])]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            code = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if code % 199 == 0:
                run = run[:code % len(run)] + run[code % len(run) + 1:]
            if len(run) >= 6:
                want[run] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit(1))
    got = {r.word: r.n for r in spelling.word_counts(df, altered=spelling.without_one).collect()}
    assert got == {w: n for w, n in want.items() if n >= 5}


# ---- substrings -------------------------------------------------------------------------------------------

def test_matching_statistics():
    rng = np.random.default_rng(3)
    for _ in range(60):
        size, cap, strings = int(rng.choice([1, 2, 3, 8, 40])), int(rng.choice([2, 3, 5, 35])), int(rng.integers(1, 12))
        text = [rng.integers(0, size, int(rng.integers(1, 20))) for _ in range(strings)]
        weights = rng.integers(1, 3, strings)
        index = fm_index.FMIndex(np.concatenate(text), np.array([len(s) for s in text]), weights, cap)
        asked = [rng.integers(-1, size + 1, int(rng.integers(1, 25))) for _ in range(6)] + text
        got = index.matching_statistics(np.concatenate(asked), np.array([len(p) for p in asked]))
        places = Counter()
        for w, s in zip(weights.tolist(), text):
            for i in range(len(s)):
                for j in range(i + 1, min(len(s), i + cap) + 1):
                    places[tuple(s[i:j].tolist())] += w
        want = []
        for p in asked:
            p = p.tolist()
            for i in range(len(p)):
                m = 0
                while m < cap and i + m < len(p) and places[tuple(p[i:i + m + 1])] >= 2:
                    m += 1
                want.append(m)
        assert got.tolist() == want


def repeated(texts, length):
    words = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("max_bucket", [5_000, 2])
def test_substrings_match_python(spark, max_bucket):
    rng = random.Random(9)
    vocabulary = ["a", "b", "ü", "Word", "word", "x" * 50, *[f"w{i}" for i in range(300)]]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, line = some(70), some(36)
    texts = [None, "", " \n\t", "short text", " ".join(some(34)), "one " * 36, "same " * 200, "two words " * 100]
    for i in range(60):
        t = some(rng.choice([20, 100, 300]))
        if i % 2:
            t[10:10] = passage
        if i % 3 == 0:
            t += line
        texts.append(rng.choice([" ", "\n", " \t "]).join(t))
    texts += [texts[10]] * 5 + [" ".join(some(34))] * 3 + [" ".join(some(60)), " ".join(f"u{i % 7919}" for i in range(60_000))]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, _s string").repartition(4)
    out, s = substring_dedup.without_repeats(df, max_bucket=max_bucket)
    assert s != "_s" and "_s" in out.columns
    got = {r.doc_id: (r[s].n_words, r[s].n_removed, r[s].kept) for r in out.collect()}
    want = repeated(texts, 35)
    assert got == dict(enumerate(want))
    spans = {r.doc_id: r[s].spans for r in out.collect()}
    assert all(sum(x.e - x.b for x in spans[i]) == want[i][1] for i in spans)
    digests, s = substring_dedup.without_repeats(df, with_text=False, max_bucket=max_bucket)
    assert {r.doc_id: r[s].kept for r in digests.collect()} == {i: hashlib.sha256(w[2].encode()).hexdigest() for i, w in enumerate(want)}
    assert substring_dedup.without_repeats(df.limit(0))[0].count() == 0


# ---- long texts of the packer -----------------------------------------------------------------------------

def test_packing_takes_texts_that_the_fast_encoder_refuses(spark):
    import tokenizers
    texts = ["a" + " " * 2_000_000 + "b <|endoftext|> c", "\n" * 1_200_000, "x" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    path = tokenizer("byte_bpe_50k.json")
    got = {}
    for r in packing.pieces(df, tokenizer("byte_bpe_50k.tiktoken"), token_pattern(), added=packing.added_tokens(path)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    encode = tokenizers.Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        ids = np.array(encode.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert sorted(got[i]) == [(a, n, c) for a, n, c in sorted(got[i])] and sum(n for _, n, _ in got[i]) == len(ids)
        assert all(zlib.crc32(ids[a:a + n].tobytes()) == c for a, n, c in got[i])


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_substring_dedup", "op13_spelling_variants"])
def test_registered_queries_run(spark, name):
    assert QUERIES[name](spark, SMOKE).count() > 0
