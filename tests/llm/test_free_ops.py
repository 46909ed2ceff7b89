"""Archives, one-bit codes, tokenizing, packing, classifier, MinHash and suffix dedup against brute force."""

import base64
import hashlib
import io
import random
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from milesbase.llm import bpe, hashing, minhash, neighbour_vote, packing, rabitq, suffix_dedup, warc_zip
from milesbase.llm.common import shared_path
from milesbase.llm.plans import QUERIES, token_pattern, tokenizer

SMOKE = "/root/testdata/sf0.001"


# ---- archives ------------------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (4, "line\r\nbreak%0A", "ünï"), (7, "u", None), (8, "u", ""),
            (None, "n", "same"), (3, "again", "same"), (6, "x", "y" * 100_000)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    out_dir = shared_path(spark, "warc-test")
    got = warc_zip.read_archives(warc_zip.write_archives(df, out_dir, max_bytes=300), out_dir, with_payload=True).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        again = i is not None and first[h or ""] < i
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                     first[h or ""] if again else None, u, None if again else data))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url, None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)
    assert len({r.archive for r in got}) > 1
    assert warc_zip.round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_directories(monkeypatch, zip64):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a/däta.bin", b"x" * 50)
        z.writestr("packed", b"y" * 500, zipfile.ZIP_DEFLATED)
        z.writestr("b", b"PK\5\6 inside")
        z.comment = b"note PK\5\6 " + b"0" * 30
    data = f.getvalue()
    assert (b"PK\6\7" in data) == zip64
    members = warc_zip.zip_members(io.BytesIO(data), len(data))
    assert {k: data[a:a + n] for k, (a, n) in members.items()} == {"a/däta.bin": b"x" * 50, "b": b"PK\5\6 inside"}
    with pytest.raises(ValueError):
        warc_zip.zip_members(io.BytesIO(data[:-40]), len(data) - 40)


def test_damaged_payload_is_noticed():
    raw, _ = warc_zip.record_bytes(1, "u", b"payload", None)
    with pytest.raises(ValueError):
        warc_zip.parsed_record(raw.replace(b"payload", b"pAyload"))


# ---- one-bit codes --------------------------------------------------------------------------------------

def test_neighbours_and_edge_cases(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((700, 24)).astype(np.float32)
    x[600:] = x[5]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] * 24), (1003, [1.0, None] * 12), (1004, [1.0] * 3), (None, [1.0] * 24), (1100, [float("inf")] * 24)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    got = rabitq.nearest(df, df.where("vec_id % 100 = 0"), block=128, query_block=3).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == set(range(0, 700, 100))
    hits, y = 0, x.astype(np.float64)
    for q, near in found.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(700), d)).tolist() if i != q][:10]
        assert len(near) == 10 and near == sorted(near, key=lambda z: (z[1], z[0]))
        assert all(abs(s - d[v]) < 1e-9 for v, s in near)
        hits += len({v for v, _ in near} & set(want))
    assert hits >= 0.9 * 70
    few = df.where("vec_id < 4")
    assert rabitq.nearest(few, few.where("vec_id = 0")).count() == 3
    assert rabitq.nearest(df.limit(0), df).count() == 0


def test_ann_never_sends_copied_queries_through_the_driver(spark):
    """Spark sizes the queries before they are copied to the blocks, and broadcast the copies where the queries alone were small."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    out = rabitq.nearest(df, df.where("vec_id % 50 = 0"), k=3, block=20, query_block=4)  # more blocks than shuffle partitions
    y, found = x.astype(np.float64), defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == set(range(0, 600, 50))
    hits = 0
    for q, near in found.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        assert len(near) == 3 and all(abs(s - d[v]) < 1e-12 for v, s in near)  # stored as floats, measured as doubles
        hits += len({v for v, _ in near} & set([i for i in np.argsort(d) if i != q][:3]))
    assert hits >= 33
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    doubles = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert rabitq.nearest(doubles, df.where("vec_id = 0"), k=3, block=20).count() == 3  # queries of another type


def test_ann_measures_a_block_without_copying_its_vectors():
    """Most of a block is within the bound of a one-bit code where vectors point anywhere: measuring them copies no vector for each pair."""
    import tracemalloc
    rng = np.random.default_rng(3)
    x, ids = rng.standard_normal((4096, 64)), np.arange(4096)
    x[4000:] = x[:96]  # copies: ties go to the smaller id
    centre, turn = x.mean(axis=0), rabitq.rotation(64)
    codes = rabitq.encode(x, centre, turn)
    tracemalloc.start()
    try:
        q, v, d = rabitq.search_block(ids, x, *codes, ids[:256], x[:256], centre, turn)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64 << 20
    full = np.sqrt(((x[:256, None] - x[None]) ** 2).sum(axis=2))
    full[np.arange(256), np.arange(256)] = np.inf
    want = np.argsort(full, axis=1, kind="stable")[:, :10]
    assert [len(v[q == i]) for i in range(256)] == [10] * 256
    assert sum(len(np.intersect1d(v[q == i], want[i])) for i in range(256)) >= 0.99 * 2560
    assert np.allclose(d, full[q, v], rtol=1e-12)
    assert v[q == 0][0] == 4000 and d[q == 0][0] == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 64))
    centre, turn = x.mean(axis=0), rabitq.rotation(64)
    codes, norms, inner = rabitq.encode(x, centre, turn)
    guess, low = rabitq.estimates(codes, norms, inner, x[:50], centre, turn, 3.0)
    true = ((x[:50, None] - x[None]) ** 2).sum(axis=2)
    assert (low <= true + 1e-6).mean() > 0.997
    # the estimate of a cosine is unbiased and its error has the deviation that the bound is made of
    y = x - centre
    scale = 2 * np.linalg.norm(y[:50], axis=1)[:, None] * np.linalg.norm(y, axis=1)
    error = (guess - true) / scale
    assert abs(error.mean()) < 0.003
    assert error.std() == pytest.approx((np.sqrt(1 - inner**2) / inner).mean() / np.sqrt(63), rel=0.1)


# ---- tokenizing and packing -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(tokenizer("byte_bpe_50k.tiktoken")), token_pattern())


@pytest.fixture(scope="module")
def library():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=token_pattern(), mergeable_ranks=bpe.read_ranks(tokenizer("byte_bpe_50k.tiktoken")), special_tokens={})


def odd_texts(n=300):
    r = random.Random(3)
    pool = "ab cZé\x1c\x85\xa0\u2003\u3000\n\t\r'stll09²½Ⅷ١漢字😀e\u0301\u200d_-###<|endoftext|>"
    return ["", " ", "a" * 30_000, " " * 5000, "é" * 4000] + ["".join(r.choice(pool) for _ in range(r.randint(0, 80))) for _ in range(n)]


def test_codec_equals_the_library(codec, library):
    for t in odd_texts(2000):
        ids = codec.encode(t)
        assert ids == library.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_perfect_hash_is_minimal():
    keys = [bytes([i % 251, i // 251, i % 7]) for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert [h.get(k) for k in keys] == list(range(5000)) and len(h.keys) == 5000 and None not in h.keys
    assert h.get(b"stranger") == -1 and bpe.PerfectHash([]).get(b"x") == -1


def test_encoded_frames(spark, codec, library):
    rows = [(i, t, "b") for i, t in enumerate(odd_texts(50))] + [(None, None, None), (1, "twice", "b"), (1, "twice", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bpe string")
    got = bpe.encoded(df, codec, digests=True).select("row.doc_id", "row.bpe", F.col("bpe.n_tokens").alias("n"), F.col("bpe.ids_sha256").alias("h"), F.col("bpe.decoded_sha256").alias("d")).collect()
    want = []
    for i, t, b in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, b, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    ids = bpe.encoded(df.select("text"), codec).select("bpe.ids")
    assert sorted(bytes(r[0]) for r in bpe.decoded(ids, codec).collect()) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.encoded(df.limit(0), codec, digests=True).count() == 0


def test_ids_equal_both_libraries(library):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = odd_texts(300)
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == [library.encode_ordinary(x) for x in texts]


@pytest.mark.parametrize("low,high", [(1, 1024), (300, 700), (340, 345), (500, 530), (1, 40), (1024, 1024)])
def test_local_search(low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 800)
    first = packing.best_fit(lengths, 1024)
    bins = packing.pack(lengths, 1024)
    assert sorted(sum(bins, [])) == list(range(800)) and max(lengths[b].sum() for b in bins) <= 1024
    assert -(-lengths.sum() // 1024) <= len(bins) <= len(first)
    if high == 40:
        assert len(bins) == -(-lengths.sum() // 1024)
    assert packing.pack(np.zeros(0, np.int64)) == []


def test_search_beats_best_fit():
    # best fit decreasing opens three bins; exchanging two pieces for one frees the last
    lengths = np.array([6, 5, 3, 3, 2, 1])
    assert len(packing.pack(lengths, 10)) == 2


def test_pairs_are_sought_in_every_bin():
    # the 40 bins of 60 have more room but no pair; 50 goes into the last bin for 21 and 21, which go to two of them
    lengths = np.array([50] + [60] * 40 + [21, 21, 50])
    bins = packing.improve(lengths, [[0], *[[i] for i in range(1, 41)], [41, 42, 43]], 100)
    assert sorted(sum(bins, [])) == list(range(44)) and max(lengths[b].sum() for b in bins) <= 100
    assert len(bins) == 41


def test_packing_keeps_every_token(spark, library):
    texts = [None, "", "word", "long word " * 3000] + odd_texts(60) + ["word"] * 5
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    got = packing.pack_documents(df, tokenizer("byte_bpe_50k.tiktoken"), token_pattern()).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode_ordinary(t or ""), 2], "<u4")
        rows = sorted(by_doc[i if i else None], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(-(-len(ids) // 1024)))
        at = 0
        for r in rows:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack_documents(df.limit(0), tokenizer("byte_bpe_50k.tiktoken"), token_pattern()).count() == 0


def test_full_pieces_are_not_shuffled(spark):
    cut = spark.createDataFrame([(i, 0, 0, 1024 if i % 50 else i + 1, i) for i in range(1000)], packing.PIECES)
    out = packing.packed(cut)
    loose, full = out._jdf.queryExecution().executedPlan().toString().split("\n   +- ", 1)  # the union's two sides
    assert "Exchange" in loose and "LessThan(length,1024)" in loose
    assert "Exchange" not in full and "GreaterThanOrEqual(length,1024)" in full
    rows = out.collect()
    assert len({r.sequence_id for r in rows if r.length == 1024}) == 980 and sorted(r.doc_id for r in rows) == list(range(1000))
    assert min(r.sequence_id for r in rows if r.length == 1024) >= packing.FULL > max(r.sequence_id for r in rows if r.length < 1024)


def test_added_tokens_are_matched_in_texts(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    r = random.Random(6)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n y<|endoftext|><|endoftext|>", "<|<|endoftext|>|>", "<|endoftext|", "w<|endoftext|>" * 900]
    texts += ["<|endoftext|>".join(r.choices(odd_texts(200)[5:], k=3)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack_documents(df, tokenizer("byte_bpe_50k.tiktoken"), token_pattern(), added=packing.added_tokens(tokenizer("byte_bpe_50k.json"))).collect()
    want = []
    for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False)):
        ids = np.array([*e.ids, 2], "<u4")
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(tuple(x)[:5] for x in got) == want


def test_queries_pack_with_added_tokens(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crc = zlib.crc32(np.array([64, 220, 50256, 275, 2], "<u4").tobytes())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (QUERIES["op5_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, docs, str(tmp_path))):
        assert [(x.length, x.ids_crc32) for x in out.collect()] == [(5, crc)]


# ---- classifier -----------------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op4_neighbour_vote"](spark, sf)
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95 and auc > 0.95
    assert out.where("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(i, ("### $$$ " if i % 2 else "plain words here ") * (i % 5 + 1), "s") for i in range(40)]
                                 + [(50, None, "s"), (51, "", "s"), (None, "plain words", "s"), (3, "### $$$", "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(20)] + [(None, 1), (5, None), (7, 0), (7, 1)], "doc_id long, quality int")
    model = neighbour_vote.train(docs, labels)
    got = [(r.doc_id, r.score) for r in neighbour_vote.scored(docs, model).collect()]
    assert len(got) == 44
    assert all((s > 0.5) == (i % 2 == 0) for i, s in got if i is not None and i < 40)
    assert {s for i, s in got if i in (50, 51)} == {model["share"]}
    assert {r.score for r in neighbour_vote.scored(docs, neighbour_vote.train(docs, labels.limit(0))).collect()} == {0.5}
    assert neighbour_vote.scored(docs.limit(0), model).count() == 0


def test_votes_are_exact():
    rng = np.random.default_rng(2)
    x = np.abs(rng.standard_normal((300, neighbour_vote.TERMS))).astype(np.float32)
    y = (rng.random(300) > 0.3).astype(int)
    model = neighbour_vote.fit(x, y, y.mean())
    got = neighbour_vote.vote(model, x[:20], neighbours=7, power=2, block=6)
    z = (x[:20] * model["idf"]) @ model["turn"]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    for i in range(20):
        c = model["vectors"] @ z[i]
        near = np.argsort(-c)[:7]
        w = np.maximum(c[near], 0).astype(float) ** 2
        assert got[i] == pytest.approx((w * y[near]).sum() / w.sum(), abs=1e-5)


# ---- MinHash --------------------------------------------------------------------------------------------

def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)])


def brute_components(rows, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i), True if i is None else find(i) == i) for i, s in sets]


def near_corpus(seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0

    def add(t):
        nonlocal n
        rows.append((n, t))
        n += 1

    for _ in range(60):
        add(" ".join(r.choices(vocab, k=r.randint(1, 60))))
    for _ in range(6):  # chains and families of near copies
        words = r.choices(vocab, k=r.randint(12, 80))
        for _ in range(25):
            add(" ".join(words))
            words = list(words)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = r.choice(vocab)
    for t in ("", None, "  \n", "ONE", "one", "ÉÀ é", "Éà é", "two words", "TWO\twords"):
        add(t)
    rows += [(3, "same id other text"), (None, "null id"), (None, rows[0][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(spark, size):
    rows = near_corpus(size)
    df = spark.createDataFrame([(*x, "x") for x in rows], "doc_id long, text string, id string")
    got = [(r.id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, size=size).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_components(rows, size)))
    left = minhash.drop_near_duplicates(df, size=size)
    assert left.columns == df.columns
    assert left.count() == sum(k for *_, k in brute_components(rows, size))
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_stars_lose_no_link_between_leaves(spark, monkeypatch):
    """All in one bucket, the star linked with nobody: the rest must still find each other."""
    monkeypatch.setattr(minhash, "band_keys", lambda sig, bands, rows: np.ones((len(sig), bands), np.uint64))
    rows = [(0, "a b c d e f g h")] + [(i, " ".join(f"x{j}" for j in range(20)) + f" t{i}") for i in range(1, 6)] + [(9, " ".join(f"x{j}" for j in range(20)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, size=2).collect()]
    assert sorted(got) == sorted(brute_components(rows, 2))


def test_texts_of_one_id_add_up(spark):
    text = lambda c, n=20: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, text("a")), (1, text("b")), (2, text("a") + " x"), (3, text("b") + " y"), (4, text("c")), (4, text("d")), (5, text("e")), (5, text("d") + " z"),
            (6, text("e") + " w"), (6, ""), (0, text("f")), (7, text("f")), (7, text("c") + " v"), (8, ""), (8, None), (9, text("g")), (9, text("h"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, size=2).collect()]
    want = brute_components(rows, 2)
    assert sorted(got) == sorted(want) and {(i, c) for i, _, c, _ in want} == {(1, 1), (2, 1), (3, 1), (0, 0), (4, 0), (5, 0), (6, 0), (7, 0), (8, 8), (9, 9)}


def test_path_and_star_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(500, 300), (300, 400)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 300: 300, 400: 300, 500: 300}


def test_signature_collisions_estimate_similarity():
    r = np.random.default_rng(6)
    a = np.sort(r.integers(0, 2**63, 400, dtype=np.uint64))
    for share in (0.5, 0.8, 0.95):
        keep = int(400 * 2 * share / (1 + share))
        b = np.sort(np.concatenate([r.permutation(a)[:keep], r.integers(0, 2**63, 400 - keep, dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = minhash.densified(np.concatenate([np.sort(hashing.mixed(a)), np.sort(hashing.mixed(b))]), np.array([400, 400]), 160)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.15
    tiny = minhash.densified(np.array([7], np.uint64), np.array([1]), 160)
    assert (tiny == 7).all()


# ---- suffix dedup ---------------------------------------------------------------------------------------

def brute_removed(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_corpus(seed=8):
    r = random.Random(seed)

    def prose(n):
        return "".join(r.choice("abcdé \n\0") for _ in range(n))

    passage, exact, short = prose(700), prose(200), prose(199)
    exact = exact.encode()[:200].decode("utf-8", "ignore")
    texts = [None, "", "x", prose(150), "z" * 1000, "ab" * 400, prose(3000)]
    for _ in range(12):
        texts.append(prose(r.randint(0, 400)) + passage[r.randint(0, 300):r.randint(350, 700)] + prose(r.randint(0, 400)))
    for _ in range(4):
        texts.append(prose(r.randint(0, 50)) + "ascii only: " + "q".join(map(str, range(100)))[:200] + prose(30))
        texts.append(prose(40) + short + prose(40))
        texts.append(exact)
    texts += [texts[6]] * 3 + [prose(500) * 2]
    return texts


@pytest.mark.parametrize("max_bucket", [suffix_dedup.MAX_BUCKET, 1])
def test_removed_bytes_match_brute_force(spark, max_bucket):
    texts = repeat_corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _s string")
    out, s = suffix_dedup.without_repeats(df, max_bucket=max_bucket, task_rows=50)
    got = {r["doc_id"]: r for r in out.collect()}
    want = brute_removed(texts)
    for i, w in enumerate(want):
        r = got[i][s]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == w, i
        if r["n_removed"]:
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == w[3]
            assert r["kept_text"] == bytes(r["kept"]).decode("utf-8", "ignore")
        else:
            assert r["kept_text"] == texts[i]
    assert suffix_dedup.without_repeats(df.limit(0))[0].count() == 0


def test_rounds_give_bwt_and_common_prefixes():
    r = random.Random(9)
    rows = ["".join(r.choice("ab") for _ in range(30)).encode() for _ in range(40)] + [b"a" * 30] * 3
    file = suffix_dedup.ColumnFile(rows, np.zeros(len(rows), int), 30)
    for c, bwt, order, common in suffix_dedup.rounds(file, 12):
        suffixes = [rows[i][c:] for i in order]
        assert suffixes == sorted(x[c:] for x in rows)
        assert sorted(bwt.tolist()) == sorted(x[c] for x in rows)
        for a, b, n in zip(suffixes, suffixes[1:], common[1:].tolist()):
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
            assert n == min(same, 12)
    file.close()


def test_windows_name_one_anchor():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[3000:3400] = data[500:900]
    row, h, place, first, last = suffix_dedup.anchors(data, np.array([0, 2000, 2000, 2100, 5000]))
    sizes = [2000, 0, 100, 2900]
    for k in range(4):
        starts = sorted(s for r, a, b in zip(row, first, last) if r == k for s in range(a, b + 1))
        assert starts == list(range(max(0, sizes[k] - 199)))
    assert ((place - first >= 0) & (place - first <= 136) & (place >= last)).all()


def test_batches_of_sliced_columns():
    column = pa.array(["a b", None, "", "c  d e", "f"]).slice(1, 4)
    parts = list(hashing.text_slices(column, max_bytes=3))
    assert [(i, j) for i, j, *_ in parts][-1][1] == 4
    words = [hashing.word_hashes(data, offsets)[1].tolist() for _, _, data, offsets in parts]
    assert sum(words, []) == [0, 0, 3, 1]


def test_residue_pairs_miss_no_link(spark):
    """Near copies around a base: every linked pair of different components is a candidate, and few others are."""
    rng = random.Random(11)
    base = list(range(120))
    rows, members = [], []
    for i in range(160):
        edits = rng.choice([1, 3, 8, 14, 18])
        items = set(base) - set(rng.sample(base, edits)) | {1000 + (rng.randrange(40) if rng.random() < 0.4 else 50 * i + j) for j in range(edits)}
        rows.append((i, sorted(items)))
        members.append((7, i, 0 if edits < 10 else i, edits < 10))
    sets = spark.createDataFrame(rows, "rep long, items array<long>")
    got = {(r.a, r.b) for r in minhash.residue_pairs(spark.createDataFrame(members, "g long, rep long, root long, inside boolean"), sets, 80).collect()}
    want = set()
    for i, a in rows:
        for j, b in rows[i + 1:]:
            both = len(set(a) & set(b))
            if members[i][2] != members[j][2] and 100 * both >= 80 * (len(a) + len(b) - both):
                want.add((i, j))
    roots = {i: m[2] for i, m in enumerate(members)}

    def joined(pairs):
        top = dict(roots)
        find = lambda x: x if top.get(x, x) == x else find(top[x])
        for a, b in sorted(pairs):
            top[find(roots[a])] = find(roots[b])
        return {frozenset(x for x in range(160) if find(roots[x]) == find(roots[y])) for y in range(160)}

    sets_of = {i: set(x) for i, x in rows}
    linked = {(a, b) for a, b in got if 100 * len(sets_of[a] & sets_of[b]) >= 80 * len(sets_of[a] | sets_of[b])}
    assert want and joined(want) == joined(linked)
    assert len(got) < 160 * 159 / 2 / 2
