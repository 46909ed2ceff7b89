"""The pipeline against a plain-Python version of its stages, and the registered queries on the smallest tables."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from milesbase.llm.common import staged
from milesbase.llm.plans import ORACLES, QUERIES, token_pattern, tokenizer
from test_free_ops import brute_components, brute_removed
from test_native_ops import base
from tools.oracle_check import digest

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: clean texts, near copies, a shared passage, a boilerplate line, junk, nulls and a clashing column."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    clean = [" ".join(word() for _ in range(40)) for _ in range(60)]
    passage = " ".join(word() for _ in range(60))
    texts = clean + [clean[0], clean[1] + " extra"]
    texts += ["Shared boilerplate line\n" + " ".join(word() for _ in range(30)) for _ in range(20)]
    texts += [" ".join(word() for _ in range(100)) + " " + passage + " " + " ".join(word() for _ in range(100)) for _ in range(3)]
    texts += ["too short", "rep eat " * 50, "", None, "long " + " ".join(word() for _ in range(3000))]
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), "z") for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _s string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages_match_python(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    now = {r[0]: r[1] for r in rows}
    outs = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, path)
        assert docs.columns == columns, name
        docs.write.parquet(f"{path}/stage{k}")
        docs = spark.read.parquet(f"{path}/stage{k}")
        outs.append({r.doc_id: r.text for r in docs.collect()})
    now = {i: t for i, t in now.items() if not base(t)[-1]}  # a holdout of one certifies no cutoff
    assert outs[0] == now
    source = {r[0]: r[3] for r in rows}
    pages, counts = Counter(source[i] for i in now), Counter()
    for i, t in now.items():
        counts.update((source[i], x.strip()) for x in set(t.split("\n")))
    now = {i: "\n".join(x for x in t.split("\n") if not (counts[source[i], x.strip()] >= 3 and counts[source[i], x.strip()] > 0.1 * pages[source[i]]))
           for i, t in now.items()}
    assert outs[1] == now
    now = {i: now[i] for i, _, _, kept in brute_components(list(now.items()), 5) if kept}
    assert outs[2] == now
    gone = brute_removed(list(now.values()))
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in outs[3].items()} == {i: g[3] for i, g in zip(now, gone)}
    assert sum(g[1] > 0 for g in gone) == 3


def test_run_packs_what_the_stages_keep(spark, folder):
    import tiktoken

    from milesbase.llm.bpe import read_ranks
    path, _ = folder
    got = corpus_pipeline.run(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, path), name)
    library = tiktoken.Encoding("own", pat_str=token_pattern(), mergeable_ranks=read_ranks(tokenizer("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {r.doc_id: len(library.encode_ordinary(r.text or "")) + 1 for r in docs.collect()}
    have, fill = Counter(), Counter()
    for r in got:
        have[r.doc_id] += r.length
        fill[r.sequence_id] += r.length
    assert have == want and max(fill.values()) <= 1024


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = QUERIES[name](spark, SMOKE)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want, got = cur.fetchall(), [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(columns, want)[0]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash", "suffix_dedup", "packing"]
