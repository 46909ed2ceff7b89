"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milesbase.llm import bpe, line_dedup, merkle, minhash, neighbour_vote, packing, quality_rules, rabitq, spelling, substring_dedup, suffix_dedup, url_filter, warc_zip
from milesbase.llm.common import read_table, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def token_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@_query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk-controlled quality rules: statistics and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    stats, s = quality_rules.text_stats(docs)
    # the statistics serve both the holdout test and the verdict
    stats = staged(stats.drop("text"), "op1-stats")
    out, s = quality_rules.judged(stats, read_table(spark, sf_dir, "labels"), stats=(stats, s))
    q = F.col(s)
    return out.select("doc_id", *[q[k].alias(k) for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        F.array_join(q["reasons"], ",").alias("reasons"))


@_query("op3_line_dedup", """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM lines),
pages AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
boiler AS (
  SELECT source, b FROM (SELECT DISTINCT doc_id, source, b FROM bare WHERE b <> '') JOIN pages USING (source)
  GROUP BY source, b, pages HAVING count(*) >= 3 AND count(*) > 0.1 * pages),
marked AS (SELECT bare.*, boiler.b IS NOT NULL AS dropped FROM bare LEFT JOIN boiler USING (source, b))
SELECT d.doc_id, d.source, CAST(coalesce(m.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(m.n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped) AS text
  FROM marked GROUP BY doc_id) m USING (doc_id)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-relative line dedup of every document (host: its source)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out, s = line_dedup.line_dedup(docs)
    return out.select("doc_id", "source", F.col(s)["n_lines"].alias("n_lines"), F.col(s)["n_dropped"].alias("n_dropped"), "text")


@_query("op6_warc_zip")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to ZIP-packaged WARC archives and read back by range."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc_zip.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op7_url_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and path rules, else the character language-model ratio, for every page's URL."""
    out, s = url_filter.url_verdicts(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", *[F.col(s)[k].alias(k) for k in ("host", "path", "rule", "score", "verdict")])


@_query("op2_one_bit_ann", """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector, found through one-bit codes."""
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rabitq.nearest(table, table.where("vec_id % 100 = 0"))


@_query("op4_neighbour_vote")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by its labelled neighbours; a third of the ids is held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = read_table(spark, sf_dir, "labels").where(~held).select("doc_id", "quality")
    out = neighbour_vote.scored(docs, neighbour_vote.train(docs, labels))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.tiktoken"), token_pattern(), added=packing.added_tokens(tokenizer("byte_bpe_50k.json")))


@_query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to byte-level BPE ids and decoded again."""
    codec = bpe.Codec(bpe.read_ranks(tokenizer("byte_bpe_50k.tiktoken")), token_pattern())
    out = bpe.encoded(read_table(spark, sf_dir, "documents").select("doc_id", "text"), codec, digests=True)
    return out.select("row.doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


@_query("op9_minhash", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x) USING (doc_id)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, size=2).withColumnRenamed("id", "doc_id")


@_query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside 200-byte strings that occur anywhere else too."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out, s = suffix_dedup.without_repeats(docs, with_kept=False)
    return out.select("doc_id", *[F.col(s)[k].alias(k) for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


#: The byte table of CRC-32, made from its polynomial; a column ``t``.
CRC_TABLE = """SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM range(256) r(i))"""


@_query("op11_merkle_manifest", f"""
WITH RECURSIVE tab AS ({CRC_TABLE}),
input AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, tab),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN crc % 2 = 0 THEN coalesce(strlen(cut) || ':' || cut, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS tampered
  FROM (SELECT *, replace(text, chr(10), '') AS cut,
               coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM input)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY source) AS n FROM hashed),
sub(source, level, pos, n, h) AS (
  SELECT source, 0, pos, n, leaf FROM leaves UNION ALL
  SELECT source, level + 1, pos // 3, (min(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM sub WHERE n > 1 GROUP BY source, level, pos // 3),
subroots AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM sub WHERE n = 1),
top(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subroots UNION ALL
  SELECT level + 1, pos // 3, (min(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3),
near AS (
  SELECT a.source, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM sub a JOIN sub b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.source, a.level, a.pos),
near_top AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM top a JOIN top b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.level, a.pos),
climb(source, pos0, level, pos, f, proof) AS (
  SELECT source, pos, 0, pos, tampered, '' FROM leaves UNION ALL
  SELECT c.source, pos0, c.level + 1, c.pos // 3, sha256(l || f || r), proof || l || r
  FROM climb c JOIN near x ON c.source IS NOT DISTINCT FROM x.source AND c.level = x.level AND c.pos = x.pos),
arrived AS (SELECT source, pos0, f, proof FROM climb QUALIFY row_number() OVER (PARTITION BY source, pos0 ORDER BY level DESC) = 1),
climb_top(source, pos0, level, pos, f, proof) AS (
  SELECT a.source, pos0, 0, s.pos, f, proof FROM arrived a JOIN subroots s ON a.source IS NOT DISTINCT FROM s.source UNION ALL
  SELECT source, pos0, c.level + 1, c.pos // 3, sha256(l || f || r), proof || l || r FROM climb_top c JOIN near_top x ON c.level = x.level AND c.pos = x.pos),
done AS (SELECT source, pos0, f, proof FROM climb_top QUALIFY row_number() OVER (PARTITION BY source, pos0 ORDER BY level DESC) = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM leaves v JOIN done d ON v.source IS NOT DISTINCT FROM d.source AND v.pos = d.pos0
JOIN subroots s ON v.source IS NOT DISTINCT FROM s.source, (SELECT h AS root FROM top WHERE n = 1)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, climbed from every leaf after half of the texts lost their line ends."""
    docs = read_table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(docs, tampered=cut)[0]


@_query("op12_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
hits AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM hits) GROUP BY doc_id),
bits AS (SELECT doc_id, list_distinct(gone) AS gone FROM gone),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n FROM (
    SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM words) v
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id AS d, unnest(gone) AS g FROM bits) WHERE d = v.doc_id AND g = v.j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 35-word windows that occur anywhere else too."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out, s = substring_dedup.without_repeats(docs, with_text=False)
    return out.select("doc_id", F.col(s)["n_words"].alias("n_words"), F.col(s)["n_removed"].alias("n_removed"), F.col(s)["kept"].alias("kept_sha256"))


@_query("op13_spelling_variants", rf"""
WITH RECURSIVE tab AS ({CRC_TABLE}),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents) WHERE length(run) >= 6 GROUP BY doc_id, run),
coded AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(key)), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, k, doc_id || ':' || run AS key, hex(encode(doc_id || ':' || run)) AS hx FROM runs), tab),
words AS (
  SELECT w, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS w FROM coded)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(k) >= 5),
less AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS s FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.w, b.w AS v, b.n AS m FROM less a JOIN less b ON a.s = b.s AND a.i = b.i AND a.w <> b.w
  UNION SELECT a.w, b.w, b.n FROM less a JOIN words b ON a.s = b.w
  UNION SELECT b.w, a.w, a.n FROM less a JOIN words b ON a.s = b.w),
best AS (SELECT w, count(*) AS n_near, arg_min(v, (-m, v)) AS v, max(m) AS m FROM near GROUP BY w),
forms AS (
  SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN v END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (w)),
chain(w, top) AS (SELECT w, form FROM forms WHERE form IS NOT NULL UNION ALL SELECT c.w, f.form FROM chain c JOIN forms f ON c.top = f.w WHERE f.form IS NOT NULL),
ends AS (SELECT c.w, c.top FROM chain c JOIN forms f ON c.top = f.w WHERE f.form IS NULL)
SELECT w AS word, form, coalesce(top, w) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (w)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, each with its near words, most frequent form and root."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs, altered=spelling.without_one))
