"""Substring dedup on words: remove every word covered by a window of 35 words that starts anywhere else too.

1. *Classes.* Equal texts are one class with a count; if it is two or more, all windows of the class repeat.
2. *Anchors.* Each window names the place of its smallest hash of ``GRAM`` words (leftmost of equals), so equal windows name equal
   anchors at equal distances. Only anchors that occur twice can belong to a repeated window. This loses nothing.
3. *Segments.* The windows that name one anchor lie side by side; their words form a segment. Equal segments become one with a
   count by partial aggregation of their hashes (128 bits with the anchor's) before any words move.
4. *Shards.* Segments are dealt to shards by anchor. A shard builds a compressed FM-index (BWT in a wavelet tree) of its segments
   and streams them through it by backward search. Matching statistics say how long a match that occurs twice starts at each word;
   places with at least a window's length are reported as intervals.
5. *Hot anchors.* An anchor of more than ``MAX_BUCKET`` different segments is not sent to one shard: its windows are hashed (128
   bits) and counted with partial sums, and only one copy of each repeated window, with its count, goes to a shard of its own
   hash. The result is the same for any size of a bucket.
6. Intervals return to the texts that hold the segments, are united and cut out.

Scale: shards hold about ``TASK_ROWS`` different segments of at most 62 words (8 bytes each). Texts are read again rather than carried
along with their anchors. Words are compared as 64-bit hashes, in windows of 35 at a time.

Edge cases: null, empty and blank texts have no words; texts of fewer than 35 words are never touched; texts of any length are processed
whole; repeated rows of any id repeat each other, so all words of both go (from 35 words on); an empty table gives an empty
result; other columns are kept, and new names avoid theirs.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import free_name, prepare, staged, words_of
from milesbase.llm.fm_index import FMIndex
from milesbase.llm.hashing import U, mixed, stream, text_slices, word_hashes
from milesbase.llm.suffix_dedup import window_minima

LENGTH = 35
GRAM = 8
MAX_BUCKET = 10_000
TASK_ROWS = 30_000
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


# ---- anchors and windows -----------------------------------------------------------------------------

def runs_hash(words: np.ndarray, size: int, seed: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``size`` words from each place on (all places, or ``at``)."""
    n = len(words) - size + 1
    weights = stream(size, seed) | U(1)
    h = np.zeros(n if at is None else len(at), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(size):
            h += (words[t:t + n] if at is None else words[at + t]) * weights[t]
    return mixed(h)


def anchors(words: np.ndarray, per_row: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """For the windows of ``length`` words inside rows: row, anchor hash, anchor place, and the first and last start of the windows
    that name it (places within the row)."""
    none = np.zeros(0, np.int64)
    if len(words) < length:
        return none, none.astype(np.uint64), none, none, none
    h = runs_hash(words, gram, 151)
    least = window_minima((h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    ends = np.cumsum(per_row)
    row_of = np.repeat(np.arange(len(per_row)), per_row)[:len(least)]
    starts = np.arange(len(least))
    ok = starts + length <= ends[row_of]
    starts, row_of, place = starts[ok], row_of[ok], (least[ok] & U(0xFFFFFFFF)).astype(np.int64)
    if not len(starts):
        return none, none.astype(np.uint64), none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row_of[1:] != row_of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    row = row_of[first]
    base = (ends - per_row)[row]
    return row, h[place[first]], place[first] - base, starts[first] - base, starts[last] - base


def spans_hash(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words of each span, of any length: a polynomial over word hashes, from running sums."""
    base = U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.append(U(1), np.full(len(words), base)))
        sums = np.append(U(0), np.cumsum(mixed(words) * up[:-1]))
        down = np.cumprod(np.append(U(1), np.full(len(words), U(pow(int(base), -1, 1 << 64)))))
        return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """rep, text -> rep, gram, seg (hash of the segment), spot (first start << 8 | starts - 1)."""
    def run(batches):
        for batch in batches:
            for i, _j, data, offsets in text_slices(batch.column(1)):
                words, per_row = word_hashes(data, offsets, lower=False)
                row, h, _place, first, last = anchors(words, per_row, length)
                base = (np.cumsum(per_row) - per_row)[row]
                seg = spans_hash(words, base + first, base + last + length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + i)), pa.array(h.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(first << 8 | last - first)],
                    names=["rep", "gram", "seg", "spot"])

    return texts.mapInArrow(run, "rep bigint, gram bigint, seg bigint, spot bigint")


def _hashed(batch, text: str = "text"):
    """Row number and word hashes of each text of a batch."""
    column = batch.column(text)
    for i, j, data, offsets in text_slices(column):
        words, per_row = word_hashes(data, offsets, lower=False)
        ends = np.cumsum(per_row)
        for k in range(i, j):
            yield k, words[ends[k - i] - per_row[k - i]:ends[k - i]]


# ---- shards ------------------------------------------------------------------------------------------

SEGMENTS = "bucket bigint, seg bigint, words binary, weight bigint"


def repeated_starts(segments: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of windows that occur twice or more in the segments (as often as their weights): segment, first, last."""
    lengths = np.array([len(s) // 8 for s in segments])
    _, symbols = np.unique(np.frombuffer(b"".join(segments), np.uint64), return_inverse=True)
    index = FMIndex(symbols, lengths, weights, length)
    long = index.matching_statistics(symbols, lengths) >= length
    owner = np.repeat(np.arange(len(segments)), lengths)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before = np.concatenate([[False], long[:-1]]) & (place > 0)
    after = np.concatenate([long[1:], [False]])  # no window starts at a segment's last word
    return owner[long & ~before], place[long & ~before], place[long & ~after]


def _reported(segments: DataFrame, tasks: int, length: int) -> DataFrame:
    """Segments dealt by bucket -> bucket, seg, b, e: words of the segment covered by repeated windows."""
    def run(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        seg, first, last = repeated_starts(table.column("words").to_pylist(), table.column("weight").to_numpy(), length)
        for i in range(0, len(seg), 100_000):
            k = slice(i, i + 100_000)
            own = table.select(["bucket", "seg"]).take(pa.array(seg[k])).combine_chunks()
            yield pa.RecordBatch.from_arrays([own.column(0).combine_chunks(), own.column(1).combine_chunks(), pa.array(first[k]), pa.array(last[k] + length)],
                                             names=["bucket", "seg", "b", "e"])

    return segments.repartition(tasks, "bucket").mapInArrow(run, "bucket bigint, seg bigint, b bigint, e bigint")


def _segments(found: DataFrame, length: int) -> DataFrame:
    """rep, text, picks (bucket, seg, first, last, n) -> segments."""
    def run(batches):
        for batch in batches:
            rows, picks = [], batch.column("picks")
            for k, words in _hashed(batch):
                rows += [(s["bucket"], s["seg"], words[s["first"]:s["last"] + length].tobytes(), s["n"]) for s in picks[k].as_py()]
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return found.mapInArrow(run, SEGMENTS)


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["bucket", "seg", "words", "weight"])


def _windows(found: DataFrame, length: int) -> DataFrame:
    """rep, text, picks -> bucket, seg, rep, start, off (start within the segment), n, w1, w2 (hashes) of every window of the picks."""
    names = ["bucket", "seg", "rep", "start", "off", "n", "w1", "w2"]

    def run(batches):
        for batch in batches:
            reps, picks = batch.column("rep").to_pylist(), batch.column("picks")
            for k, words in _hashed(batch):
                mine = picks[k].as_py()
                many = [s["last"] - s["first"] + 1 for s in mine]
                at = np.concatenate([np.arange(s["first"], s["last"] + 1) for s in mine])
                cols = [np.repeat(np.array([s[c] for s in mine], np.int64), many) for c in ("bucket", "seg", "first", "n")]
                w1, w2 = (runs_hash(words, length, seed, at).view(np.int64) for seed in (163, 167))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cols[0], cols[1], np.full(len(at), reps[k]), at, at - cols[2], cols[3], w1, w2)], names=names)

    return found.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _with_texts(classes: DataFrame, picked: DataFrame) -> DataFrame:
    """Picks (rep, bucket, seg, first, last, n) gathered by text."""
    picks = picked.groupBy("rep").agg(F.collect_list(F.struct("bucket", "seg", "first", "last", "n")).alias("picks"))
    return classes.select("rep", "text").join(picks, "rep")


def _hot_marks(classes: DataFrame, segs: DataFrame, length: int) -> DataFrame:
    """bucket, seg, b, e of the repeated windows of hot anchors' segments."""
    windows = staged(_windows(_with_texts(classes, segs), length), "substring-windows")
    again = (windows.groupBy("w1", "w2").agg(F.sum("n").alias("n"), F.min(F.struct("rep", "start")).alias("one")).where("n > 1")
             .select(F.col("one.rep").alias("rep"), F.col("w1").alias("bucket"), F.col("w2").alias("seg"),
                     F.col("one.start").alias("first"), F.col("one.start").alias("last"), "n"))
    again = staged(again, "substring-again")
    real = staged(_reported(_segments(_with_texts(classes, again), length), _tasks(again.count()), length), "substring-real")
    real = real.select(F.col("bucket").alias("w1"), F.col("seg").alias("w2"))
    return windows.join(real, ["w1", "w2"]).select("bucket", "seg", F.col("off").alias("b"), (F.col("off") + length).alias("e"))


def repeated_spans(classes: DataFrame, length: int = LENGTH, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """classes: rep, text, each text once -> rep, spans (array of b, e, sorted): words covered by windows that occur twice in them."""
    spots = staged(_anchor_rows(classes.select("rep", "text"), length), "substring-anchors")
    twice = staged(spots.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram"), "substring-grams")
    hits = staged(spots.join(twice, "gram"), "substring-hits")
    segs = hits.groupBy("gram", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rep", "spot")).alias("one"))
    first = F.shiftright("one.spot", 8)
    segs = staged(segs.select(F.col("one.rep").alias("rep"), F.col("gram").alias("bucket"), "seg", first.alias("first"),
                              (first + F.col("one.spot").bitwiseAND(F.lit(255))).alias("last"), "n"), "substring-segments")
    hot = staged(segs.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > max_bucket).select("bucket"), "substring-hot")
    mild, split = segs, not hot.isEmpty()
    if split:  # at most one hot anchor for each max_bucket segments
        mild = segs.join(hot, "bucket", "left_anti")
    marks = _reported(_segments(_with_texts(classes, mild), length), _tasks(segs.count()), length)
    if split:
        marks = marks.union(_hot_marks(classes, segs.join(hot, "bucket", "left_semi"), length))
    marks = staged(marks.withColumnRenamed("bucket", "gram"), "substring-marks")
    begin = F.shiftright("spot", 8)
    spans = hits.join(marks, ["gram", "seg"]).select("rep", F.struct((begin + F.col("b")).alias("b"), (begin + F.col("e")).alias("e")).alias("x"))
    return spans.groupBy("rep").agg(F.array_sort(F.collect_set("x")).alias("spans"))


# ---- texts -------------------------------------------------------------------------------------------

def _cut(found: DataFrame, with_text: bool) -> DataFrame:
    """k1, k2, copies, text, spans -> k1, k2, copies, n_removed, spans (united), kept (text, or its SHA-256)."""
    import hashlib
    fields = "k1 bigint, k2 bigint, copies bigint, n_removed bigint, spans array<struct<b: bigint, e: bigint>>, kept string"

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                words, joint, kept, at = WORDS.findall(text.as_py().encode()), [], [], 0
                for s in spans.as_py():
                    if joint and s["b"] <= joint[-1]["e"]:
                        joint[-1]["e"] = max(joint[-1]["e"], s["e"])
                    else:
                        joint.append(dict(s))
                for s in joint:
                    kept += words[at:s["b"]]
                    at = s["e"]
                kept += words[at:]
                rest = b" ".join(kept)
                out.append((len(words) - len(kept), joint, rest.decode() if with_text else hashlib.sha256(rest).hexdigest()))
            n, spans, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in ("k1", "k2", "copies")], pa.array(n, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())]))), pa.array(kept, pa.string())],
                names=["k1", "k2", "copies", "n_removed", "spans", "kept"])

    return found.select("k1", "k2", "copies", "text", "spans").mapInArrow(run, fields)


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, with_text: bool = True, **kw) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned): n_words, n_removed, spans (words removed: array of b, e) and kept, the other
    words joined by a space; or, without ``with_text``, kept is the SHA-256 of that and the text column goes."""
    prepare(docs.sparkSession)
    s, a, b = (free_name(docs, x) for x in ("_s", "_s_k1", "_s_k2"))
    text = F.col(f"`{text_col}`")
    enough = F.octet_length(text) >= 2 * length - 1  # shorter texts can't hold a window
    keys = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    classes = (docs.where(enough).select(*[k.alias(n) for k, n in zip(keys, ("k1", "k2"))], text.alias("text"))
               .groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()), "substring-classes")  # numbers fixed by being written
    spans = repeated_spans(classes, length, **kw)
    cut = _cut(classes.where("copies = 1").join(spans, "rep"), with_text)
    # copies are removed whole, each word of them: a window's length is looked for in the texts themselves
    whole = classes.where("copies > 1").select("k1", "k2", "copies", F.lit(None).cast("bigint").alias("n_removed"),
                                               F.lit(None).cast("array<struct<b: bigint, e: bigint>>").alias("spans"), F.lit(None).cast("string").alias("kept"))
    cut = staged(cut.union(whole), "substring-cut").select(F.col("k1").alias(a), F.col("k2").alias(b), F.struct("copies", "n_removed", "spans", "kept").alias(a + "_cut"))

    bare = free_name(docs, "_words")
    out = docs.withColumn(bare, words_of(text))
    kept = F.array_join(F.col(bare), " ")
    # texts without a window meet nothing, each under a key of its own
    k1 = F.when(enough, keys[0]).otherwise(F.monotonically_increasing_id())
    k2 = F.when(enough, keys[1]).otherwise(F.lit(0).cast("bigint"))
    out = out.withColumn(s, F.struct(F.size(bare).cast("bigint").alias("n"), (kept if with_text else F.sha2(kept.cast("binary"), 256)).alias("kept"),
                                     k1.alias("k1"), k2.alias("k2"))).drop(bare)
    if not with_text:
        out = out.drop(text_col)
    me, c = F.col(s), F.col(a + "_cut")
    out = out.join(cut, (me["k1"] == F.col(a)) & (me["k2"] == F.col(b)), "left")
    gone = (c["copies"] > 1) & (me["n"] >= length)
    nothing = F.lit("") if with_text else F.sha2(F.lit(b""), 256)
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<struct<b: bigint, e: bigint>>")
    fields = [me["n"].alias("n_words"), F.when(gone, me["n"]).otherwise(F.coalesce(c["n_removed"], zero)).alias("n_removed"),
              F.when(gone, F.array(F.struct(zero.alias("b"), me["n"].alias("e")))).otherwise(F.coalesce(c["spans"], none)).alias("spans"),
              F.when(gone, nothing).otherwise(F.coalesce(c["kept"], me["kept"])).alias("kept")]
    return out.withColumn(s, F.struct(*fields)).drop(a, b, a + "_cut"), s
