"""Suffix-array dedup: remove every byte covered by a 200-byte string that starts anywhere else too.

Column-wise construction over many documents (BWT and common prefixes, one symbol per document and round):

1. *Anchors.* Each 200-byte window names the position of its smallest 64-byte hash (leftmost of
   equals), so equal windows name equal anchors at equal distances. Only anchors whose hash
   occurs twice can belong to a repeated window; the others are dropped. This loses nothing.
2. *Segments.* The windows that name one anchor lie side by side; their bytes form one segment, placed
   so that all anchors of a bucket stand in one column. Repeated windows are thus equal strings that
   start in the same column of the same bucket, so rows of different columns never need comparing.
3. *Rounds.* From the last column to the first, each round inserts one symbol of every segment of the
   task: a stable sort by that symbol turns the order of the suffixes one column shorter into the new
   order (the inserted symbols in the old order are that column of the Burrows-Wheeler transform),
   and the common prefix of neighbours becomes one more than the least one between their old places.
   Columns are read in sequence from an external file, and only the current order is in memory.
   Runs of neighbours with 200 common bytes and two occurrences or more mark their start column.
4. Marked starts return to their documents as byte intervals, which are united and cut out.

Scale: equal texts are one class with a count before segments are made; equal segments are summed before their
shuffle. Grams that occur again are written before they meet the anchors, so a hot gram's join is broadcast or split.
A bucket larger than ``max_bucket`` is split by content: windows are grouped by eight neighbouring columns
and keyed by the 193 bytes that every window of such a group covers, which is exact for any size.
Tasks hold about ``task_rows`` segments.

Edge cases: null text is empty; texts under 200 bytes are never touched; bytes are judged on the input, not on
what is left, so a cut may split a UTF-8 character: ``kept`` is bytes. Empty tables give empty results; repeated
rows (of any id) repeat each other.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import free_name, prepare, staged
from milesbase.llm.hashing import U, mixed, stream, text_slices

LENGTH = 200
GRAM = 64
GROUP = 8
MAX_BUCKET = 100_000
TASK_ROWS = 60_000


# ---- anchors ------------------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place that has as many: of 8 bytes first, then of twice as many each time."""
    buf = np.ascontiguousarray(data)
    h = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,)).copy()
    width = 8
    with np.errstate(over="ignore"):
        for k in stream(3, 131) | U(1):
            h *= k
            h ^= h >> U(29)
            h = h[:-width] * (k ^ U(0x5851F42D4C957F2C)) + h[width:]
            width *= 2
    return mixed(h)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    n = len(keys)
    pad = -n % width
    full = np.append(keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """For the windows of ``length`` bytes inside rows: row, anchor hash, anchor place and the first and last
    start of the windows that name it (places within the row)."""
    width = length - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none, none, none
    h = gram_hashes(data)
    least = window_minima((h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), width)
    sizes = np.diff(offsets)
    row_of = np.repeat(np.arange(len(sizes)), sizes)[:len(least)]
    starts = np.arange(len(least))
    ok = starts + length <= offsets[1:][row_of]
    starts, row_of = starts[ok], row_of[ok]
    place = (least[ok] & U(0xFFFFFFFF)).astype(np.int64)
    if not len(starts):
        return none, none.astype(np.uint64), none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row_of[1:] != row_of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    row = row_of[first]
    base = offsets[:-1][row]
    return row, h[place[first]], place[first] - base, starts[first] - base, starts[last] - base


# ---- columns ------------------------------------------------------------------------------------------

class ColumnFile:
    """The segments of a task, one column after another, in a temporary file of the task."""

    def __init__(self, rows: list[bytes], shifts: np.ndarray, columns: int):
        self.n, self.columns = len(rows), columns
        self.file = tempfile.TemporaryFile()
        step = max(1, (4 << 20) // max(1, columns))
        # each run of rows is written column by column into its place
        self.file.truncate(self.n * columns)
        for at in range(0, self.n, step):
            part = rows[at:at + step]
            block = np.zeros((len(part), columns), np.uint8)
            for i, seg in enumerate(part):
                block[i, shifts[at + i]:shifts[at + i] + len(seg)] = np.frombuffer(seg, np.uint8)
            turned = np.ascontiguousarray(block.T)
            for c in range(columns):
                self.file.seek(c * self.n + at)
                self.file.write(turned[c].data)

    def backwards(self):
        for c in range(self.columns - 1, -1, -1):
            self.file.seek(c * self.n)
            yield c, np.frombuffer(self.file.read(self.n), np.uint8)

    def close(self):
        self.file.close()


def rounds(columns: ColumnFile, length: int = LENGTH):
    """After each inserted column: column, its BWT symbols, the order of the suffixes from it on, and the common
    prefix (up to ``length``) of each with its predecessor."""
    n = columns.n
    kind = np.uint8 if length < 256 else np.uint16
    order, common, cap = np.arange(n), np.zeros(n, kind), kind(length)
    for c, symbols in columns.backwards():
        bwt = symbols[order]
        moved = np.argsort(bwt, kind="stable")
        new = np.zeros(n, kind)
        if n > 1:
            was, now = moved[:-1], moved[1:]
            same = bwt[was] == bwt[now]
            near = same & (now == was + 1)
            least = np.zeros(n - 1, kind)
            least[near] = common[now[near]]
            far = np.flatnonzero(same & ~near)
            if len(far):
                cuts = np.empty(2 * len(far), np.int64)
                cuts[0::2], cuts[1::2] = was[far] + 1, now[far] + 1
                least[far] = np.minimum.reduceat(np.append(common, cap), cuts)[0::2]
            new[1:] = np.where(same, np.minimum(least, cap - 1) + 1, 0)
        order, common = order[moved], new
        yield c, bwt, order, common


def repeated_starts(rows: list[bytes], shifts: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, weights: np.ndarray,
                    columns: int, length: int = LENGTH, starts: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated start columns: segment, first column, last column. Starts of a segment: ``firsts`` to ``lasts``."""
    starts = columns - length + 1 if starts is None else starts
    marks = np.zeros((len(rows), starts + 1), bool)
    file = ColumnFile(rows, shifts, columns)
    try:
        for c, _, order, common in rounds(file, length):
            if c >= starts or not len(order):
                continue
            run = np.cumsum(common < length) - 1
            valid = (firsts[order] <= c) & (c <= lasts[order])
            total = np.bincount(run, weights=weights[order] * valid)
            marks[order[valid & (total[run] >= 2)], c] = True
    finally:
        file.close()
    edge = np.diff(marks.astype(np.int8), axis=1, prepend=0)
    seg, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return seg, begin, end - 1


# ---- Spark jobs ---------------------------------------------------------------------------------------

def _text_class(text):
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """k1, k2, text -> k1, k2, gram, spot (place, place - first start and place - last start packed)."""
    def run(batches):
        for batch in batches:
            for i, _j, data, offsets in text_slices(batch.column(2), 1 << 18):
                row, h, place, first, last = anchors(data, offsets)
                take = pa.array(row + i)
                spot = (place << 16) | ((place - first) << 8) | (place - last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(h.view(np.int64)), pa.array(spot)],
                    names=["k1", "k2", "gram", "spot"])

    return texts.mapInArrow(run, "k1 bigint, k2 bigint, gram bigint, spot bigint")


SEGMENTS = "bucket bigint, seg binary, shift int, lo int, hi int, weight bigint, k1 bigint, k2 bigint, place bigint"


def _segment_rows(found: DataFrame, owners: bool) -> DataFrame:
    """k1, k2, text, copies, spots (gram, spot, split) -> segments; with ``owners`` a row per place in a text, else
    equal ones of a batch summed up."""
    width = LENGTH - GRAM

    def parts(data: bytes, spot: int, gram: int, split: bool):
        place, back, near = spot >> 16, spot >> 8 & 255, spot & 255
        lo, hi = width - back, width - near  # start columns; the anchor stands in column ``width``
        if not split:
            yield gram, data[place - back:place - near + LENGTH], lo, lo, hi, place
            return
        for g in range(lo // GROUP, hi // GROUP + 1):
            a, b = max(lo, g * GROUP), min(hi, g * GROUP + GROUP - 1)
            core = data[place - width + g * GROUP + GROUP - 1:place - width + g * GROUP + LENGTH]
            key = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=g.to_bytes(8, "little")).digest(), "little", signed=True)
            yield key, data[place - width + a:place - width + b + LENGTH], a, a, b, place

    def run(batches):
        for batch in batches:
            texts, copies, spots = batch.column("text"), batch.column("copies"), batch.column("spots")
            k1, k2 = batch.column("k1"), batch.column("k2")
            sums: dict = {}
            rows: list = []

            def out():
                if owners:
                    cols = list(zip(*rows)) if rows else [[]] * 9
                else:
                    cols = [list(x) for x in zip(*sums)] if sums else [[]] * 5
                    cols += [list(sums.values()), [None] * len(sums), [None] * len(sums), [None] * len(sums)]
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in SEGMENTS.split(", ")])
                sums.clear()
                rows.clear()
                return made

            for i in range(batch.num_rows):
                data, n = texts[i].as_py().encode(), copies[i].as_py()
                a, b = k1[i].as_py(), k2[i].as_py()
                for s in spots[i].as_py():
                    for bucket, seg, shift, lo, hi, place in parts(data, s["spot"], s["gram"], s["split"]):
                        if owners:
                            rows.append((bucket, seg, shift, lo, hi, n, a, b, place))
                        else:
                            key = (bucket, seg, shift, lo, hi)
                            sums[key] = sums.get(key, 0) + n
                if len(rows) + len(sums) >= 20_000:
                    yield out()
            yield out()

    return found.mapInArrow(run, SEGMENTS)


def _marked(segments: DataFrame, tasks: int) -> DataFrame:
    """Segments dealt by bucket -> s1, s2 (identity of a segment), begin and end columns of its repeated starts."""
    columns = 2 * LENGTH - GRAM

    def run(batches):
        sums: dict = {}
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in ("seg", "shift", "lo", "hi", "s1", "s2", "weight")]
            for seg, shift, lo, hi, s1, s2, n in zip(*cols):
                key = (s1, s2)
                old = sums.get(key)
                sums[key] = (seg, shift, lo, hi, n + (old[4] if old else 0))
        if not sums:
            return
        ids = list(sums)
        seg, shift, lo, hi, n = zip(*sums.values())
        sums.clear()
        row, begin, end = repeated_starts(list(seg), np.array(shift), np.array(lo), np.array(hi), np.array(n, np.float64),
                                          columns, starts=LENGTH - GRAM + 1)
        s1, s2 = (np.array(x, np.int64) for x in zip(*ids))
        yield pa.RecordBatch.from_arrays([pa.array(s1[row]), pa.array(s2[row]), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))],
                                         names=["s1", "s2", "begin", "end"])

    return (segments.repartition(tasks, "bucket").select("seg", "shift", "lo", "hi", "s1", "s2", "weight")
            .mapInArrow(run, "s1 bigint, s2 bigint, begin int, end int"))


def repeated_spans(texts: DataFrame, max_bucket: int = MAX_BUCKET, task_rows: int = TASK_ROWS) -> DataFrame:
    """texts: text (not null) -> k1, k2, text, copies, spans (sorted, apart: array of begin, end bytes) of the
    distinct texts in which something repeats."""
    prepare(texts.sparkSession)
    long = texts.where(F.octet_length("text") >= LENGTH).select(*_text_class(F.col("text")), "text")
    spots = _anchor_rows(long)
    # equal texts name equal spots: count them, then look which grams occur again
    twice = staged(spots.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                   .select("gram", (F.col("m") > max_bucket).alias("split")), "suffix-grams")
    hits = (spots.join(twice, "gram").groupBy("k1", "k2")
            .agg(F.collect_set(F.struct("gram", "spot", "split")).alias("spots")))
    classes = long.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    found = staged(classes.join(hits, ["k1", "k2"]), "suffix-found")

    ident = [F.xxhash64("bucket", "seg", "lo", "hi").alias("s1"), F.xxhash64(F.lit(1), "bucket", "seg", "lo", "hi").alias("s2")]
    rows = found.agg(F.sum(F.size("spots"))).first()[0] or 0
    tasks = max(1, -(-rows // task_rows))
    marked = _marked(_segment_rows(found, False).select("*", *ident), tasks)
    owners = _segment_rows(found, True).select(*ident, "k1", "k2", "place")
    base = F.col("place") - (LENGTH - GRAM)
    spans = (owners.join(marked, ["s1", "s2"])
             .select("k1", "k2", F.struct((base + F.col("begin")).alias("b"), (base + F.col("end") + LENGTH).alias("e")).alias("x"))
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("x")).alias("x")))
    return found.drop("spots").join(spans, ["k1", "k2"])


def _cut(texts: DataFrame) -> DataFrame:
    """k1, k2, text, x (sorted intervals) -> k1, k2, n_removed, n_spans, kept (bytes) and kept_text (the same
    without characters that a cut has split)."""
    def run(batches):
        for batch in batches:
            out = []
            for text, x in zip(batch.column("text"), batch.column("x")):
                data, kept, at, gone, spans = text.as_py().encode(), [], 0, 0, 0
                for s in x.as_py():
                    if spans and s["b"] <= at:  # touches or overlaps the span before
                        gone += max(0, s["e"] - at)
                        at = max(at, s["e"])
                        continue
                    kept.append(data[at:s["b"]])
                    gone += s["e"] - s["b"]
                    spans += 1
                    at = s["e"]
                kept.append(data[at:])
                out.append((gone, spans, b"".join(kept)))
            n, m, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())],
                names=["k1", "k2", "n_removed", "n_spans", "kept", "kept_text"])

    return texts.select("k1", "k2", "text", "x").mapInArrow(
        run, "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept binary, kept_text string")


def without_repeats(docs: DataFrame, text_col: str = "text", with_kept: bool = True, with_bytes: bool = True, **kw) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned) n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``with_kept``, kept_text and, unless ``with_bytes`` is off, kept (bytes; null where nothing was removed)."""
    s, a, b = (free_name(docs, x) for x in ("_s", "_s_k1", "_s_k2"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    cut = _cut(repeated_spans(docs.select(text.alias("text")), **kw))
    cut = cut.withColumn("sha", F.sha2("kept", 256))
    if not with_kept:
        cut = cut.drop("kept", "kept_text")
    elif not with_bytes:
        cut = cut.drop("kept")
    cut = staged(cut, "suffix-cut")
    # texts that can't repeat meet nothing, each under a key of its own
    enough = F.octet_length(text) >= LENGTH
    k1, k2 = _text_class(text)
    k1, k2 = F.when(enough, k1).otherwise(F.monotonically_increasing_id()).alias("k1"), F.when(enough, k2).otherwise(F.lit(0).cast("bigint")).alias("k2")
    out = docs.withColumn(s, F.struct(F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(F.encode(text, "UTF-8"), 256).alias("sha"), k1, k2))
    if not with_kept:
        out = out.drop(text_col)
    zero = F.lit(0).cast("bigint")
    found = out.join(cut.select(F.col("k1").alias(a), F.col("k2").alias(b), F.struct(*[c for c in cut.columns if c not in ("k1", "k2")]).alias(a + "_cut")),
                     (F.col(s)["k1"] == F.col(a)) & (F.col(s)["k2"] == F.col(b)), "left")
    c = F.col(a + "_cut")
    fields = [F.col(s)["n_bytes"].alias("n_bytes"), F.coalesce(c["n_removed"], zero).alias("n_removed"),
              F.coalesce(c["n_spans"], zero).alias("n_spans"), F.coalesce(c["sha"], F.col(s)["sha"]).alias("kept_sha256")]
    if with_kept:
        fields.append(F.when(c.isNull(), F.col(f"`{text_col}`")).otherwise(c["kept_text"]).alias("kept_text"))
        if with_bytes:
            fields.append(c["kept"].alias("kept"))
    return found.withColumn(s, F.struct(*fields)).drop(a, b, a + "_cut"), s
