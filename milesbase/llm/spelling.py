"""Spelling variant grouping: words one edit apart, found by blocked Gram matrices of their letter counts.

1. *Words* are counted with partial aggregation; only words of enough letters and occurrences go on.
2. *Blocks.* If two words differ by one replaced, inserted or deleted letter, the edit lies in the left or in the right half, and
   the other half is equal. So each word enters the blocks of its own length and of the next shorter one (adjacent
   lengths), keyed by its left and by its right half. A block of more than ``BLOCK`` pairs of words is split again: the half
   that may differ is halved in the same way and its equal quarter joins the key, down to one open letter. Nothing is
   dropped by that, and a frequent beginning never makes a large block.
3. *Gram matrices.* In a block, the product of the words' letter counts gives all squared distances at once
   (|a|^2 + |b|^2 - 2ab); one edit moves them by at most two. The pairs left are verified letter by letter, and a pair counts
   only in the block that its first differing letter leads to, so each comes out once.
4. A word's *form* is its most frequent near word if that is frequent enough; *roots* follow forms by pointer jumping (a form is
   several times as frequent as its word, so chains are short and free of cycles).

Scale: a task holds about ``TASK_ROWS`` words of whole blocks; a block is at most ``BLOCK`` pairs (or one open letter); links are
aggregated before they are shuffled. Nothing reaches the driver but row counts.

Edge cases: null texts have no words; a null id is an empty text before the colon; words of any length; words that tie in frequency
are ordered by code point; an empty table or one without frequent words gives an empty result; other columns don't enter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import prepare, staged

LETTERS = "[A-Za-zÀ-ÿ]+"
BLOCK = 250_000
TASK_ROWS = 200_000
TILE = 2_000_000

PLACE = np.zeros(256, np.int64)
PLACE[97:123] = np.arange(26)
PLACE[192:256] = np.arange(26, 90)
KEY = ["m", "a", "c", "head", "tail"]


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_letters: int = 6, min_count: int = 5,
                altered: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """word, n: runs of Latin letters with A-Z lower-cased. ``altered`` maps (id, run) to the word to count."""
    lower = F.translate(F.col(f"`{text_col}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run"))
    # one letter may go, so shorter runs can't matter, and longer ones not before they are altered
    runs = runs.where(F.length("run") >= min_letters)
    words = runs.select((altered(F.col("id"), F.col("run")) if altered else F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def without_one(doc_id: Column, run: Column, every: int = 199) -> Column:
    """``run`` without one letter where ``every`` divides the CRC-32 of id, colon and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


# ---- blocks ------------------------------------------------------------------------------------------

def _halves(rows: DataFrame) -> DataFrame:
    """Rows (word, n, short, m, a, c) in the two blocks of their halves. a and c: letters known to be equal at either end, of
    the m letters of the shorter word."""
    h = F.expr("(m - a - c) div 2").cast("int")
    ways = F.array(F.struct((F.col("a") + h).alias("a"), F.col("c").alias("c")), F.struct(F.col("a").alias("a"), (F.col("m") - F.col("a") - h).alias("c")))
    rows = rows.select("word", "n", "short", "m", F.explode(ways).alias("x")).select("word", "n", "short", "m", "x.a", "x.c")
    return rows.select("*", F.substring("word", F.lit(1), F.col("a")).alias("head"), F.expr("right(word, c)").alias("tail"))


def blocks(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """word, n, short (of the block's length, else one longer) and the block's key, for every block with a pair."""
    ends = F.array(F.struct(F.lit(True).alias("short"), F.length("word").alias("m")), F.struct(F.lit(False).alias("short"), (F.length("word") - 1).alias("m")))
    rows = words.select("word", "n", F.explode(ends).alias("e")).select("word", "n", "e.short", "e.m", F.lit(0).alias("a"), F.lit(0).alias("c"))
    done = []
    while True:
        rows = staged(_halves(rows), "spelling-blocks")
        short = F.sum(F.col("short").cast("bigint"))
        sizes = rows.groupBy(*KEY).agg(short.alias("s"), F.count(F.lit(1)).alias("k"))
        # blocks without a pair end here, and those of too many pairs are halved once more unless one letter is open
        sizes = sizes.where("s > 0 AND k > 1").select(*KEY, ((F.col("s") * F.col("k") > most) & (F.expr("m - a - c") > 1)).alias("large"))
        rows = staged(rows.join(sizes, KEY), "spelling-sized")
        done.append(rows.where("NOT large").drop("large"))
        rows = rows.where("large").select("word", "n", "short", "m", "a", "c")
        if rows.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


# ---- Gram matrices -----------------------------------------------------------------------------------

def letter_counts(words: list[str]) -> np.ndarray:
    """Letter counts of words, one row each."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * 90 + PLACE[flat], minlength=len(words) * 90).reshape(-1, 90).astype(np.float32)


def close_pairs(counts: np.ndarray, norms: np.ndarray, shorts: np.ndarray, longs: np.ndarray):
    """Pairs (a short word, a later short or a long one) whose squared distance is at most two, tile by tile."""
    everyone = np.concatenate([shorts, longs])
    step = max(1, TILE // len(everyone))
    for at in range(0, len(shorts), step):
        part = shorts[at:at + step]
        gram = counts[part] @ counts[everyone].T
        i, j = np.nonzero(norms[part][:, None] + norms[everyone][None, :] - 2 * gram <= 2)
        keep = j > i + at
        yield from zip(part[i[keep]].tolist(), everyone[j[keep]].tolist())


def edit_place(x: str, y: str) -> int:
    """Place of the one edit that turns x into y (as long, or one letter longer), or -1."""
    p, n = 0, len(x)
    while p < n and x[p] == y[p]:
        p += 1
    if len(y) == n:
        return p if p < n and x[p + 1:] == y[p + 1:] else -1
    return p if x[p:] == y[p + 1:] else -1


def leads_to(m: int, p: int, a: int, c: int) -> bool:
    """Whether halving m letters towards an edit at p comes by the block that knows a letters on the left and c on the right."""
    x = y = 0
    while (x, y) != (a, c):
        open_ = m - x - y
        if open_ <= 1 or x > a or y > c:
            return False
        h = open_ // 2
        if p >= x + h:
            x += h
        else:
            y += open_ - h
    return True


def near_pairs(rows: DataFrame) -> DataFrame:
    """Rows of blocks -> word, n, near, near_n: each pair of near words in both directions."""
    prepare(rows.sparkSession)

    def run(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        table = table.sort_by([(k, "ascending") for k in KEY])
        words, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        m, a, c = (table.column(k).to_numpy() for k in ("m", "a", "c"))
        short = table.column("short").to_numpy(zero_copy_only=False)
        same = np.ones(len(words) - 1, bool)
        for k in KEY:
            col = table.column(k).combine_chunks()
            same &= pa.compute.equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(words)]])
        out = [[], [], [], []]
        at = 0
        while at < len(cuts) - 1:
            # the counts of some blocks at a time: 90 numbers a word
            end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 50_000, "right")) - 1)
            base = cuts[at]
            counts = letter_counts(words[base:cuts[end]])
            norms = (counts * counts).sum(axis=1)
            for i, j in zip(cuts[at:end].tolist(), cuts[at + 1:end + 1].tolist()):
                flags = short[i:j]
                for x, y in close_pairs(counts, norms, np.flatnonzero(flags) + i - base, np.flatnonzero(~flags) + i - base):
                    x, y = int(x + base), int(y + base)
                    p = edit_place(words[x], words[y])
                    if p >= 0 and leads_to(int(m[i]), p, int(a[i]), int(c[i])):
                        for k, v in enumerate((words[x], n[x], words[y], n[y])):
                            out[k].append(v)
            at = end
            if len(out[0]) >= 50_000 or at == len(cuts) - 1:
                w, x, y, z = (pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64())))
                yield pa.RecordBatch.from_arrays([w, x, y, z], names=["word", "n", "near", "near_n"])
                yield pa.RecordBatch.from_arrays([y, z, w, x], names=["word", "n", "near", "near_n"])
                out = [[], [], [], []]

    tasks = max(1, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks, *KEY).mapInArrow(run, "word string, n bigint, near string, near_n bigint")


# ---- forms -------------------------------------------------------------------------------------------

def roots_of(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: the last word that forms lead to."""
    up = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = up.join(up.select(F.col("word").alias("root"), F.col("root").alias("top")), "root", "left")
        nxt = staged(nxt.select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "spelling-roots")
        up = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return up


def variants(words: DataFrame, ratio: int = 5, most: int = BLOCK) -> DataFrame:
    """word, n -> word, form, root, n, n_near, form_n."""
    words = staged(words.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    links = near_pairs(blocks(words, most))
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    rows = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n")), "spelling-forms")
    out = rows.join(roots_of(rows.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
