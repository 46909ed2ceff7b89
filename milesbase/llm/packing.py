"""Best-fit packing with swap-based local search.

Documents are tokenised, closed with an end id and cut only when longer than a sequence (into full
pieces; the first piece takes the remainder). Full pieces are sequences of their own and stay where they are. The others are
dealt evenly to tasks by row number, so a source, a length or a repeated document makes no task larger; each task packs about
``task_pieces`` of them:

* best-fit decreasing gives the first bins;
* then the emptiest underfull bin is dissolved piece by piece into other underfull bins: by moving a piece, by
  exchanging one piece for a smaller one, or for two smaller ones (of the ``PAIR_BINS`` roomiest bins and, where those offer
  no change, of every underfull bin), always taking the change that moves the most tokens into the fuller bin. Each change
  raises the sum of squared fills, so the search ends; it stops for a bin when no change is left, and for the task when the
  number of bins is the least possible one.

The token ids equal those of the ``tokenizers`` file of the same vocabulary, whose added tokens are matched inside texts
too (``added_tokens``); its ranks are run by ``tiktoken``, which gives the same ids in a quarter of the CPU time (tested on both).
Its pattern engine gives up on runs of about a million characters of one kind; such texts are split by ``regex`` and merged
by the heap of ``bpe``, to the same ids.

Edge cases: null and empty texts hold the end id alone; texts of any length are tokenised whole, one at a time; pieces of equal
length are packed in the order in which they reach their task (any order is a result); repeated rows and null ids are pieces
like any other; an empty table gives an empty result; other columns don't enter.
"""

from __future__ import annotations

import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.bpe import merge, pair_table, read_ranks
from milesbase.llm.common import prepare, staged

CAPACITY = 1024
END = 2
TASK_PIECES = 10_000
PAIR_BINS = 32
FULL = 1 << 62  # sequence ids of full pieces start here, above those of any task
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins of piece numbers."""
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect.bisect_left(free, (n, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > n:
            bisect.insort(free, (room - n, b))
    return bins


def improve(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Local search over the underfull bins (see the module's text)."""
    size = np.asarray(lengths, np.int64)
    bins = [list(b) for b in bins]
    fill = np.array([size[b].sum() for b in bins], np.int64)
    home = np.zeros(len(size), np.int64)
    for b, members in enumerate(bins):
        home[members] = b
    least = -(-int(size.sum()) // capacity)
    n_bins = len(bins)
    closed = fill >= capacity  # full, emptied or without any change left

    pairs: dict[int, np.ndarray] = {}  # rows (sum, bin, piece, piece) of a bin, one for each two sizes
    table: list[np.ndarray] = []  # the rows of all underfull bins, until the next change

    def pairs_of(b: int) -> np.ndarray:
        by_size: dict[int, list[int]] = {}
        for i in bins[b]:
            by_size.setdefault(int(size[i]), []).append(i)
        sizes = list(by_size)  # few: different sizes add up to a bin
        rows = [(2 * s, b, *by_size[s][:2]) for s in sizes if len(by_size[s]) > 1]
        rows += [(s + t, b, by_size[s][0], by_size[t][0]) for k, s in enumerate(sizes) for t in sizes[k + 1:]]
        return np.array(rows, np.int64).reshape(-1, 4)

    def best_pair(mine: dict[int, int], room: np.ndarray):
        """The exchange of a piece of ``mine`` for two smaller ones that moves most tokens, over every bin with room."""
        if not table:
            for b in np.flatnonzero((fill > 0) & (fill < capacity)).tolist():
                if b not in pairs:
                    pairs[b] = pairs_of(b)
                table.append(pairs[b])
            table[:] = [np.concatenate(table)]
        both, where = table[0][:, 0], table[0][:, 1]
        best = (0, -1, [], [])
        for a in mine:
            gain = a - both
            gain[gain > room[where]] = 0
            k = int(np.argmax(gain)) if len(gain) else -1
            if k >= 0 and gain[k] > best[0]:
                best = (int(gain[k]), int(where[k]), [mine[a]], table[0][k, 2:].tolist())
        return best

    def best_change(source: int):
        """(tokens moved, bin, pieces out, pieces back) that moves most tokens out of ``source``, or None."""
        # only into bins that are at least as full: that raises the sum of squares
        room = np.where((fill > 0) & (fill >= fill[source]), capacity - fill, -1)
        room[source] = -1
        mine = {int(size[i]): i for i in bins[source]}  # one piece of each size
        best = (0, -1, [], [])
        for a in sorted(mine, reverse=True):
            if a <= best[0]:
                break  # no change moves more than the piece itself
            b = int(np.argmin(np.where(room >= a, room, capacity + 1)))
            if room[b] >= a:
                best = (a, b, [mine[a]], [])  # into the bin that it fills best
                break
            gain = a - size
            gain[(gain > room[home]) | (gain <= best[0])] = 0
            p = int(np.argmax(gain))
            if gain[p] > best[0]:
                best = (int(gain[p]), int(home[p]), [mine[a]], [p])
            for b in np.argsort(-room, kind="stable")[:PAIR_BINS].tolist():
                if room[b] <= best[0]:
                    break
                small = [i for i in bins[b] if size[i] < a]
                for x, p in enumerate(small):
                    for q in small[x + 1:]:
                        g = a - int(size[p]) - int(size[q])
                        if best[0] < g <= room[b]:
                            best = (g, b, [mine[a]], [p, q])
        best = best if best[0] else best_pair(mine, room)
        return best if best[0] else None

    while n_bins > least and not closed.all():
        source = int(np.argmin(np.where(closed, capacity + 1, fill)))
        change = best_change(source)
        if change is None:
            closed[source] = True
            continue
        gain, b, out, back = change
        bins[source] = [i for i in bins[source] if i not in out] + back
        bins[b] = [i for i in bins[b] if i not in back] + out
        home[out], home[back] = b, source
        pairs.pop(source, None), pairs.pop(b, None)
        table.clear()
        fill[source] -= gain
        fill[b] += gain
        if fill[b] >= capacity:
            closed[b] = True
        if not fill[source]:
            closed[source] = True
            n_bins -= 1
    return [b for b in bins if b]


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of piece numbers, each with at most ``capacity`` tokens."""
    return improve(lengths, best_fit(lengths, capacity), capacity)


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` file, which are matched as they stand anywhere in a text."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} is not matched as it stands")
    return {t["content"]: t["id"] for t in tokens}


class LongTexts:
    """Ids of texts that the fast encoder refuses; made when the first one comes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, added: dict[str, int]):
        self.ranks, self.added, self.pairs = ranks, added, pair_table(ranks)
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.split = regex.compile(pattern).finditer
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.added:
                ids.append(self.added[part])
                continue
            for m in self.split(part):
                data = m.group().encode()
                whole = self.ranks.get(data)
                ids += [whole] if whole is not None else merge([self.single[b] for b in data], self.pairs)
        return ids


def pieces(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end: int = END, added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; ``added``: tokens matched before the ranks."""
    spark = docs.sparkSession
    prepare(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))  # bounded by the vocabulary

    def run(batches):
        import tiktoken
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens=added or {})
        spare = None
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                try:
                    ids = encoder.encode_to_numpy(text, allowed_special="all")
                except ValueError:  # the pattern engine's stack is full
                    spare = spare or LongTexts(ranks.value, pattern, added or {})
                    ids = spare.encode(text)
                ids = np.append(ids, end).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")).mapInArrow(run, PIECES)


def packed(cut: DataFrame, capacity: int = CAPACITY, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Pieces (with a ``length``) plus sequence_id and offset."""
    prepare(cut.sparkSession)
    cut = staged(cut, "packing-pieces")
    loose = cut.where(F.col("length") < capacity)
    names, schema = cut.columns, cut.schema

    def run(batches):
        from pyspark import TaskContext
        base, number = TaskContext.get().partitionId() << 40, 0
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        lengths = table.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b in pack(lengths, capacity):
            at = 0
            for i in b:
                sequence[i], offset[i] = base + number, at
                at += int(lengths[i])
            number += 1
        for batch in table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).to_batches():
            yield batch

    tasks = max(1, -(-loose.count() // task_pieces))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    shared = loose.select(*names).repartition(tasks).mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")
    own = (F.monotonically_increasing_id() + F.lit(FULL)).alias("sequence_id")
    return shared.union(cut.where(F.col("length") >= capacity).select(*names, own, F.lit(0).cast("bigint").alias("offset")))


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end: int = END, **kw) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    return packed(pieces(docs, ranks_path, pattern, capacity=capacity, end=end, **kw), capacity)
