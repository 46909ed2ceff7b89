"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary (hash and displace: one displacement per small group of
tokens, as many slots as tokens, the token kept in its slot to tell strangers) resolves a pre-token that is a
token as a whole. Tier 2: other pre-tokens are merged with a heap of adjacent pairs over a doubly linked list of
their bytes, lowest rank and then leftmost first, which is O(n log n) for any length. Results of pre-tokens are kept in
a bounded memo of the task. The hash is built once per job and broadcast; its size is the vocabulary's.

Edge cases: null and empty texts have no ids; any text round-trips; vocabulary files are read by the driver only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import prepare

MEMO = 300_000
GROUP = 2


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of fixed keys: ``get`` gives a key's number, or -1 for any other bytes."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.groups = n, max(1, -(-n // GROUP))
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.groups)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            members[h % self.groups].append((h, i))
        self.shift, self.keys, self.numbers = [0] * self.groups, [None] * n, [-1] * n
        by_size = sorted(range(self.groups), key=lambda g: -len(members[g]))  # large groups first
        for g in by_size:
            if len(members[g]) < 2:
                break
            d = 0
            while True:
                slots = {self._slot(h, d) for h, _ in members[g]}
                if len(slots) == len(members[g]) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.shift[g] = d
            for h, i in members[g]:
                s = self._slot(h, d)
                self.keys[s], self.numbers[s] = keys[i], i
        free = iter([s for s in range(n) if self.keys[s] is None])
        for g in by_size:  # a lone key names its slot outright, as -1 - slot
            if len(members[g]) == 1:
                s, i = next(free), members[g][0][1]
                self.shift[g], self.keys[s], self.numbers[s] = -1 - s, keys[i], i

    def _slot(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFFFFFF) % self.n

    def get(self, key: bytes) -> int:
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.groups]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.numbers[s] if self.keys[s] == key else -1


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of tokens (as left << 32 | right) that joins to a token, with that token's rank."""
    pairs = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    return pairs


def merge(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Ids of one pre-token, from those of its single bytes, by joining again and again the adjacent pair of lowest
    rank, leftmost first. A heap entry is rank * n + place; it is stale when the pair there has another rank by now."""
    n, get = len(ids), pairs.get
    heap = []
    for i in range(n - 1):
        r = get(ids[i] << 32 | ids[i + 1])
        if r is not None:
            heap.append(r * n + i)
    if not heap:
        return ids
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        r, i = divmod(heapq.heappop(heap), n)
        j = after[i]
        if j >= n or ids[i] < 0 or get(ids[i] << 32 | ids[j]) != r:
            continue
        ids[i], ids[j] = r, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            x = get(r << 32 | ids[k])
            if x is not None:
                heapq.heappush(heap, x * n + i)
        h = before[i]
        if h >= 0:
            x = get(ids[h] << 32 | r)
            if x is not None:
                heapq.heappush(heap, x * n + h)
    return [x for x in ids if x >= 0]


class Memo(dict):
    """Ids of pre-tokens seen lately: at most ``limit`` young and as many old ones; old ones come back on use."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, word):
        ids = self.old.get(word)
        if ids is None:
            ids = self.compute(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary (``ranks``: token bytes to id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        tokens = list(ranks)
        self.ids = [ranks[t] for t in tokens]
        self.whole = PerfectHash(tokens)
        self.tokens = {i: t for t, i in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs = pair_table(ranks)
        self._ready()

    def _ready(self):
        self._memo, self._split = Memo(self.word, MEMO), regex.compile(self.pattern).findall

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_memo", "_split")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def word(self, text: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        data = text.encode()
        i = self.whole.get(data)
        return (self.ids[i],) if i >= 0 else tuple(merge([self.single[b] for b in data], self.pairs))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._memo.__getitem__, self._split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoded(docs: DataFrame, codec: Codec, text_col: str = "text", digests: bool = False) -> DataFrame:
    """``docs`` with an appended struct column ``bpe``: ids (array), or with ``digests`` n_tokens, ids_sha256 and
    decoded_sha256 (of the ids' decimal text and of the decoded bytes)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec)  # bounded by the vocabulary
    others = [c for c in docs.columns if c != text_col] if digests else docs.columns
    kept = docs.select(*[F.col(f"`{c}`") for c in others])
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    schema = kept.schema.simpleString()[7:-1]
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        use = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                ids = use.encode(text.as_py() or "")
                if digests:
                    out.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                hashlib.sha256(use.decode(ids)).hexdigest()))
                else:
                    out.append((ids,))
            kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.list_(pa.int32())]
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            names = [x.split()[0] for x in fields.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.StructArray.from_arrays(cols, names)], names=["row", "bpe"])

    return texts.mapInArrow(run, f"row struct<{schema}>, bpe struct<{fields.replace(' ', ':').replace(',:', ',')}>")


def decoded(df: DataFrame, codec: Codec, ids_col: str = "ids") -> DataFrame:
    """One column ``bytes``: the decoded ids of each row, in the order of ``df`` (null ids: empty)."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([shared.value.decode(x.as_py() or []) for x in batch.column(0)], pa.binary())], names=["bytes"])

    return df.select(F.col(f"`{ids_col}`")).mapInArrow(run, "bytes binary")
