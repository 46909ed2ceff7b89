"""Approximate nearest neighbours with randomly rotated one-bit codes.

Every vector is centred, scaled to length 1 and turned by one random rotation; the index keeps the signs of its
coordinates as packed bits and two scalars (distance from the centre, inner product of the vector with its
own code). The code estimates the inner product with any query, and the second scalar bounds the error:
sqrt((1 - f^2) / f^2) * eps / sqrt(d - 1). Per block of the index, a query's ``k`` best estimates are
measured exactly; then every vector whose lower bound is not above the worst of them is measured too. With
eps = 3 a true neighbour is passed over with a probability under 0.2 % (measured recall: see the tests).

Scale: the index is cut into blocks of about ``block`` vectors by row count (ids and values don't matter, so there are
no hot blocks), the queries likewise. Index blocks are dealt into at most as many groups as there are shuffle partitions, each
group gets one copy of the queries, and each pair of blocks of a group is one row of an equi-join on the
group number. The join is always a merge join: Spark sizes the copies by the queries before they are copied, and
would broadcast them through the driver. A task returns ``k`` rows for each query of a pair; a window with
Spark's partial group limit keeps the best ``k``. Vectors of floats are shuffled and stored as floats and measured as doubles.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components, and rows
with a null id, take no part; query rows that repeat an id are answered once (smallest vector); rows with the query's own
id are no candidates; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from milesbase.llm.common import prepare, staged

K = 10
EPS = 3.0
BLOCK = 4096
QUERY_BLOCK = 512
STEP = 64  # queries of a pair of blocks measured at a time: bounds what a task holds
INDEX = "block int, ids binary, vectors binary, codes binary, norms binary, inner binary"


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the centre, inner products of each unit vector with its code."""
    away = vectors - centre
    norms = np.sqrt((away * away).sum(axis=1))
    unit = (away / np.where(norms > 0, norms, 1)[:, None]) @ turn.T
    inner = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(unit > 0, axis=1), norms, np.where(norms > 0, inner, 1.0)


def estimates(codes: np.ndarray, norms: np.ndarray, inner: np.ndarray, queries: np.ndarray, centre: np.ndarray,
              turn: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances and their lower bounds (queries x vectors)."""
    dims = queries.shape[1]
    away = queries - centre
    length = np.sqrt((away * away).sum(axis=1))
    unit = ((away / np.where(length > 0, length, 1)[:, None]) @ turn.T).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=dims).astype(np.float32) * 2 - 1
    cosine = (unit @ signs.T) / (np.sqrt(dims) * inner)
    error = np.sqrt(np.maximum(0, 1 - inner**2)) / inner * eps / np.sqrt(max(1, dims - 1))
    base = length[:, None] ** 2 + norms**2
    scale = 2 * length[:, None] * norms
    # a code says nothing beyond cosine 1
    return base - scale * np.clip(cosine, -1, 1), base - scale * np.minimum(1, cosine + error + 1e-5)


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Euclidean distances of ``a[:, i]`` and ``b[:, j]`` (one vector a column), components added in order.

    One component of a block is a run of memory that fits the cache, so that picking from it costs little; whole vectors
    would be copied for every pair."""
    total = np.zeros(len(i))
    for x, y in zip(a, b):
        d = x.take(i)
        d -= y.take(j)
        d *= d
        total += d
    return np.sqrt(total, out=total)


def search_block(ids, vectors, codes, norms, inner, query_ids, queries, centre, turn, k: int = K, eps: float = EPS):
    """The ``k`` nearest of one block for each query: query index, vector index, distance."""
    across = np.ascontiguousarray(vectors.T)
    parts = [_search(ids, across, codes, norms, inner, query_ids[a:a + STEP], queries[a:a + STEP], centre, turn, k, eps)
             for a in range(0, len(queries), STEP)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate([q + n * STEP for n, (q, _, _) in enumerate(parts)]), *[np.concatenate([p[x] for p in parts]) for x in (1, 2)]


def _search(ids, across, codes, norms, inner, query_ids, queries, centre, turn, k, eps):
    guess, low = estimates(codes, norms, inner, queries, centre, turn, eps)
    own = query_ids[:, None] == ids[None, :]
    guess[own], low[own] = np.inf, np.inf
    asked = np.ascontiguousarray(queries.T)
    m = min(k, len(ids))
    first = np.argpartition(guess, m - 1, axis=1)[:, :m]
    d = exact(across, asked, first.reshape(-1), np.repeat(np.arange(len(queries)), m)).reshape(-1, m)
    d[np.take_along_axis(own, first, 1)] = np.inf
    worst = d.max(axis=1) if len(ids) >= k else np.full(len(queries), np.inf)
    q, v = np.nonzero((low <= (worst**2 * (1 + 1e-6))[:, None]) & ~own)
    d = exact(across, asked, v, q)
    near = d <= worst[q]  # the worst of k measured ones bounds the k-th; only these are sorted
    q, v, d = q[near], v[near], d[near]
    order = np.lexsort((ids[v], d, q))
    q, v, d = q[order], v[order], d[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return q[best], v[best], d[best]


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def nearest(table: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
            eps: float = EPS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for each row of ``queries`` (same columns as ``table``)."""
    spark = table.sparkSession
    prepare(spark)
    floats = all(df.schema[vec_col].dataType == ArrayType(FloatType(), df.schema[vec_col].dataType.containsNull) for df in (table, queries))
    kind = np.float32 if floats else np.float64

    def usable(df):
        v = F.col(f"`{vec_col}`").cast("array<float>" if floats else "array<double>")
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).where(
            F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))

    rows = usable(table)
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "dims").first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims, n = common["dims"], common["n"]
    rows = rows.where(F.size("v") == dims)
    asked = usable(queries).where(F.size("v") == dims).groupBy("id").agg(F.min("v").alias("v"))
    # the centre: one sum per task, then one per coordinate

    def sums(batches):
        total = np.zeros(dims)
        for b in batches:
            total += _matrix(b.column(0), dims).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(total)], names=["j", "s"])

    parts = rows.select("v").mapInArrow(sums, "j int, s double").groupBy("j").agg(F.sum("s").alias("s")).collect()
    centre = np.zeros(dims)
    for r in parts:
        centre[r["j"]] = r["s"] / n
    turn = rotation(dims)
    n_blocks = max(1, -(-n // block))
    n_asked = asked.count()
    n_query_blocks = max(1, -(-n_asked // query_block))

    def index(batches):
        from pyspark import TaskContext
        number, ids, vectors = TaskContext.get().partitionId(), [], []

        def made():
            i, v = np.concatenate(ids), np.concatenate(vectors)
            codes, norms, inner = encode(v, centre, turn)
            ids.clear()
            vectors.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (i, v.astype(kind), codes, norms, inner)]],
                names=["block", "ids", "vectors", "codes", "norms", "inner"])

        for b in batches:
            if b.num_rows:
                ids.append(b.column(0).to_numpy())
                vectors.append(_matrix(b.column(1), dims))
                if sum(map(len, ids)) >= block:
                    yield made()
        if ids:
            yield made()

    indexed = staged(rows.repartition(n_blocks).mapInArrow(index, INDEX), "ann-index")

    def packed(batches):
        ids, vectors = [], []
        for b in batches:
            if b.num_rows:
                ids.append(b.column(0).to_numpy())
                vectors.append(_matrix(b.column(1), dims))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([np.concatenate(vectors).astype(kind).tobytes()], pa.binary())],
                                             names=["q_ids", "q_vectors"])

    blocks_of_queries = asked.repartition(n_query_blocks).mapInArrow(packed, "q_ids binary, q_vectors binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = min(n_blocks, parts)
    copies = blocks_of_queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # given numbers of partitions are kept; by their bytes alone blocks would be put together that take long to search
    pairs = indexed.withColumn("group", F.pmod("block", F.lit(groups))).repartition(parts, "group").hint("merge").join(
        copies.repartition(parts, "group"), "group")

    def search(batches):
        for b in batches:
            for r in range(b.num_rows):
                def array(name, kind, width=0, r=r, b=b):
                    x = np.frombuffer(b.column(name)[r].as_py(), kind)
                    return x.reshape(-1, width) if width else x
                ids, q_ids = array("ids", np.int64), array("q_ids", np.int64)
                q, v, d = search_block(ids, array("vectors", kind, dims).astype(np.float64), array("codes", np.uint8, -(-dims // 8)),
                                       array("norms", np.float64), array("inner", np.float64), q_ids,
                                       array("q_vectors", kind, dims).astype(np.float64), centre, turn, k, eps)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(ids[v]), pa.array(d)], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
