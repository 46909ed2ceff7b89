"""Quality classifier: neighbour voting in a latent-semantic space.

A document's terms are its byte pairs (hashed to ``TERMS``) and a few shape terms (share of distinct words,
of repeated lines, number of words, each in steps). Terms are weighted log(1 + count) x idf; the
``DIMS`` leading right singular vectors of the labelled sample's term matrix span the latent space. The sample's
vectors (at most ``SAMPLE`` of each label, by a fixed hash of the id) are broadcast, every document's cosine with all
of them is computed exactly in blocks, and the labels of the ``NEIGHBOURS`` nearest are averaged with
weight max(cosine, 0) ** POWER. The average odds are corrected for the sample's equal shares of labels.

Only texts enter the score. The sample is a bounded training set: its bounds are the parameters above, and at
most 2 x SAMPLE rows of TERMS numbers reach the driver. Every document is scored on its whole text.

Edge cases: null and empty texts have the zero vector and get the training share of label 1; without any labelled text every
score is 0.5; labels with null id or quality don't train, several labels of an id count as the lowest;
repeated rows are scored each; other columns don't enter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import prepare
from milesbase.llm.hashing import U, shingle_sets, stream, text_slices, word_hashes

TERMS = 2048
DIMS = 64
SAMPLE = 2048
NEIGHBOURS = 25
POWER = 8
STEPS = 16
SHAPE_WEIGHT = 3.0
PAIRS = (stream(65536, 151) % U(TERMS - 3 * STEPS)).astype(np.int64) + 3 * STEPS


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term weights (before idf) of each row."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    counts = np.zeros(n * TERMS)
    if len(data) > 1:
        row = np.repeat(np.arange(n), sizes)
        inside = row[1:] == row[:-1]
        pair = data[:-1].astype(np.int64) * 256 + data[1:]
        counts = np.bincount(row[1:][inside] * TERMS + PAIRS[pair[inside]], minlength=n * TERMS)
    out = np.log1p(counts.reshape(n, TERMS)).astype(np.float32)
    words, per_row = word_hashes(data, offsets, lower=False)
    _, distinct = shingle_sets(words, per_row, 1)
    lines = np.zeros(n)
    if len(data):
        lines = np.add.reduceat(np.append(data == 10, 0), np.minimum(offsets[:-1], len(data)))
        lines[sizes == 0] = 0
    some = per_row > 0
    shape = [distinct / np.maximum(per_row, 1), np.minimum(1, np.log2(per_row + 1) / STEPS), np.minimum(1, (lines + 1) / np.maximum(per_row, 1))]
    for k, share in enumerate(shape):
        step = np.minimum(STEPS - 1, (share * STEPS).astype(np.int64))
        out[some, k * STEPS + step[some]] = SHAPE_WEIGHT * np.linalg.norm(out[some, 3 * STEPS:], axis=1) / 10
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def fit(x: np.ndarray, y: np.ndarray, share: float, dims: int = DIMS) -> dict:
    """x: term weights of the sample, y: labels, share: label 1's share among all labelled rows."""
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
    z = _unit(x * idf)
    rng = np.random.default_rng(5)
    k = min(dims, *z.shape)
    base = z @ rng.standard_normal((z.shape[1], min(k + 16, z.shape[1])))
    for _ in range(4):  # subspace iteration towards the leading singular vectors
        base, _r = np.linalg.qr(z @ (z.T @ base))
    turn = np.linalg.svd(base.T @ z, full_matrices=False)[2][:k].T.astype(np.float32)
    return {"idf": idf.astype(np.float32), "turn": turn, "vectors": _unit(z @ turn).astype(np.float32), "y": y.astype(np.float64),
            "share": share, "sampled": float(y.mean())}


def vote(model: dict, x: np.ndarray, neighbours: int = NEIGHBOURS, power: float = POWER, block: int = 1024) -> np.ndarray:
    """Scores of rows of term weights."""
    score = np.full(len(x), model["share"])
    z = _unit((x * model["idf"]) @ model["turn"])
    some = np.flatnonzero(np.abs(z).sum(axis=1) > 0)
    k = min(neighbours, len(model["y"]))
    # what label 0 and label 1 weigh when the sample's shares differ from those of all labelled rows
    up = model["share"] / model["sampled"] if model["sampled"] > 0 else 1.0
    down = (1 - model["share"]) / (1 - model["sampled"]) if model["sampled"] < 1 else 1.0
    for at in range(0, len(some), block):
        rows = some[at:at + block]
        cosine = z[rows] @ model["vectors"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** power
        good = (w * model["y"][near]).sum(axis=1) * up
        bad = (w * (1 - model["y"][near])).sum(axis=1) * down
        total = good + bad
        score[rows] = np.where(total > 0, good / np.where(total > 0, total, 1), model["share"])
    return np.clip(score, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict | None:
    """The model, from at most ``sample`` documents of each label."""
    prepare(docs.sparkSession)
    truth = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1))
             .groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.min("quality").alias("y")))
    shares = {r["y"]: r["n"] for r in truth.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    chosen = None
    for y in sorted(shares):
        part = truth.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return None
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # at most 2 x sample ids; one text per id, so that repeated rows don't pass the bound
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                x = terms(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array([r.tobytes() for r in x], pa.binary())], names=["y", "x"])

    rows = found.select(F.col("y").cast("int").alias("y"), "text").mapInArrow(run, "y int, x binary").toArrow()
    if not rows.num_rows:
        return None
    x = np.stack([np.frombuffer(r.as_py(), np.float32) for r in rows.column("x")])
    order = np.lexsort(x.T[:8])  # any order of arrival gives the same model
    return fit(x[order], rows.column("y").to_numpy()[order], shares.get(1, 0) / sum(shares.values()))


def scored(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        use = shared.value
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                score = vote(use, terms(data, offsets)) if use else np.full(j - i, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")).mapInArrow(run, "doc_id bigint, score double")
