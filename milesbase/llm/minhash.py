"""MinHash near-dedup: one-permutation hashing, optimal densification, star-shaped candidates.

1. A document's set is its distinct word shingles, as 64-bit hashes. One hash per shingle fills
   ``BANDS * ROWS`` bins with their smallest member; an empty bin takes the value of the first filled bin
   of its own fixed random probe sequence (optimal densification). ``ROWS`` bins make a band key.
2. Rows with equal sets are one class, under a number of its own: ids only come in at the end, where the components of
   one id are joined and named by their smallest id.
3. In each bucket of classes every member is paired with the one of the smallest id only (a star), so a bucket of
   n gives n - 1 pairs. Pairs are confirmed on the full sets: 100 * intersection >= percent * union.
4. Members that a star leaves outside their bucket's main component meet further members of it, one per bucket and
   round (again stars), while that leaves more than a few comparisons per member.
   Those still outside then meet the members of other components by the rarest elements in which they differ from the
   majority (``residue_pairs``), which loses no link. After
   that any two members of any bucket are connected or known to be too far apart, so stars lose no link that the
   buckets hold. With 32 bands of 5 rows, a pair at similarity 0.8 shares no bucket with a probability of 3e-6.
5. Components: repeated hooking to the smallest neighbour with pointer jumping, each round a written table.

Scale: hot buckets and hot classes only ever meet partial aggregates and equi-joins whose skewed partitions
Spark splits. Nothing is collected; only row counts of rounds reach the driver.

Edge cases: null or empty texts have an empty set, are linked with nothing and kept; rows with a null id are
linked with nothing, have no component and are kept; rows that share an id are one document (the links of all their
texts add up, and each has the same component); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milesbase.llm.common import free_name, prepare, staged
from milesbase.llm.hashing import U, mixed, shingle_sets, stream, text_slices, word_hashes

BANDS, ROWS = 32, 5
PROBES = 64
FEW = 2
MAX_TURNS = 6
FEATURES = "id bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>"


def densified(sets: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Signatures (rows x bins) of rows with at least one element; ``sets`` sorted within rows."""
    rows = len(counts)
    row = np.repeat(np.arange(rows), counts)
    place = ((sets >> U(32)) * U(bins)) >> U(32)
    first = np.ones(len(sets), bool)
    first[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1])
    sig = np.zeros((rows, bins), np.uint64)
    full = np.zeros((rows, bins), bool)
    sig[row[first], place[first].astype(np.int64)] = sets[first]
    full[row[first], place[first].astype(np.int64)] = True
    own, filled = sig.copy(), full.copy()
    probes = stream(bins * PROBES, 53).reshape(PROBES, bins) % U(bins)
    for p in probes.astype(np.int64):
        if filled.all():
            break
        take = ~filled & full[:, p]
        sig[take] = own[:, p][take]
        filled |= take
    if not filled.all():  # hardly ever: the next filled bin to the right, in a circle
        for r in np.flatnonzero(~filled.all(axis=1)):
            have = np.flatnonzero(full[r])
            empty = np.flatnonzero(~filled[r])
            sig[r, empty] = own[r, have[np.searchsorted(have, empty) % len(have)]]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    weights = stream(rows, 71) | U(1)
    with np.errstate(over="ignore"):
        keys = (mixed(sig).reshape(len(sig), bands, rows) * weights).sum(axis=2, dtype=np.uint64)
        return mixed(keys + stream(bands, 89))


def fingerprints(sets: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each row's set, 0 for an empty one."""
    f1, f2, some = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), n > 0
    if some.any():
        starts = (np.cumsum(n) - n)[some]
        with np.errstate(over="ignore"):
            f1[some] = np.add.reduceat(mixed(sets + U(101)), starts)
            f2[some] = np.bitwise_xor.reduceat(mixed(sets + U(103)), starts)
    return f1, f2


def features(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, n (set size), f1 and f2 (fingerprint of the set), bands (null for an empty set)."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in text_slices(batch.column(1)):
                sets, n = shingle_sets(*word_hashes(data, offsets), size)
                some = n > 0
                f1, f2 = fingerprints(sets, n)
                keys = np.zeros((0, BANDS), np.uint64)
                if some.any():
                    keys = band_keys(densified(sets, n[some], BANDS * ROWS), BANDS, ROWS)
                at = np.concatenate([[0], np.cumsum(some) * BANDS]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(at), pa.array(keys.reshape(-1).view(np.int64)), mask=pa.array(~some))
                yield pa.RecordBatch.from_arrays(
                    [ids[i:j], pa.array(n.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), bands],
                    names=["id", "n", "f1", "f2", "bands"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, FEATURES)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """docs: id, text -> id, f1, f2, n, items (sorted distinct shingle hashes)."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                sets, n = shingle_sets(*word_hashes(data, offsets), size)
                at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(at), pa.array(sets.view(np.int64)))
                f1, f2 = (pa.array(f.view(np.int64)) for f in fingerprints(sets, n))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], f1, f2, pa.array(n.astype(np.int64)), items],
                                                 names=["id", "f1", "f2", "n", "items"])

    return docs.mapInArrow(run, "id bigint, f1 bigint, f2 bigint, n bigint, items array<bigint>")


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) with linked (confirmed on the full sets)."""
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    sized = pairs.join(right, "b").join(left, "a").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    union = F.col("sum") - F.col("both")
    return sized.select("a", "b", (F.lit(100) * F.col("both") >= F.lit(percent) * union).alias("linked"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges (a, b) -> node, root: every node of an edge with the smallest id of its component."""
    spark = edges.sparkSession
    live = staged(edges.where("a <> b").distinct(), f"{name}-edges")
    roots = None
    while True:
        both = live.select("a", "b").union(live.select(F.col("b"), F.col("a")))
        up = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), f"{name}-up")
        if up.isEmpty():
            break
        while True:  # jump to the parent's parent until all point at a root
            parent = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            nxt = staged(up.join(parent, "root").select("node", F.col("top").alias("root"), (F.col("top") < F.col("root")).alias("moved")), f"{name}-jump")
            up = nxt.select("node", "root")
            if nxt.where("moved").isEmpty():
                break
        roots = up if roots is None else staged(
            roots.join(up.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root")), f"{name}-roots")
        a, b = up.toDF("a", "ra"), up.toDF("b", "rb")
        live = staged(live.join(a, "a").join(b, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
    return roots if roots is not None else spark.createDataFrame([], "node bigint, root bigint")


def _by_root(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between nodes as links between their roots."""
    return (links.select("a", "b").join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with their root replaced by the root's own, where it has one."""
    top = roots.toDF("root", "_top")
    return rows.join(top, "root", "left").withColumn("root", F.coalesce("_top", "root")).drop("_top")


def _merged(roots: DataFrame, top: DataFrame) -> DataFrame:
    """node, root: both mappings one after the other."""
    new = top.join(roots.select("node"), "node", "left_anti")
    return _rooted(roots, top).select("node", "root").union(new.select("node", "root"))


def _near_size(x: str, y: str, percent: int):
    return F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)


def residue_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) between members (g, rep, root, inside) of a group g that its component holds (``inside``) and those outside,
    and among the latter; no pair at ``percent`` or more that would join two components is missing.

    Let B be the elements that most sets of the group hold and D(x) the symmetric difference of x and B. With
    F(x) = (100 + p) |D(x)| - (100 - p) |x|, a pair is linked if and only if 2 (100 + p) |D(x) & D(y)| >= F(x) + F(y). So

    * a pair of disjoint differences is linked if F(x) + F(y) <= 0, and then both are linked to the member of least F: one pair each;
    * any other linked pair shares at least k elements of the differences, where k follows from a set's own F and the least F that
      it can meet, and hence one of the |D| - k + 1 rarest elements of each. Only those are joined, by (group, element), and
      only while the elements left after the shared one could still make up the number needed.

    The differences of near copies are small, mostly their own, and rarest first, so few sets meet."""
    up, down = 100 + percent, 100 - percent
    own = staged(members.join(sets, "rep"), "minhash-own")
    sizes = own.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
    freq = own.select("g", F.explode("items").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("c")).where("c > 1").join(sizes, "g")
    freq = staged(freq.select("g", "e", (2 * F.col("c") > F.col("m")).alias("common"), F.when(2 * F.col("c") > F.col("m"), F.col("m") - F.col("c"))
                              .otherwise(F.col("c")).alias("w")), "minhash-frequencies")
    base = freq.where("common").groupBy("g").agg(F.collect_list("e").alias("base"))  # no longer than two sets of the group
    own = own.join(base, "g", "left").withColumn("base", F.coalesce("base", F.array().cast("array<bigint>")))
    own = own.select("g", "rep", "root", "inside", F.size("items").alias("n"), F.concat(F.array_except("items", "base"), F.array_except("base", "items")).alias("d"))
    own = staged(own.withColumn("f", F.size("d").cast("bigint") * up - F.col("n") * down), "minhash-differences")
    least = own.groupBy("g").agg(F.min("f").alias("least"), F.min(F.when(~F.col("inside"), F.col("f"))).alias("least_out"),
                                 F.min_by(F.struct(F.col("rep").alias("to"), F.col("root").alias("to_root")), F.struct("f", "rep")).alias("best"))
    own = own.join(least, "g")
    sure = own.where((F.col("f") + F.col("least") <= 0) & (F.col("root") != F.col("best.to_root"))).select("rep", F.col("best.to").alias("to"))

    k = F.ceil((F.col("f") + F.when(F.col("inside"), F.col("least_out")).otherwise(F.col("least"))) / F.lit(2.0 * up) - 1e-9)
    rows = own.select("g", "rep", "root", "inside", "n", "f", F.size("d").alias("size"), (F.size("d") - F.greatest(k, F.lit(1)) + 1).alias("prefix"), F.explode("d").alias("e"))
    # what only one member differs in stands first in the order and meets nobody
    rows = rows.where("prefix > 0").join(freq.where("w > 1").select("g", "e", "w"), ["g", "e"])
    mine = Window.partitionBy("g", "rep")
    after = F.count(F.lit(1)).over(mine) - F.row_number().over(mine.orderBy("w", "e"))
    rows = rows.withColumn("after", after).where("size - after <= prefix").select("g", "e", "rep", "root", "inside", "n", "f", "after")
    rows = staged(rows, "minhash-prefixes")
    x = rows.where("NOT inside").select("g", "e", *[F.col(c).alias(f"x_{c}") for c in ("rep", "root", "n", "f", "after")])
    fits = F.lit(2 * up) * (1 + F.least("x_after", "after")) >= F.col("x_f") + F.col("f")
    y = rows.select("*")
    pairs = x.join(y, (x["g"] == y["g"]) & (x["e"] == y["e"]) & (x["x_root"] != y["root"]) & (y["inside"] | (x["x_rep"] < y["rep"]))
                   & fits & _near_size("x_n", "n", percent)).select(F.col("x_rep").alias("rep"), F.col("rep").alias("to"))
    return sure.union(pairs).select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id, kept: a row per row of ``docs``."""
    prepare(docs.sparkSession)
    feats = staged(features(docs, id_col, text_col, size), "minhash-features")
    real = feats.where("id IS NOT NULL AND n > 0")
    classes = real.groupBy("f1", "f2", "n").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")  # numbers fixed by being written

    slots = classes.select("id", "rep", "n", F.explode("bands").alias("key"))
    stars = slots.groupBy("key").agg(F.min(F.struct("id", "rep", "n")).alias("star"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = staged(slots.join(stars, "key").select("key", "rep", "n", F.col("star.rep").alias("star"), F.col("star.n").alias("star_n")), "minhash-members")

    wanted = classes.join(members.select("rep").distinct(), "rep", "left_semi").select("id", "f1", "f2", "n", "rep")
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    of_class = ["id", "f1", "f2", "n"]  # an id can stand for several classes, one for each of its texts
    sets = full_sets(texts.join(wanted, "id", "left_semi"), size).dropDuplicates(of_class)
    sets = staged(sets.join(wanted, of_class).select("rep", "items"), "minhash-sets")

    pairs = members.where((F.col("rep") != F.col("star")) & _near_size("n", "star_n", percent)).select(
        F.col("star").alias("a"), F.col("rep").alias("b")).distinct()
    first = staged(compared(pairs, sets, percent), "minhash-stars")
    roots = components(first.where("linked").select("a", "b"), "minhash-first")
    known = staged(_rooted(members.select("key", "rep", "n", F.col("rep").alias("root")), roots), "minhash-known")

    turn, before = 0, None
    while True:
        main = (known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
                .groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("inside"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("roots"))
                .where("roots > 1"))
        main = staged(main, "minhash-main")
        work, rows = main.agg(F.coalesce(F.sum((F.col("m") - F.col("inside")) * F.col("m")), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
        # the pairwise rest is small, or has stopped shrinking
        if work <= FEW * rows or turn == MAX_TURNS or (before is not None and work > 0.7 * before):
            break
        turn, before = turn + 1, work
        inside = known.join(main.select("key", "main"), "key")
        centre = inside.where("root = main").groupBy("key").agg(
            F.min_by(F.struct(F.col("rep").alias("c"), F.col("n").alias("cn")), F.xxhash64("rep", F.lit(turn))).alias("c"))
        again = inside.where("root <> main").join(centre, "key").select("rep", "n", "c.c", "c.cn").where(_near_size("n", "cn", percent))
        again = again.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()
        links = compared(again, sets, percent).where("linked")
        top = components(_by_root(links, roots), f"minhash-turn{turn}")
        roots = staged(_merged(roots, top), "minhash-roots")
        known = staged(_rooted(known, top), "minhash-known")

    rest = known.join(main.select("key", "main"), "key").select(F.col("main").alias("g"), "rep", "root", (F.col("root") == F.col("main")).alias("inside"))
    more = residue_pairs(rest.distinct(), sets, percent)
    top = components(_by_root(compared(more, sets, percent).where("linked"), roots), "minhash-second")

    final = classes.select("f1", "f2", "n", "rep").join(roots.toDF("rep", "root"), "rep", "left")
    final = final.withColumn("root", F.coalesce("root", "rep")).join(top.toDF("root", "top"), "root", "left")
    final = final.select("f1", "f2", "n", F.coalesce("top", "root").alias("root"))
    rows = real.select("id", "f1", "f2", "n").join(final, ["f1", "f2", "n"]).select("id", F.col("n").alias("n_shingles"), "root")
    rows = staged(rows, "minhash-rows")
    # rows that share an id are one document: their components are joined
    several = rows.groupBy("id").agg(F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z").select("id", "a")
    rows = _rooted(rows, components(rows.join(several, "id").select("a", F.col("root").alias("b")), "minhash-ids"))
    rows = rows.join(rows.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("id", "n_shingles", "component_id")
    rest = feats.where("id IS NULL OR n = 0").select("id", F.col("n").alias("n_shingles"))
    shared = rows.join(rest.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("component_id").alias("c"))
    rest = rest.join(shared, "id", "left").select("id", "n_shingles", F.coalesce("c", "id").alias("component_id"))
    return rows.union(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` with one document of each group of near duplicates (the one with the smallest id)."""
    key = free_name(docs, "_gone")
    gone = near_duplicates(docs, id_col, **kw).where("NOT kept").select(F.col("id").alias(key)).distinct()
    return docs.join(gone, docs[f"`{id_col}`"].cast("bigint") == gone[key], "left_anti")
