"""Merkle dataset manifest: trees of three-way hashes per source, and a recursive climb that checks every leaf.

1. *Leaves.* A row's leaf is the SHA-256 of its fields, each ``-`` if null, else byte count, ``:`` and value. The leaves of a
   source are numbered by id; range partitioning and counts per partition number them, so a source may hold any share
   of the rows.
2. *Levels.* Three consecutive nodes become the hash of their digests (hex text), until one is left, the subroot. The
   subroots, by source, build the root in the same way. Each level is written as node rows: place of the node (floor, tree,
   position), its siblings' digests, and the link to its parent. Floor 0 holds the leaves; a subroot is a node of the first
   floor of the tree of subroots.
3. *Climb.* Recursive queries ascend from every leaf: a step joins the row's node, appends the siblings to the proof and folds
   the leaf's (tampered) hash with them. ``RISE`` floors are chained into one step, since Spark writes each step to
   shuffle files. Floors of many nodes are joined by shuffle, and there a node has few leaves below it; floors of at
   most ``FLOOR`` nodes (counted first) are broadcast, so no task ever gathers the leaves of one high node.

Scale: nothing but node counts and the root reaches the driver; a broadcast holds at most 3 * ``FLOOR`` nodes. A row of the climb
is its leaf's number, its place, the folded hash and two digests per floor so far.

Edge cases: null fields hash as ``-``; a null id is ordered first and never tampered with; rows that share source and id are
ordered by their leaf; a null source is a source of its own (first); texts of any length are hashed whole; an empty table
gives an empty result; a single row is leaf, subroot and root with an empty proof. Extra columns don't enter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import staged
from milesbase.operators.numbering import numbered

ARITY = 3
FLOOR = 10_000
RISE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE = ["floor", "tree", "pos"]
TOP = -1  # number of the tree of subroots


def hex_text(data: Column) -> Column:
    return F.lower(F.hex(data))


def digest(data: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def joined(run: Column) -> Column:
    """The digests of an array of structs with a field ``hash``, one after the other."""
    return F.unhex(F.array_join(F.transform(run, lambda x: F.hex(x["hash"])), ""))


def leaf_of(*fields: Column) -> Column:
    """Digest of fields, each ``-`` if null, else its byte count, ``:`` and its value as text."""
    texts = [c.cast("string") for c in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts]))


def levels(n: int) -> int:
    """Steps from a leaf to the root of ``n`` leaves."""
    d = 0
    while n > 1:
        n, d = -(-n // ARITY), d + 1
    return d


@dataclass
class Manifest:
    """``leaves``: node rows of floor 0 with the rows' other columns (``lone``: the leaf is the subroot); ``floors``: node rows of the
    floors above; ``subroots``: tree, subroot (32 bytes); ``root``: hex text; ``first``, ``top``: floors of the subroots and of the root."""

    leaves: DataFrame
    floors: dict[int, DataFrame]
    subroots: DataFrame
    root: str | None
    first: int
    top: int


def _grown(level: DataFrame, depth: int, base: int, end: tuple[int, Column, Column], extra: list[str], name: str):
    """``level`` (tree, n, pos, hash, extra), trees of ``n`` > 1 nodes, built up by ``depth`` levels. Returns the node rows by floor and
    the list of the trees' last nodes. ``end`` is the place of a tree's last node."""
    floors, lasts = {}, []
    for k in range(depth):
        also = extra if k == 0 else []
        runs = level.groupBy("tree", "n", F.expr(f"pos div {ARITY}").alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash", *[f"`{c}`" for c in also]))).alias("run"))
        runs = staged(runs.withColumn("hash", digest(hex_text(joined(F.col("run"))))), name)
        last = F.col("n") <= ARITY
        up = [F.when(last, F.lit(e) if isinstance(e, int) else e).otherwise(o) for e, o in zip(end, (F.lit(base + k + 1), F.col("tree"), F.col("up")))]
        me = F.col("me")
        floors[base + k] = runs.select("*", F.explode("run").alias("me")).select(
            F.lit(base + k).alias("floor"), "tree", me["pos"].alias("pos"), up[0].alias("up_floor"), up[1].alias("up_tree"), up[2].alias("up_pos"),
            joined(F.filter("run", lambda x: x["pos"] < me["pos"])).alias("l"), joined(F.filter("run", lambda x: x["pos"] > me["pos"])).alias("r"),
            me["hash"].alias("hash"), *[me[c].alias(c) for c in also])
        above = runs.select("tree", F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"), F.col("up").alias("pos"), "hash")
        lasts.append(above.where("n = 1").select("tree", "hash"))
        level = above.where("n > 1")
    return floors, lasts


def build(rows: DataFrame, group: str, order: list[str], leaf: str) -> Manifest:
    """Manifest of stored ``rows``: a tree for each ``group`` whose leaves (column ``leaf``, 32 bytes) ascend by ``order``. The names of a
    manifest's columns must be free in ``rows``."""
    sizes = staged(rows.groupBy(F.col(f"`{group}`").alias("grp")).agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    trees = staged(numbered(sizes, [], ["grp"], "tree"), "merkle-trees")
    n_trees, largest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    depth, top_depth = levels(largest), levels(n_trees)
    first, top = depth + 1, depth + 1 + top_depth

    placed = numbered(rows, [group], order)
    extra = [c for c in rows.columns if c != leaf]
    placed = staged(placed.join(trees, placed[f"`{group}`"].eqNullSafe(trees["grp"])).drop("grp").withColumnRenamed(leaf, "hash"), "merkle-leaves")
    to_top = (first, F.lit(TOP).cast("bigint"), F.col("tree"))
    floors, lasts = _grown(placed.where("n > 1"), depth, 0, to_top, extra, "merkle-level")
    alone = placed.where("n = 1")
    nothing = F.lit(b"").cast("binary")
    leaves = alone.select(F.lit(0).alias("floor"), "tree", "pos", F.lit(first).alias("up_floor"), to_top[1].alias("up_tree"), to_top[2].alias("up_pos"),
                          nothing.alias("l"), nothing.alias("r"), "hash", *[f"`{c}`" for c in extra], F.lit(True).alias("lone"))
    if depth:
        leaves = floors.pop(0).withColumn("lone", F.lit(False)).union(leaves)
    subroots = staged(reduce(DataFrame.union, lasts, alone.select("tree", "hash")), "merkle-subroots")

    ground = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), F.col("tree").alias("pos"), "hash")
    above, lasts = _grown(ground, top_depth, first, (top, F.lit(TOP).cast("bigint"), F.lit(0).cast("bigint")), [], "merkle-top")
    root = (lasts[-1] if lasts else subroots).select(hex_text(F.col("hash"))).first()
    return Manifest(leaves, floors | above, subroots.withColumnRenamed("hash", "subroot"), root[0] if root else None, first, top)


def _chained(floors: list[DataFrame], starts: int) -> DataFrame:
    """Node rows of every RISE-th floor with the path of up to RISE floors above: place, steps (siblings), near (the same as bytes), up."""
    nodes = reduce(DataFrame.union, [f.select(*PLACE, "up_floor", "up_tree", "up_pos", "l", "r") for f in floors])
    rows = nodes.where((F.col("floor") - starts) % RISE == 0).select(
        *PLACE, "up_floor", "up_tree", "up_pos", F.array(F.struct("l", "r")).alias("steps"))
    following = nodes.select(*[F.col(c).alias(f"up_{c}") for c in PLACE], *[F.col(f"up_{c}").alias(f"to_{c}") for c in PLACE], "l", "r")
    for _ in range(min(RISE, len(floors)) - 1):
        rows = rows.join(following, [f"up_{c}" for c in PLACE], "left").select(
            *PLACE, *[F.coalesce(f"to_{c}", f"up_{c}").alias(f"up_{c}") for c in PLACE],
            F.when(F.col("l").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(F.struct("l", "r")))).alias("steps"))
    near = F.unhex(F.array_join(F.transform("steps", lambda s: F.concat(F.hex(s["l"]), F.hex(s["r"]))), ""))
    return rows.withColumn("near", near)


CLIMB = """
WITH RECURSIVE climb (tree0, pos0, floor, tree, pos, folded, proof) AS (
  SELECT tree0, pos0, floor, tree, pos, folded, proof FROM {start}
  UNION ALL
  SELECT HINT c.tree0, c.pos0, n.up_floor, n.up_tree, n.up_pos,
         aggregate(n.steps, c.folded, (h, s) -> unhex(sha2(CAST(lower(hex(concat(s.l, h, s.r))) AS BINARY), 256))),
         concat(c.proof, n.near)
  FROM climb c JOIN {nodes} n ON c.floor = n.floor AND c.tree = n.tree AND c.pos = n.pos)
SELECT * FROM climb WHERE floor >= LAST"""


def climbed(m: Manifest, start: Column) -> DataFrame:
    """tree, pos, folded (hex text) and proof_sha256 of every leaf; ``start``: the digest that each leaf is replaced by."""
    spark = m.leaves.sparkSession
    fold = digest(hex_text(F.concat("l", start, "r")))
    rows = m.leaves.select(F.col("tree").alias("tree0"), F.col("pos").alias("pos0"), F.col("up_floor").alias("floor"), F.col("up_tree").alias("tree"),
                           F.col("up_pos").alias("pos"), F.when(F.col("lone"), start).otherwise(fold).alias("folded"), F.concat("l", "r").alias("proof"))
    big = {f: t.count() > FLOOR for f, t in m.floors.items()}
    order = sorted(big)
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and big[order[j]] == big[order[i]]:
            j += 1
        part = order[i:j]
        last = order[j] if j < len(order) else m.top
        nodes = staged(_phase(m, part), "merkle-chains")
        hint = "" if big[part[0]] else "/*+ BROADCAST(n) */"
        query = spark.sql(CLIMB.replace("HINT", hint).replace("LAST", str(last)), start=rows, nodes=nodes)
        limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
        spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # every leaf must arrive
        try:
            rows = staged(query, "merkle-climb")
        finally:
            spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
        i = j
    return rows.where(F.col("floor") == m.top).select(F.col("tree0").alias("tree"), F.col("pos0").alias("pos"), hex_text(F.col("folded")).alias("folded"),
                                                      F.sha2(hex_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"))


def _phase(m: Manifest, part: list[int]) -> DataFrame:
    """Chains over the floors of a phase; the sources' trees and the tree of subroots start chains of their own."""
    halves = [f for f in part if f < m.first], [f for f in part if f >= m.first]
    return reduce(DataFrame.union, [_chained([m.floors[f] for f in fs], fs[0]) for fs in halves if fs])


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text",
             tampered: Column | None = None) -> tuple[DataFrame, Manifest]:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root (hex text) and verified; and the manifest.
    ``tampered``: the text to check against the manifest (default: as it is), an expression over ``docs``."""
    cols = {c: F.col(f"`{c}`") for c in fields}
    leaf = leaf_of(*cols.values())
    other = leaf if tampered is None else leaf_of(*[tampered if c == text_col else x for c, x in cols.items()])
    same = F.lit(True) if tampered is None else tampered.eqNullSafe(cols[text_col])
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").alias("source"), leaf.alias("leaf"),
                       F.when(~same, other).alias("tampered"))
    m = build(staged(rows, "merkle-rows"), "source", ["doc_id", "leaf"], "leaf")
    found = climbed(m, F.coalesce("tampered", "hash"))
    out = m.leaves.select("tree", "pos", "doc_id", hex_text(F.col("hash")).alias("leaf")).join(found, ["tree", "pos"])
    out = out.join(m.subroots.select("tree", hex_text(F.col("subroot")).alias("subroot")), "tree")
    root = F.lit(m.root).cast("string")
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", F.col("folded").alias("folded_root"),
                      (F.col("folded") == root).alias("verified")), m
