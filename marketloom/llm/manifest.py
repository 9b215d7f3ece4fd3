"""Merkle manifest of a dataset, and a recursive climb that proves rows against its root.

Each row is a leaf. Leaves of a group ascend by id; while several nodes remain, every ``ARITY`` consecutive
ones become their digest. What remains is the group's subroot; the subroots, ordered by group, make the
root in the same way.

Built levels are node rows: a node's key, its parent's key, and the digests of the siblings to its left and
to its right. A proof is a climb along the parents: a Spark recursive query starts from the leaves, joins the
node row, appends the siblings, folds the digest of the leaf with them and goes on from the parent, from the
group's tree into the tree of subroots, until no node row is left: the root.

Leaves that lie side by side share their way up. So the lowest ``BLOCK_LEVELS`` levels of a tree are built and
climbed inside a block, one row of at most ``ARITY ** BLOCK_LEVELS`` leaves, and the recursive query carries
blocks: an array with the folded digest of every leaf, and the siblings, once. Nodes above many leaves would be
hot keys of the climb's join, so it has two legs: below nodes with more than one in ``HOT_SHARE`` of all leaves
it is a plain join, from there on the node rows, at most ``HOT_SHARE`` a level, are broadcast.

Leaves are numbered by a range sort on group, id and leaf, with counts for each part and group, so neither a
group nor the order of groups passes through one task.

Digests are SHA-256, hashed as lower-case hex text, carried as 32 bytes.

Defined results
    null fields: framed as ``-``, unlike empty ones. Null group: a group of its own, the first. Null ids: before
    others. Rows with equal ids: by leaf; equal rows: leaves of their own, in any order. One group: its
    subroot is the root. One leaf: it is the subroot. No siblings: the proof is the digest of the empty text.
    Empty table: no rows. Other columns: not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import Stage

ARITY = 3
BLOCK_LEVELS = 4
HOT_SHARE = 512
TOP = -1  # the number of the tree of subroots
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
NODE = ["tree", "level", "node"]


def framed(value: Column) -> Column:
    """A field's value behind its length in bytes; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[framed(v) for v in values]))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def listed(digests: Column) -> Column:
    """The hex text of an array of digests."""
    return F.array_join(F.transform(digests, hexed), "")


def numbered(stage: Stage, name: str, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``place`` (from 0 inside their group) and ``size`` (of the group), by a range sort.

    ``order`` must tell all rows of a group apart for the numbers to be the same in every run.
    """
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    kept = stage.keep(name, sorted_rows.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    runs = kept.groupBy(group, part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    by_group = Window.partitionBy(group)
    before = by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col(group).alias("of"), F.col("part").alias("in"), F.col("first"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(by_group).alias("size"),
    )
    joined = kept.join(runs, F.col(group).eqNullSafe(F.col("of")) & (F.shiftright("at", 33) == F.col("in")))
    return joined.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("place"), "size")


def height(n: Column, levels: int = 40) -> Column:
    """How often ``n`` nodes are grouped until one is left."""
    return sum((F.when(n > F.lit(ARITY**k).cast("decimal(38,0)"), 1).otherwise(0) for k in range(levels)), F.lit(0))


def parents_in(level: Column) -> Column:
    """The digests above an array of digests."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int")), lambda i: digest(listed(F.slice(level, i * ARITY + 1, ARITY))))


class Manifest:
    """The nodes of all trees, each level written once."""

    def __init__(self, leaves: DataFrame, group: str, order: list[str], leaf: str, changed: str, keep: list[str]):
        """``leaves`` hold the digests ``leaf`` and ``changed`` (what is to be proven), and ``keep`` columns."""
        self.stage = stage = Stage(leaves.sparkSession, "manifest")
        self.keep, self.group = keep, group
        placed = stage.keep("placed", numbered(stage, "leaves", leaves, group, [*order, leaf]))
        # Trees are numbered in the order of their groups.
        of_groups = placed.filter("place = 0").select(F.col(group), F.col("size").alias("n"), F.lit(0).alias("one"))
        trees = numbered(stage, "trees", of_groups, "one", [group]).select(
            F.col(group).alias("of"), "n", F.col("place").alias("tree"), F.col("size").alias("n_trees"), height(F.col("n")).alias("height")
        )
        self.trees = stage.keep("numbered", trees)
        n = self.trees.agg(F.max("height"), F.max("n_trees"), F.sum("n")).first()
        self.height, self.n_trees, self.n_leaves = n[0] or 0, n[1] or 0, n[2] or 0
        self._blocks(placed, leaf, changed)
        self._nodes()

    def _blocks(self, placed: DataFrame, leaf: str, changed: str) -> None:
        """Blocks of leaves side by side: ``levels`` of digests above them, and where they go on."""
        width = ARITY**BLOCK_LEVELS
        member = F.struct("place", F.col(leaf).alias("leaf"), F.col(changed).alias("changed"), *self.keep)
        blocks = placed.groupBy(self.group, F.floor(F.col("place") / width).alias("block")).agg(F.array_sort(F.collect_list(member)).alias("leaves"))
        blocks = blocks.join(self.trees, F.col(self.group).eqNullSafe(F.col("of"))).drop("of")
        up = F.least(F.col("height"), F.lit(BLOCK_LEVELS))
        blocks = blocks.withColumn("up", up).withColumn("level0", F.col("leaves.leaf"))
        for k in range(1, BLOCK_LEVELS + 1):
            blocks = blocks.withColumn(f"level{k}", F.when(F.col("up") >= k, parents_in(F.col(f"level{k - 1}"))).otherwise(F.col(f"level{k - 1}")))
        self.blocks = self.stage.keep("blocks", blocks.withColumn("top", F.element_at(f"level{BLOCK_LEVELS}", 1)))

    def _level_up(self, level: DataFrame, k: int, name: str) -> tuple[DataFrame, DataFrame]:
        """Nodes of the next level, and the node rows of this one. ``n``: nodes of the tree on this level."""
        child = F.struct("node", "digest", "weight")
        runs = level.groupBy("tree", "n", "height", F.floor(F.col("node") / ARITY).alias("parent")).agg(F.array_sort(F.collect_list(child)).alias("run"))
        runs = self.stage.keep(name, runs.withColumn("digest", digest(listed(F.col("run.digest")))))
        weight = F.aggregate("run.weight", F.lit(0).cast("long"), lambda a, w: a + w)
        above = runs.select("tree", F.ceil(F.col("n") / ARITY).alias("n"), "height", F.col("parent").alias("node"), "digest", weight.alias("weight"))
        # The node above the last run of a tree is a leaf of the tree of subroots.
        last = (F.col("n") <= ARITY) & (F.col("tree") != TOP)
        place = F.posexplode("run").alias("i", "c")
        nodes = runs.select("*", place).select(
            "tree", F.lit(k).alias("level"), F.col("c.node").alias("node"), F.col("c.weight").alias("weight"),
            F.when(last, F.lit(TOP)).otherwise(F.col("tree")).alias("parent_tree"),
            F.when(last, F.lit(0)).otherwise(F.lit(k + 1)).alias("parent_level"),
            F.when(last, F.col("tree")).otherwise(F.col("parent")).alias("parent_node"),
            F.expr("slice(run.digest, 1, i)").alias("left"), F.expr("slice(run.digest, i + 2, size(run))").alias("right"),
        )
        return above, nodes

    def _climb_levels(self, level: DataFrame, first: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
        """Node rows from a level up, and the subroots of trees that end on the way."""
        nodes, roots, k = [], [], first
        while True:
            roots.append(level.filter("n = 1"))
            level = level.filter("n > 1")
            if level.isEmpty():
                return nodes, roots
            level, rows = self._level_up(level, k, f"{name}{k}")
            nodes.append(rows)
            k += 1

    def _nodes(self) -> None:
        tops = self.blocks.select(
            "tree", F.ceil(F.col("n") / ARITY ** F.col("up")).alias("n"), "height", F.col("block").alias("node"), F.col("top").alias("digest"),
            F.size("leaves").cast("long").alias("weight"),
        )
        nodes, roots = self._climb_levels(tops, BLOCK_LEVELS, "tree")
        subroots = _union(roots).select("tree", "digest", "weight")
        self.subroots = self.stage.keep("subroots", subroots)
        top = self.subroots.select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(self.n_trees).cast("long").alias("n"), F.lit(0).alias("height"),
            F.col("tree").alias("node"), "digest", "weight",
        )
        more, root = self._climb_levels(top, 0, "top")
        self.root = root[-1].select("digest") if root else top.select("digest")
        self.nodes = self.stage.keep("nodes", _union([*nodes, *more])) if nodes or more else None

    def root_digest(self) -> bytes | None:
        row = self.root.first()
        return bytes(row[0]) if row else None


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@contextmanager
def _whole_recursion(spark: SparkSession):
    """No bound on the rows of a recursive query run inside."""
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


# Each step folds every leaf of a block with the siblings of the node it has come to.
CLIMB = """
    WITH RECURSIVE climb(origin, block, tree, level, node, folded, siblings) MAX RECURSION LEVEL 200 AS (
        SELECT origin, block, tree, level, node, folded, siblings FROM {blocks}
        UNION ALL
        SELECT c.origin, c.block, n.parent_tree, n.parent_level, n.parent_node,
               transform(c.folded, h -> unhex(sha2(cast(concat(n.left_hex, lower(hex(h)), n.right_hex) AS binary), 256))),
               concat(c.siblings, n.`left`, n.`right`)
        FROM climb c JOIN (
            SELECT *, array_join(transform(`left`, s -> lower(hex(s))), '') AS left_hex, array_join(transform(`right`, s -> lower(hex(s))), '') AS right_hex
            FROM {nodes}
        ) n ON n.tree = c.tree AND n.level = c.level AND n.node = c.node
    )
    SELECT * FROM climb
"""


def climb(stage: Stage, name: str, blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """The blocks at the first place of their way up that is none of the nodes."""
    spark = blocks.sparkSession
    with _whole_recursion(spark):
        way = stage.keep(f"{name}-way", spark.sql(CLIMB, blocks=blocks, nodes=nodes))
    out = stage.keep(name, way.join(F.broadcast(nodes) if name == "high" else nodes, NODE, "left_anti"))
    stage.drop(f"{name}-way")
    return out


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: the kept columns, ``leaf``, ``subroot``, ``root``, ``siblings`` (left to right, from the leaf up), ``folded``."""
    stage, blocks = manifest.stage, manifest.blocks
    if not manifest.n_leaves:
        root = F.lit(None).cast("binary")
        none = F.array().cast("array<binary>").alias("siblings")
        return blocks.select(F.explode("leaves").alias("l")).select(
            "l.leaf", *[F.col(f"l.{c}") for c in manifest.keep], root.alias("subroot"), root.alias("root"), none, root.alias("folded")
        )

    # Inside a block: leaf i is node i // ARITY ** k of level k, and its siblings are the others of its run.
    def siblings_of(i: Column, k: int, side: str) -> Column:
        at = F.floor(i / ARITY**k).cast("int")
        first = at - at % ARITY
        level = F.col(f"level{k}")
        if side == "left":
            return F.slice(level, first + 1, at - first)
        return F.slice(level, at + 2, first + ARITY - 1 - at)

    def fold(k: int):
        return lambda h, i: digest(F.concat(listed(siblings_of(i, k, "left")), hexed(h), listed(siblings_of(i, k, "right"))))

    def append(k: int):
        return lambda s, i: F.concat(s, siblings_of(i, k, "left"), siblings_of(i, k, "right"))

    lower = blocks.withColumn("folded", F.col("leaves.changed")).withColumn("own", F.transform("leaves", lambda _: F.array().cast("array<binary>")))
    for k in range(BLOCK_LEVELS):
        inside = F.col("up") > k
        for column, step in (("folded", fold(k)), ("own", append(k))):
            lower = lower.withColumn(column, F.when(inside, F.transform(column, step)).otherwise(F.col(column)))
    ends = F.col("height") <= BLOCK_LEVELS
    anchor = lower.select(
        F.col("tree").alias("origin"), "block", "folded", "own", F.col("leaves"),
        F.when(ends, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.when(ends, F.lit(0)).otherwise(F.lit(BLOCK_LEVELS)).alias("level"),
        F.when(ends, F.col("tree")).otherwise(F.col("block")).cast("long").alias("node"),
    )
    anchor = stage.keep("anchor", anchor)
    at = anchor.select("origin", "block", *NODE, "folded", F.array().cast("array<binary>").alias("siblings"))
    if manifest.nodes is not None:
        hot = F.col("weight") * HOT_SHARE > manifest.n_leaves
        at = climb(stage, "low", at, manifest.nodes.filter(~hot))
        # At most HOT_SHARE nodes of each level are this heavy.
        at = climb(stage, "high", at, F.broadcast(manifest.nodes.filter(hot)))
    at = at.select("origin", "block", F.col("folded").alias("at_root"), F.col("siblings").alias("shared"))
    subroots = manifest.subroots.select(F.col("tree").alias("origin"), F.col("digest").alias("subroot"))
    root = F.lit(manifest.root_digest()).cast("binary").alias("root")
    joined = anchor.select("origin", "block", "leaves", "own").join(at, ["origin", "block"]).join(subroots, "origin")
    each = joined.select("subroot", root, "shared", F.explode(F.arrays_zip("leaves", "own", "at_root")).alias("l"))
    return each.select(
        "l.leaves.leaf", *[F.col(f"l.leaves.{c}") for c in manifest.keep], "subroot", "root",
        F.concat("l.own", "shared").alias("siblings"), F.col("l.at_root").alias("folded"),
    )


def manifest(
    rows: DataFrame, group: str, id_col: str, fields: Sequence[str], tampered: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of a table. ``tampered``: values of fields that a proof is to be tried with."""
    tampered = tampered or {}
    held = rows.select(
        F.col(group).alias("of_group"), F.col(id_col).alias("id"),
        row_digest([F.col(f) for f in fields]).alias("leaf"), row_digest([tampered.get(f, F.col(f)) for f in fields]).alias("changed"),
    )
    stage = Stage(rows.sparkSession, "manifest")
    return Manifest(stage.keep("rows", held), "of_group", ["id"], "leaf", "changed", ["id"])
