"""A Merkle manifest of a dataset: one tree per source, one tree over the sources' roots, a proof per row.

Rows are leaves in the order of their ids; every ``FANOUT`` consecutive nodes of a level become their parent.
**Checkpoint and recompute:** only every ``STRIDE``-th level is stored, as a table of (tree, at, node).  A stored node and the
``FANOUT ** STRIDE`` stored descendants below it are one aligned subtree, the unit of all work: building hashes a
subtree up to its top and keeps the top alone; extracting proofs goes down from the highest stored level, makes the
missing nodes of each subtree again from its stored descendants, emits every descendant's siblings and lets them go.
So a hot source is many subtrees over all tasks, a task holds one of at most 729 nodes, and
storage beyond the leaves is a 729th.

The positions come from one sort by ranges: every range numbers its own rows, and adds what the earlier ranges
hold of the same tree (one row per range and tree).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichlab.llm.common import stored

FANOUT = 3
#: Levels from one stored level to the next.
STRIDE = 6

STEPS = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of a row: each value as ``bytes:value``, null as ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_key(column: Column) -> Column:
    """A key that is never null and sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("+"), column.cast("string")), F.lit(""))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(steps: Column) -> Column:
    """All siblings of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def levels_above(n: int, most: int) -> int:
    """Levels from ``n`` nodes up to a single one, at most ``most``."""
    h = 0
    while n > 1 and h < most:
        n, h = -(-n // FANOUT), h + 1
    return h


def climb(nodes: list[str], levels: int) -> Iterator[list[str]]:
    """A subtree's levels, the given nodes first, its top last."""
    yield nodes
    for _ in range(levels):
        nodes = [digest(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        yield nodes


@dataclass
class Forest:
    """Trees over ordered rows.  ``levels[0]`` has a row per leaf (tree, at, node, n and what it carries), ``levels[j]`` a row per node
    ``j * stride`` levels up; ``n`` is the number of the tree's nodes on that level.  A tree is left out above the
    level on which it has one node."""

    levels: list[DataFrame]
    stride: int

    def roots(self) -> DataFrame:
        """(tree, node) of every tree."""
        tops = [level.filter("n = 1").select("tree", "node") for level in self.levels]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out


def number(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at``, their place in ``tree`` by ``order`` (nulls first), and ``n``, the rows of the tree."""
    keys = ["tree", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the id grows with the row inside a range and has the range in its upper bits; written once, so it is final
    ranged = stored(ranged.withColumn("_seq", F.monotonically_increasing_id()), "ranged").withColumn("_range", F.shiftright("_seq", 33))
    held = ranged.groupBy("tree", "_range").agg(F.min("_seq").alias("_first"), F.count("*").alias("_held"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("_held").over(by_tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("tree", "_range", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_held").over(by_tree).alias("n"))
    return ranged.join(held, ["tree", "_range"]).withColumn("at", F.col("_seq") - F.col("_first") + F.col("_before")).drop("_seq", "_range", "_first", "_before")


def _subtrees(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on whole subtrees: rows of one (tree, block) come together, in the order of ``at``."""
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            tree, block = both.column("tree"), both.column("block")
            last = both.num_rows - 1
            here = tree[last], block[last]
            while last and (tree[last - 1], block[last - 1]) == here:
                last -= 1
            if last:
                yield work(both.slice(0, last))
            held = both.slice(last)
        if held is not None:
            yield work(held)

    return rows.mapInArrow(run, schema)


def _cuts(batch: pa.RecordBatch) -> list[int]:
    """Where the subtrees of a batch begin, and its end."""
    tree = batch.column("tree").dictionary_encode().indices.to_numpy()
    block = batch.column("block").to_numpy()
    return [0, *(np.flatnonzero((np.diff(tree) != 0) | (np.diff(block) != 0)) + 1).tolist(), batch.num_rows]


def build_forest(leaves: DataFrame, stride: int = STRIDE) -> Forest:
    """``leaves`` (numbered) and every ``stride``-th level above them, each stored."""
    levels = [stored(leaves, "level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    size = FANOUT**stride

    def tops(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts, node, n = _cuts(batch), batch.column("node").to_pylist(), batch.column("n").to_numpy()
        starts = pa.array(cuts[:-1])
        *_, top = zip(*(list(climb(node[a:b], levels_above(int(n[a]), stride)))[-1] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True)
        above = -(-n[cuts[:-1]] // size)
        return pa.RecordBatch.from_arrays([batch.column("tree").take(starts), batch.column("block").take(starts), pa.array(top, pa.string()), pa.array(above)], ["tree", "at", "node", "n"])

    while most > 1:
        below = levels[-1].filter("n > 1").select("tree", F.expr(f"at div {size}").alias("block"), "at", "node", "n")
        levels.append(stored(_subtrees(below, tops, "tree string, at long, node string, n long"), "level"))
        most = -(-most // size)
    return Forest(levels, stride)


def forest_proofs(forest: Forest, above: DataFrame) -> DataFrame:
    """The leaves with ``steps``, the siblings on the way to the root, and ``top``, the root of their tree.
    ``above`` (tree, steps) leads on from each tree's root."""
    size, stride = FANOUT**forest.stride, forest.stride
    proofs = None
    for level in reversed(forest.levels):
        carried = [c for c in level.columns if c not in ("tree", "at", "node", "n")]
        ends = level.filter("n = 1").select("tree", F.lit(0).cast("long").alias("at"), F.col("node").alias("top")).join(above, "tree")
        parents = ends if proofs is None else ends.unionByName(proofs.select("tree", "at", "top", "steps"))
        nothing = [F.lit(None).cast(level.schema[c].dataType).alias(c) for c in carried]
        parents = parents.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("node"), F.lit(None).cast("long").alias("n"), "steps", "top", *nothing)
        rows = level.select("tree", F.expr(f"at div {size}").alias("block"), "at", "node", "n", F.lit(None).cast(STEPS).alias("steps"), F.lit(None).cast("string").alias("top"), *carried)
        kinds = ", ".join(f"`{c}` {level.schema[c].dataType.simpleString()}" for c in carried)
        proofs = _subtrees(parents.unionByName(rows), lambda batch: _emit_siblings(batch, stride), f"tree string, at long, node string, steps {STEPS}, top string" + (f", {kinds}" if kinds else ""))
    return proofs


def _emit_siblings(batch: pa.RecordBatch, stride: int) -> pa.RecordBatch:
    """Proofs of the nodes of whole subtrees; the first row of each is the proof of the subtree's top."""
    cuts, node, n = _cuts(batch), batch.column("node").to_pylist(), batch.column("n").to_pylist()
    steps, top = batch.column("steps"), batch.column("top").to_pylist()
    before, after, ends, tops, keep = [], [], [0], [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        upper = steps[a].as_py()
        upper_before, upper_after = [s["before"] for s in upper], [s["after"] for s in upper]
        height = levels_above(n[a + 1], stride)
        whole = list(climb(node[a + 1 : b], height))
        for i in range(b - a - 1):
            at = i
            for nodes in whole[:-1]:
                first = at - at % FANOUT
                before.append("".join(nodes[first:at]))
                after.append("".join(nodes[at + 1 : first + FANOUT]))
                at //= FANOUT
            before += upper_before
            after += upper_after
            ends.append(len(before))
            tops.append(top[a])
        keep += range(a + 1, b)
    rows = pa.array(keep, pa.int64())
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"]))
    names = batch.schema.names
    carried = [c for c in names if c not in ("tree", "block", "at", "node", "n", "steps", "top")]
    out = {"tree": batch.column("tree").take(rows), "at": batch.column("at").take(rows), "node": batch.column("node").take(rows), "steps": listed.cast(_STEPS), "top": pa.array(tops, pa.string())}
    out |= {c: batch.column(c).take(rows) for c in carried}
    return pa.RecordBatch.from_arrays(list(out.values()), list(out))


@dataclass
class Manifest:
    """A forest over the rows, a tree over its roots, and the root of all (None for no rows)."""

    rows: Forest
    sources: Forest
    root: str | None
    id_col: str


def build_manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), carry: Mapping[str, Column] | None = None, stride: int = STRIDE) -> Manifest:
    """The manifest of ``docs``; ``columns`` are what a leaf commits to, ``carry`` are further columns that come back with the proofs.

    Null values are hashed as such; null sources are one source, the first.  Ids ascend, nulls first; rows of one id
    are ordered by their digests, so repeated rows are as many leaves, in an order that does not matter.  An empty table has no
    root.  The texts are read once.
    """
    more = {f"c_{k}": v for k, v in (carry or {}).items()}
    leaves = docs.select(tree_key(F.col(source_col)).alias("tree"), F.col(id_col).alias("_id"), leaf_digest([F.col(c) for c in columns]).alias("node"), *[v.alias(k) for k, v in more.items()])
    rows = build_forest(number(stored(leaves, "leaves"), ["_id", "node"]), stride)
    roots = rows.roots().select(F.lit("").alias("tree"), F.col("tree").alias("_source"), "node")
    sources = build_forest(number(roots, ["_source"]), stride)
    root = sources.roots().first()
    return Manifest(rows, sources, root and root.node, id_col)


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: the id, ``leaf``, ``subroot`` (its source's), ``root``, ``steps`` (per level the siblings before and after the
    node, empty where it has none) and the carried columns.  ``fold(leaf, steps)`` is the root."""
    spark = manifest.rows.levels[0].sparkSession
    start = spark.createDataFrame([("", [])], f"tree string, steps {STEPS}")
    above = forest_proofs(manifest.sources, start).select(F.col("_source").alias("tree"), "steps")
    proofs = forest_proofs(manifest.rows, above)
    carried = [F.col(c).alias(c[2:]) for c in proofs.columns if c.startswith("c_")]
    return proofs.select(F.col("_id").alias(manifest.id_col), F.col("node").alias("leaf"), F.col("top").alias("subroot"), F.lit(manifest.root).cast("string").alias("root"), "steps", *carried)
