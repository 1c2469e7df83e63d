"""Merkle manifest of a dataset, and an audit of changed rows by path copying.

Each row is a leaf: the SHA-256 of its columns, each ``-`` if null, else its
size in bytes, ``:`` and its value. Leaves of a group ascend by key; while
several nodes remain, runs of ``ARITY`` become one (a last run may be
shorter). What remains is the group's root; the groups' roots, ordered by
name, give the root of the dataset likewise.

Positions come from a range partitioning with running offsets, so a hot group
is spread over many tasks. The tree is cut into aligned blocks of
``ARITY ** LEVELS`` nodes: a block is built in one task and hands its top
node on, tops are cut into blocks again, until one node is left. On the way
down each block is told the untouched siblings above it, so its leaves know
their whole paths.

The tree is persistent: a changed leaf makes a version of its own, which
copies only the leaf's ancestors and shares every other node. Inside the
block the copies are made on the block's nodes; above it the version goes on
along the siblings that the block was told, level by level to the dataset's
root, so no version builds a tree again. ``copies`` returns those nodes.

Nulls: a null key sorts first, a null group before all others. Ties: rows
under one key ascend by their leaf; repeated rows are leaves of their own.
An empty table has no rows and no root. Only the given columns are read,
whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import sequence_numbers
from .common import ship, stored
from .graph import runs

#: children of a node
ARITY = 3
#: levels of a block: 3 ** 7 = 2,187 nodes in its lowest
LEVELS = 7

SIBLINGS = "array<struct<left:string,right:string>>"
HEADER = f"grp string, block long, above {SIBLINGS}, subroot string, root string"


def leaf_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of the columns' values, sizes included."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*(part(c) for c in columns)), 256)


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Block:
    """The nodes of an aligned part of a tree, level by level."""

    def __init__(self, nodes: list[str], first: bool, levels: int):
        """first: the group's first block, which ends where one node is left;
        any other has ``levels`` levels above its nodes."""
        self.levels = [nodes]
        while len(self.levels[-1]) > 1 or not first and len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([_digest("".join(below[s : s + ARITY])) for s in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, i: int) -> list[tuple[str, str]]:
        """What stands left and right of node ``i`` and its ancestors, upwards."""
        out = []
        for level in self.levels[:-1]:
            s = i - i % ARITY
            out.append(("".join(level[s:i]), "".join(level[i + 1 : s + ARITY])))
            i //= ARITY
        return out


def version(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """The nodes that a version with this leaf copies, up to its root; all
    others are shared."""
    out = []
    for left, right in path:
        leaf = _digest(left + leaf + right)
        out.append(leaf)
    return out


def _tops(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Nodes (grp, block, pos, digest) -> the top of each block, a node of the step above."""
    for (group, block), rows in runs(batches, 2):
        top = Block(rows.column("digest").to_pylist(), block == 0, levels).top
        yield pa.RecordBatch.from_arrays([pa.array([group]), pa.array([block], pa.int64()), pa.array([top])], names=["grp", "pos", "digest"])


def _aligned(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**levels}"))


def _steps(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (grp, pos, digest) and the tops of their blocks, step by step
    up to one node a group."""
    out = [nodes]
    while True:
        dealt = _aligned(out[-1], levels).select("grp", "block", "pos", "digest").repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
        out.append(stored(dealt.mapInArrow(lambda it: _tops(it, levels), "grp string, pos long, digest string"), "tops"))
        if not out[-1].agg(F.max("pos")).first()[0]:
            return out


def _down(batches: Iterator[pa.RecordBatch], levels: int, finish: Callable) -> Iterator[pa.RecordBatch]:
    """Each block's header (pos -1: siblings above, group's top and root) and nodes."""
    for (_, block), rows in runs(batches, 2):
        head, nodes = rows.slice(0, 1).to_pylist()[0], rows.slice(1)
        tree = Block(nodes.column("digest").to_pylist(), block == 0, levels)
        above = [(p["left"], p["right"]) for p in head["above"]]
        yield finish(head, nodes, tree, above)


def _told(head: dict, nodes: pa.Table, tree: Block, above: list) -> pa.RecordBatch:
    """Headers of the blocks whose tops these nodes are."""
    n = nodes.num_rows
    paths = [[{"left": a, "right": b} for a, b in tree.siblings(i) + above] for i in range(n)]
    cols = [pa.array([head["grp"]] * n), nodes.column("pos").combine_chunks(), pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))]
    cols += [pa.array([head["subroot"]] * n, pa.string()), pa.array([head["root"]] * n, pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=["grp", "block", "above", "subroot", "root"])


def _audited(head: dict, nodes: pa.Table, tree: Block, above: list, copies: bool) -> pa.RecordBatch:
    proofs, folded, made = [], [], []
    upper = "".join(a + b for a, b in above)
    leaves = nodes.column("digest").to_pylist()
    found = nodes.column("found").to_pylist()
    for i, (leaf, now) in enumerate(zip(leaves, found, strict=True)):
        path = tree.siblings(i)
        proofs.append(_digest("".join(a + b for a, b in path) + upper))
        changed = version(now, path + above) if now is not None else []
        folded.append(changed[-1] if changed else now or head["root"])
        made.append(changed)
    n = len(leaves)
    cols = [nodes.column("doc_id").combine_chunks(), pa.array(leaves), pa.array([head["subroot"]] * n), pa.array([head["root"]] * n), pa.array(proofs), pa.array(folded), pa.array([f == head["root"] for f in folded])]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    if copies:
        cols.append(pa.array(made, pa.list_(pa.string())))
        names.append("copies")
    return pa.RecordBatch.from_arrays(cols, names=names)


#: what the lowest step's rows carry besides grp, block, pos and digest
LEAF = {"doc_id": "long", "found": "string"}


def _below(nodes: DataFrame, headers: DataFrame, levels: int, finish: Callable, schema: str, extra: dict[str, str]) -> DataFrame:
    """One step down: blocks of ``nodes`` under their ``headers`` (grp, block, above, subroot, root)."""
    none = {"above": SIBLINGS, "subroot": "string", "root": "string"}
    rows = _aligned(nodes, levels).select("grp", "block", "pos", "digest", *extra, *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    tops = headers.select("grp", "block", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), *(F.lit(None).cast(t).alias(c) for c, t in extra.items()), *none)
    both = rows.unionByName(tops).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    return both.mapInArrow(lambda it: _down(it, levels, finish), schema)


def _walk(steps: list[DataFrame], headers: DataFrame, levels: int) -> DataFrame:
    """Headers of the blocks under the lowest of the steps, from those of the highest."""
    for nodes in reversed(steps):
        headers = _below(nodes, headers, levels, _told, HEADER, {})
    return headers


def _numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    return sequence_numbers(rows, key, order).withColumn("pos", F.col("seq") - 1).drop("seq")


def audit(docs: DataFrame, columns: list[str], found: dict[str, Column], key: str = "doc_id", group: str = "source", copies: bool = False, levels: int = LEVELS) -> DataFrame:
    """Per row: key (as doc_id), leaf, subroot, root, proof_sha256 (SHA-256 of
    the siblings on its way to the root), folded_root (from the leaf as the
    columns ``found`` have it now and the siblings) and verified; with
    ``copies`` the digests that its version copies, empty if unchanged."""
    ship(docs.sparkSession)
    was = leaf_digest([F.col(c) for c in columns])
    now = leaf_digest([found.get(c, F.col(c)) for c in columns])
    # a name that sorts as the group does, null first
    name = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = docs.select(name.alias("grp"), F.col(key).cast("long").alias("doc_id"), was.alias("digest"), now.alias("found"))
    leaves = leaves.withColumn("found", F.when(F.col("found") != F.col("digest"), F.col("found")))
    leaves = stored(_numbered(leaves, "grp", ["doc_id", "digest"]), "leaves")
    steps = _steps(leaves.select("grp", "pos", "digest"), levels)
    tops = steps.pop().select("grp", "digest")
    groups = stored(_numbered(tops.withColumn("all", F.lit("")), "all", ["grp"]).select("grp", "pos", "digest"), "groups")
    upper = _steps(groups.select(F.lit("").alias("grp"), "pos", "digest"), levels)
    # the header of the root's block, of the groups' tops, of the leaves' blocks
    first, above, none = F.lit(0).cast("long").alias("block"), F.expr(f"CAST(array() AS {SIBLINGS})").alias("above"), F.lit(None).cast("string").alias("subroot")
    told = _walk(upper[:-1], upper[-1].select("grp", first, above, none, F.col("digest").alias("root")), levels)
    told = told.select(F.col("block").alias("pos"), "above", "root")
    headers = stored(groups.join(told, "pos").select("grp", first, "above", F.col("digest").alias("subroot"), "root"), "group-headers")
    headers = stored(_walk(steps[1:], headers, levels), "headers")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _below(leaves, headers, levels, lambda *a: _audited(*a, copies), schema + ", copies array<string>" * copies, LEAF)
