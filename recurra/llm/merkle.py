"""Merkle manifest of a table: a leaf for every row, a tree for every group of rows, a tree over the groups' roots, and proofs.

Leaves are put in order by a range sort, which splits a group of any size over tasks, and numbered by their places in the sorted
partitions. A pass then builds several levels at once: a slot pivot. Nodes are grouped by the parent that many levels up, and conditional
aggregates spread them into one column a slot. Concatenating neighbouring columns and hashing gives the nodes of the levels
above; the columns beside a slot's own are its siblings. What remains after a pass is smaller by the number of slots. Back
down, a parent's path is handed to its slots, so a path moves once for all nodes under it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import all_columns
from recurra.operators.joins import lookup_join
from recurra.session import cut_lineage

FANOUT = 2
# At most so many columns a pass.
SLOTS = 16
# Steps of a path: what stands left and right of a node among its parent's children.
_STEP = "struct<left:string,right:string>"
_NO_PATH = f"array<{_STEP}>"


def framed(value: Column) -> Column:
    """`-` for null, else the bytes of the value, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts that are not null, one after the other."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def leaf_digest(*values: Column) -> Column:
    return digest(*map(framed, values))


def group_key(value: Column) -> Column:
    """A text that is never null and sorts as the value does by its bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` with `place`, from 0 on in every `grp` by `order`, and `size`, the nodes of the group.

    The sorted rows are written to the shared folder; a row's place is its number in its partition, less that of the group's first row there,
    plus the group's rows in the partitions before. One row a group and partition is all that a window sees.
    """
    inside = (1 << 33) - 1
    placed = cut_lineage(nodes.orderBy("grp", *order)).withColumn("_number", F.monotonically_increasing_id())
    placed = placed.select(*all_columns(nodes), F.shiftright("_number", 33).alias("_part"), F.col("_number").bitwiseAND(inside).alias("_number"))
    runs = placed.groupBy("grp", "_part").agg(F.min("_number").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("grp", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias("size"))
    # As many rows as partitions and groups: broadcast if a count shows that these are few.
    joined = lookup_join(placed, runs, ["grp", "_part"])
    return joined.select(*all_columns(nodes), (F.col("_number") + F.col("_shift")).alias("place"), "size")


def _joined(nodes: list[Column]) -> Column:
    """The parent of a run of columns; none without any child."""
    return F.when(nodes[0].isNotNull(), digest(*nodes))


@dataclass
class _Pass:
    """A pivot: its rows (grp, place, size, the slots) and how many levels it builds."""

    rows: DataFrame
    levels: int


def _pivot(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """(grp, place, size, s0 ... ): the nodes under each parent `levels` up, one a slot; what each carries comes along."""
    slots = fanout**levels
    child = F.struct("digest", "carried") if "carried" in nodes.columns else F.struct("digest")
    slot = F.pmod(F.col("place"), F.lit(slots))
    spread = [F.any_value(F.when(slot == s, child), True).alias(f"s{s}") for s in range(slots)]
    parent = F.call_function("div", F.col("place"), F.lit(slots).cast("bigint"))
    return nodes.groupBy("grp", parent.alias("parent")).agg(F.any_value("size").alias("size"), *spread).withColumnRenamed("parent", "place")


def _levels_of(rows: DataFrame, levels: int, fanout: int) -> tuple[list[list[Column]], Column, DataFrame]:
    """The nodes of every level above the slots as columns, how many of the levels a group of the row's size needs, and the rows with them."""
    known: list[list[Column]] = [[F.col(f"s{s}.digest") for s in range(fanout**levels)]]
    for level in range(1, levels + 1):
        below = known[-1]
        names = [f"n{level}_{i}" for i in range(len(below) // fanout)]
        rows = rows.select("*", *[_joined(below[i * fanout: (i + 1) * fanout]).alias(name) for i, name in enumerate(names)])
        known.append([F.col(name) for name in names])
    needed = sum((F.when(F.col("size") > fanout**level, 1).otherwise(0) for level in range(levels)), F.lit(0))
    return known, needed, rows


def _steps(known: list[list[Column]], slot: int, levels: int, fanout: int) -> Column:
    """A slot's path to the top of its row: on each level the columns of its run without its own."""
    steps = []
    for level in range(levels):
        own = slot // fanout**level
        first = own - own % fanout
        run = known[level][first: first + fanout]
        left, right = run[: own - first], run[own - first + 1:]
        steps.append(F.struct(F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right")))
    return F.array(*steps)


def _built(nodes: DataFrame, fanout: int) -> tuple[DataFrame, list[_Pass]]:
    """(grp, digest) of every group's root, and the passes from the leaves up. `nodes` is (grp, place, size, digest, carried)."""
    passes: list[_Pass] = []
    whole = max(1, int(math.log(SLOTS, fanout) + 1e-9))
    most = nodes.agg(F.max("size")).first()[0] or 1
    while True:
        height, reach = 0, 1
        while reach < most:
            height, reach = height + 1, reach * fanout
        levels = max(1, min(whole, height))
        rows = cut_lineage(_pivot(nodes, levels, fanout))
        passes.append(_Pass(rows, levels))
        known, needed, above = _levels_of(rows, levels, fanout)
        top = F.coalesce(*[F.when(needed == level, known[level][0]) for level in range(levels + 1)])
        slots = F.lit(fanout**levels).cast("bigint")
        size = F.call_function("div", F.col("size") + slots - 1, slots)
        nodes = above.select("grp", "place", size.alias("size"), top.alias("digest"))
        most = -(-most // fanout**levels)
        if most <= 1:
            return nodes.select("grp", "digest"), passes


def _paths(passes: list[_Pass], roots: DataFrame, fanout: int) -> DataFrame:
    """(grp, carried, digest, path) of every leaf; `roots` is (grp, path above the group's root)."""
    paths = roots.select("grp", F.lit(0).cast("bigint").alias("place"), "path")
    for number, step in reversed(list(enumerate(passes))):
        # Joined before the levels are hashed again, so that only slots and paths move.
        known, needed, rows = _levels_of(step.rows.join(paths, ["grp", "place"]), step.levels, fanout)
        slots = fanout**step.levels
        children = [
            F.struct(
                (F.col("place") * slots + s).alias("place"), F.slice(_steps(known, s, step.levels, fanout), 1, needed).alias("own"), F.col(f"s{s}").alias("node")
            )
            for s in range(slots)
        ]
        found = rows.select("grp", "path", F.array(*children).alias("children"))
        spread = found.select("grp", "path", F.explode(F.filter("children", lambda c: c["node"].isNotNull())).alias("child"))
        path = F.concat("child.own", "path").alias("path")
        if number == 0:
            return spread.select("grp", "child.node.carried", "child.node.digest", path)
        paths = spread.select("grp", "child.place", path)
    raise ValueError("a tree has at least one pass")


def with_proofs(leaves: DataFrame, *, fanout: int = FANOUT) -> DataFrame:
    """(grp, carried, digest, path, subroot, root): for every leaf its path to the root over all groups, its group's root, and that.

    `leaves` is (grp, ordinal, digest, carried); leaves of a group are in order of `ordinal`, then of the digest, groups in order of
    their keys. A group of one leaf is its own root, and so is a single group.
    """
    placed = numbered(leaves.select("grp", "ordinal", "digest", "carried"), ["ordinal", "digest"])
    subroots, passes = _built(placed, fanout)
    subroots = cut_lineage(subroots)
    # All groups are one group of the tree above them.
    tops = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("carried"), "digest"), ["carried"])
    root, top_passes = _built(tops, fanout)
    root = cut_lineage(root)
    paths = _paths(top_passes, root.select("grp", F.array().cast(_NO_PATH).alias("path")), fanout)
    named = paths.join(root.select("grp", F.col("digest").alias("root")), "grp")
    of_groups = cut_lineage(named.select(F.col("carried").alias("grp"), F.col("digest").alias("subroot"), "root", "path"))
    found = _paths(passes, of_groups.select("grp", "path"), fanout)
    return lookup_join(found, of_groups.select("grp", "subroot", "root"), "grp")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda below, step: digest(step["left"], below, step["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings, level by level, left to right; of nothing where there are none."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def is_tampered(doc_id: Column, every: int = 7) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def manifest(docs: DataFrame, *, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of documents.

    A leaf covers doc_id, source, lang, n_chars and text, nulls apart from empty texts; texts of any length are hashed where they are read and do not move. A
    tree is built for each lang, over its leaves by doc_id (null ids first; rows of one id by their leaves, so that repeated rows
    stand together), and one over the langs, null first and by bytes. folded_root is made from the siblings and the leaf again, after n_chars of every
    seventh id (by crc32) has grown by one, and verified says whether that is the root: such rows are not unless their n_chars is
    null. Other columns are not read. No rows: no rows.
    """
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = leaf_digest(*values[:3], F.when(is_tampered(values[0]), values[3] + 1).otherwise(values[3]), values[4])
    carried = F.struct("doc_id", F.when(is_tampered(values[0]), changed).alias("changed"))
    leaves = docs.select(group_key(F.col("lang")).alias("grp"), F.col("doc_id").alias("ordinal"), leaf_digest(*values).alias("digest"), carried.alias("carried"))
    found = with_proofs(leaves, fanout=fanout)
    again = folded(F.coalesce("carried.changed", "digest"), F.col("path"))
    result = found.select(
        "carried.doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root")
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
