"""Merkle manifest of a table: a subtree per group of rows, a tree over the groups, and a proof for each row.

The rows of a group are numbered in order and cut into aligned blocks of ``fanout ** levels``
leaves.  A block hashes its own subtree.  Then blocks meet in a butterfly: in round r those whose
numbers differ only in digit r (base ``fanout``) swap the roots of the subtrees they lie in.  Each
hashes the common ancestor itself and keeps what it received as the next step of its proof, so
every block ends with its path to the root and nothing is sent down again.  Where the last
subtree has fewer blocks than its siblings, its blocks also answer in place of the missing ones.
The groups' roots go through the same rounds.  All of it is DataFrame functions; what meets in a
round is at most ``fanout`` rows, and a block is bounded by its size, however large a group is.

A run of fewer nodes, even one, is hashed like a full one; a group of one row has its leaf as
root, and a single group's root is the root of all.

Defined results: a null group is a group of its own and the first; rows without an order value
come first in their group; rows that agree in group and order go by their digest, repeated rows
are leaves each; an empty table has no rows and no root; columns named ``subroot``, ``root`` or
``proof`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adrlens.llm.common import join_small, numbered, written
from adrlens.session import intermediates

FANOUT = 3
LEVELS = 7
FEW = 500_000  # rows that may be broadcast


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for null, else byte count, colon, value."""
    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value), F.lit(":"), value))

    return digest(F.concat(*map(part, values)))


def folded(start: Column, proof: Column) -> Column:
    """Root that a leaf and a proof lead to."""
    return F.aggregate(proof, start, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def siblings(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _step(nodes: Column, own: Column, fanout: int) -> Column:
    """What stands left and right of node ``own`` (from 0) in its run, from all nodes of a level."""
    first = (own - own % fanout).cast("int")
    return F.struct(F.array_join(F.slice(nodes, first + 1, (own % fanout).cast("int")), "").alias("left"),
                    F.array_join(F.slice(nodes, own.cast("int") + 2, (fanout - 1 - own % fanout).cast("int")), "").alias("right"))


def _parents(nodes: Column, fanout: int) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / fanout).cast("int") - 1)
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * fanout + 1, fanout), "")))


def _subtrees(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Columns ``level0`` ... of all nodes of a block's subtree, and its ``top``."""
    blocks = blocks.withColumn("level0", F.transform("leaves", lambda leaf: leaf["digest"]))
    for i in range(levels):
        nodes = F.col(f"level{i}")
        blocks = blocks.withColumn(f"level{i + 1}", F.when((F.size(nodes) > 1) | (F.col("blocks") > 1),
                                                          _parents(nodes, fanout)).otherwise(nodes))
    return blocks.withColumn("top", F.element_at(f"level{levels}", 1))


def butterfly(state: DataFrame, most: int, fanout: int) -> DataFrame:
    """(group, block, root, path) from (group, block, blocks, root): rounds of swapped subtree roots.

    ``most``: the largest number of blocks of a group.
    """
    state = state.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    reach = 1  # blocks below a node of this round's level
    while reach < most:
        nodes = F.ceil(F.col("blocks") / reach)
        own, low = F.floor(F.col("block") / reach), F.col("block") % reach
        last = F.col("blocks") - (nodes - 1) * reach  # blocks of the last node
        stands_in = (own == nodes - 1) & (own % fanout > 0) & (last < reach)
        lows = F.when(stands_in, F.sequence(low, F.lit(reach - 1).cast("long"), last)).otherwise(F.array(low))
        sent = (state.withColumns({"above": F.floor(F.col("block") / (reach * fanout)), "own": low})
                .withColumn("low", F.explode(lows))
                .withColumn("member", F.struct(
                    (F.floor(F.col("block") / reach) % fanout).alias("digit"), "root", "block",
                    F.when(F.col("low") == F.col("own"), F.col("path")).alias("path"),
                    (F.col("low") != F.col("own")).alias("guest"))))
        met = sent.groupBy("group", "blocks", "above", "low").agg(F.sort_array(F.collect_list("member")).alias("met"))
        roots = F.transform("met", lambda m: m["root"])
        met = (met.withColumns({"roots": roots, "whole": digest(F.array_join(roots, ""))})
               .withColumn("moves", F.ceil(F.col("blocks") / reach) > 1)
               .select("*", F.posexplode("met").alias("place", "own")).where("not own.guest"))
        step = F.array(_step(F.col("roots"), F.col("place"), fanout))
        state = met.select(
            "group", F.col("own.block").alias("block"), "blocks",
            F.when(F.col("moves"), F.col("whole")).otherwise(F.col("own.root")).alias("root"),
            F.when(F.col("moves"), F.concat("own.path", step)).otherwise(F.col("own.path")).alias("path"))
        reach *= fanout
    return state.select("group", "block", "root", "path")


def manifest(rows: DataFrame, group_column: str, order_column: str, digest_column: str, fanout: int = FANOUT,
             levels: int = LEVELS) -> DataFrame:
    """``rows`` with the root of their group, the root of all and a proof.

    ``proof`` has a step per level from the leaf to the root: the digests ``left`` and ``right`` of
    the node in its run, joined.
    """
    with intermediates(rows.sparkSession):
        blocks, paths = _blocks_and_paths(rows, group_column, order_column, digest_column, fanout, levels)
    own = _subtrees(join_small(blocks, paths, ["group", "block"], "inner", FEW), fanout, levels)

    def proof(at: Column) -> Column:
        steps = [F.when((F.size(f"level{i}") > 1) | (F.col("blocks") > 1),
                        _step(F.col(f"level{i}"), F.floor(at / fanout ** i), fanout)) for i in range(levels)]
        return F.concat(F.filter(F.array(*steps), lambda s: s.isNotNull()), F.col("path"))

    proved = F.transform("leaves", lambda leaf, at: F.struct(leaf["row"].alias("row"), proof(at).alias("proof")))
    return (own.select("subroot", "root", F.explode(proved).alias("own"))
            .select("own.row.*", "subroot", "root", "own.proof"))


def _blocks_and_paths(rows: DataFrame, group_column: str, order_column: str, digest_column: str, fanout: int,
                      levels: int) -> tuple[DataFrame, DataFrame]:
    """(group, block, blocks, leaves), and (group, block, subroot, root, path)."""
    size = fanout ** levels
    group = F.when(F.col(group_column).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group_column).cast("string")))
    kept = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    leaves = written(rows.select(group.alias("group"), F.col(order_column).alias("order"),
                                 F.col(digest_column).alias("digest"), F.struct(*kept).alias("row")), "leaves")
    leaves = numbered(leaves, "group", ["order", "digest"], "numbered-leaves")
    blocks = written(
        leaves.withColumns({"block": F.floor(F.col("at") / size), "blocks": F.ceil(F.col("size") / size)})
        .groupBy("group", "block", "blocks")
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "row")),
                          lambda a, b: (a["at"] - b["at"]).cast("int")).alias("leaves")), "blocks", result=True)
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    tops = _subtrees(blocks, fanout, levels).select("group", "block", "blocks", F.col("top").alias("root"))
    upper = written(butterfly(tops, most, fanout), "block-paths")

    subroots = upper.where("block = 0").select(F.col("group").alias("name"), F.col("root").alias("subroot"))
    subroots = numbered(subroots.withColumn("group", F.lit("")), "group", ["name"], "numbered-groups")
    subroots = written(subroots.select("group", "name", "subroot", F.col("at").alias("block"), F.col("size").alias("blocks")),
                       "subroots")
    groups = subroots.agg(F.max("blocks")).first()[0] or 0
    over = butterfly(subroots.select("group", "block", "blocks", F.col("subroot").alias("root")), groups, fanout)
    over = written(subroots.select("name", "subroot", "block").join(over.drop("group").withColumnRenamed("path", "over"), "block")
                   .drop("block").withColumnRenamed("name", "group"), "group-paths")
    paths = (join_small(upper.drop("root"), over, "group", "inner", FEW)
             .select("group", "block", "subroot", "root", F.concat("path", "over").alias("path")))
    return blocks, written(paths, "paths", result=True)
