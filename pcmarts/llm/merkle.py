"""Merkle dataset manifest by cogrouped subtree exchange: leaf digests, subroots, one root, a proof per row.

A row's leaf is the SHA-256 of its columns, each `-` if null, else byte count, colon, value. The leaves of a tree (one per value of a
column) ascend by their order column; runs of FAN consecutive nodes become the digest of their hex digests until one is left, the
subroot. Subroots in the order of their trees' names (null first, by bytes) are the leaves of the tree that ends in the root.

Positions. Rows are dealt by range over tree and order, sorted there and written; a row's place is its place in its part plus the rows
of its tree in the parts before. A tree that holds most of the rows is many parts, and equal rows are salted over several.

Exchange. SPAN = FAN**DEPTH consecutive nodes are a superblock. Going up, each superblock is reduced by itself to one node, and these
are the nodes of the next layer, SPAN times smaller. Going down, a layer's nodes and the outer nodes that their superblock requires
(its own proof, one row) are cogrouped by superblock; one applyInPandas finishes the local reduction, joins local and outer siblings
into each node's proof, and at the leaves folds the proof too. A task never holds more than one superblock.

A proof is the siblings' hex digests in one string, level by level from the leaf, left to right, and `places`: for each level the place
of the node in its run and the run's length ("3/8 0/2"). fold() needs nothing else.

Nulls: null columns are `-`; null trees are a tree of their own, null orders come first. Ties of the order column stand in the order of
their leaves; rows that are equal throughout are interchangeable and each is a leaf. An empty table has no rows and no root. Columns
that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.llm.common import saved

FAN, DEPTH = 8, 4
SPAN = FAN**DEPTH
SALTS = 1 << 10  # equal rows are dealt over so many places


def leaf(*columns: Column) -> Column:
    """The leaf digest of a row."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels(nodes: list[str], whole: bool) -> list[list[str]]:
    """The nodes and what they are reduced to: to a single one if they are the whole tree, else DEPTH levels up."""
    found = [nodes]
    while len(found[-1]) > 1 if whole else len(found) <= DEPTH:
        found.append([digest(found[-1][k : k + FAN]) for k in range(0, len(found[-1]), FAN)])
    return found


def fold(node: str, proof: str, places: str) -> str:
    """What a node and its proof come to: the root, if both are right."""
    at = 0
    for place, size in (map(int, x.split("/")) for x in places.split()):
        middle, end = at + 64 * place, at + 64 * (size - 1)
        node, at = digest((proof[at:middle], node, proof[middle:end])), end
    return node


def _positions(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """rows (a written table) with pos, the place of each in its tree from 0, and size, the rows of its tree."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    dealt = rows.withColumn("_salt", salt).repartitionByRange(tree, *order, "_salt").sortWithinPartitions(tree, *order)
    dealt = saved(dealt.drop("_salt").withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "ranges")
    parts = dealt.groupBy(tree, "_part").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    of_tree = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_rows").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(tree, "_part", "_first", before.alias("_before"), F.sum("_rows").over(of_tree).alias("size"))
    placed = dealt.join(parts, [tree, "_part"])
    return placed.withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before")).drop("_part", "_row", "_first", "_before")


def _up(nodes: DataFrame) -> list[DataFrame]:
    """Layers (tree, pos, node, size) from the nodes given to one node a tree, each a written table."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iloc[0])
        top = levels(block["node"].tolist(), size <= SPAN)[-1][0]
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "pos": block["pos"].iloc[:1] // SPAN, "node": [top], "size": [-(-size // SPAN)]})

    layers = [nodes]
    while True:
        above = layers[-1].select("tree", "pos", "node", "size").groupBy("tree", F.floor(F.col("pos") / SPAN)).applyInPandas(reduce, "tree string, pos long, node string, size long")
        layers.append(saved(above, "layer"))
        if (layers[-1].agg(F.max("size").alias("n")).first()["n"] or 0) <= 1:
            return layers


def _proofs(block: pd.DataFrame, outer: pd.DataFrame) -> tuple[list[str], list[str], list[list[str]]]:
    """(proofs, places, levels) of a superblock's nodes, which ascend by pos, with the outer proof joined on."""
    found = levels(block["node"].tolist(), int(block["size"].iloc[0]) <= SPAN)
    above, way = [outer["proof"].iloc[0]], [outer["places"].iloc[0]]
    for level in reversed(found[:-1]):
        runs = [level[k : k + FAN] for k in range(0, len(level), FAN)]
        above = ["".join(run[:i] + run[i + 1 :]) + above[r] for r, run in enumerate(runs) for i in range(len(run))]
        way = [f"{i}/{len(run)} {way[r]}".rstrip() for r, run in enumerate(runs) for i in range(len(run))]
    return above, way, found


def _by_block(nodes: DataFrame):
    return nodes.groupBy("tree", F.floor(F.col("pos") / SPAN).cast("long"))


def _down(layers: list[DataFrame], outer: DataFrame) -> DataFrame:
    """(tree, pos, proof, places, subroot, root) as superblocks of the lowest layer; outer has the same of the highest."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        proof, places, _ = _proofs(block, above)
        given = {c: above[c].iloc[0] for c in ("subroot", "root")}
        return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], "proof": proof, "places": places, **given})

    for layer in reversed(layers[1:-1]):
        outer = saved(_by_block(layer.select("tree", "pos", "node", "size")).cogroup(outer.groupBy("tree", "pos")).applyInPandas(join, outer.schema), "outer")
    return outer


def _finished(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """The lowest layer, proven and folded."""

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        proof, places, found = _proofs(block, above)
        rest = (above["proof"].iloc[0], above["places"].iloc[0])
        tops: dict[tuple[int, int, str], str] = {}  # what a node at a level and place comes to: equal ways up are folded once

        def up(level: int, at: int, node: str) -> str:
            key = (level, at, node)
            if key not in tops:
                if level + 1 == len(found):
                    tops[key] = fold(node, *rest)
                else:
                    start = at - at % FAN
                    run = found[level][start : start + FAN]
                    run[at - start] = node
                    tops[key] = up(level + 1, at // FAN, digest(run))
            return tops[key]

        folded = [up(0, at, node) for at, node in enumerate(block["claimed"])]
        return pd.DataFrame({
            "id": block["id"], "tree": block["tree"], "pos": block["pos"], "leaf": block["node"], "proof": proof, "places": places, "folded_root": folded,
            "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0],
        })

    schema = "id string, tree string, pos long, leaf string, proof string, places string, folded_root string, subroot string, root string"
    return _by_block(nodes).cogroup(outer.groupBy("tree", "pos")).applyInPandas(finish, schema)


def manifest(rows: DataFrame, identity: Column, tree: Column, node: Column, claimed: Column | None = None) -> DataFrame:
    """(id, tree, pos, leaf, proof, places, folded_root, subroot, root), a row per row of rows.

    identity orders the leaves of a tree and comes back as id (long); tree comes back as '=' and its value, '' if null. node is the
    leaf digest (see leaf()); claimed the digest that is to be verified in its stead, folded with the original's proof (null: node).
    """
    name = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))
    leaves = saved(rows.select(identity.cast("long").alias("id"), name.alias("tree"), node.alias("node"), (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed")), "leaves")
    placed = _positions(leaves.withColumn("claimed", F.coalesce("claimed", "node")), "tree", "id", "node")
    leaves = saved(placed.withColumn("id", F.col("id").cast("string")), "leaves")  # pandas would make floats of longs next to a null
    layers = _up(leaves)
    subroots = saved(layers[-1].select(F.lit("").alias("all"), "tree", "node"), "subroots")
    subroots = saved(_positions(subroots, "all", "tree").select(F.col("all").alias("tree"), "pos", "node", "size", F.col("tree").alias("name")), "subroots")
    above = _up(subroots)
    top = above[-1].select("tree", "pos", F.lit("").alias("proof"), F.lit("").alias("places"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    above = _down(above, top)

    def enter(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        proof, places, _ = _proofs(block, outer)
        return pd.DataFrame({"tree": block["name"], "pos": 0, "proof": proof, "places": places, "subroot": block["node"], "root": outer["root"].iloc[0]})

    outer = saved(_by_block(subroots).cogroup(above.groupBy("tree", "pos")).applyInPandas(enter, top.schema), "outer")
    return _finished(leaves, _down(layers, outer)).withColumn("id", F.col("id").cast("long"))
