"""Merkle manifest of a table: a tree of hashes for each group, and one over the groups' roots.

Leaves are ranked in their group without a window over it, and cut into blocks of ``2 ** WIDTH``.
In a block the binary digits of the rank are grouped away one after the other, lowest first, each
step nesting the child structs in their parent, so that a block ends as one row that is its tree.
The roots of the blocks are the leaves of the next layer. A transform over the nested structs and
an explode give each leaf its proof inside the block; the proofs of the layers above, which have a
``2 ** WIDTH``-th of the rows, are added to whole blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import BROADCAST_BYTES, by_size, keep
from starflow.operators.keys import dense_key

# Binary digits of the rank within a block.
WIDTH = 8

# Bytes of a step of a proof, for the size of what would be broadcast.
_STEP_BYTES = 160


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of one row: each value as its number of UTF-8 bytes, a colon and the value, or ``-``."""
    written = [f.cast("string") for f in fields]
    return hashed(
        F.concat(
            *(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in written)
        )
    )


def proof_hash(path: Column) -> Column:
    """Hash over the siblings of a proof, from the leaf up, each run from left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and a proof lead to."""
    return F.aggregate(path, leaf, lambda h, s: hashed(F.concat(s["left"], h, s["right"])))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A row for each row of ``docs``: the columns ``order`` and ``group``, those in ``also``
    (expressions over ``docs``), ``leaf``, ``path``, ``subroot`` and ``root``.

    ``path`` is the proof: from the leaf up one struct for each run, with the hash that stands to
    the ``left`` or ``right`` of the own one, or two empty texts where the run has one node.
    ``fold(leaf, path)`` equals ``root``. In a group leaves go by ``order``, NULL first, then by
    their hash, so repeated rows have equal leaves and proofs for their own places. Groups go by
    their value as bytes, NULL first, and NULL is a group. One row is its own subroot; one group's
    subroot is the root. An empty table gives no rows. Texts of any length are hashed whole and do
    not leave the first scan. Other columns are not read, whatever their names.
    """
    also = dict(also or {})
    leaves = docs.select(
        # Bytewise the dash comes before the equals sign, so the NULL group is the first.
        F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-")).alias("__group"),
        F.col(order).alias("__order"),
        leaf_hash([F.col(f) for f in fields]).alias("__leaf"),
        F.struct(F.lit(0).alias("_"), *(c.alias(n) for n, c in also.items())).alias("__also"),
    )
    ranked = dense_key(leaves, "__number", ["__group", "__order", "__leaf"], start=-1)
    groups = ranked.groupBy("__group").agg(
        F.min("__number").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    groups = keep(dense_key(groups, "tree", ["__group"], start=-1), "merkle_groups")
    nodes = by_size(ranked, groups, ["__group"], "inner").select(
        "tree",
        (F.col("__number") - F.col("__first")).alias("rank"),
        _height(F.col("__rows")).alias("height"),
        F.col("__leaf").alias("h"),
        F.struct("__group", "__order", "__leaf", "__also").alias("row"),
    )
    placed, tops = _paths(nodes)
    forest, _ = _paths(
        tops.select(
            F.lit(0).cast("bigint").alias("tree"),
            F.col("tree").alias("rank"),
            _height(F.lit(groups.count())).alias("height"),
            F.col("top").alias("h"),
            F.struct(F.col("tree").alias("of")).alias("row"),
        )
    )
    above = keep(
        forest.select(
            F.col("row.of").alias("tree"), F.col("path").alias("__above"), F.col("top").alias("root")
        ),
        "merkle_forest",
    )
    return _joined(placed, above, ["tree"], "__above").select(
        F.col("row.__order").alias(order),
        F.when(F.col("row.__group") != "-", F.substr("row.__group", F.lit(2))).alias(group),
        *(F.col("row.__also")[n].alias(n) for n in also),
        F.col("row.__leaf").alias("leaf"),
        F.concat("path", "__above").alias("path"),
        F.col("top").alias("subroot"),
        "root",
    )


def _height(rows: Column) -> Column:
    """Levels above the leaves of a tree: the binary digits of the last rank."""
    return F.when(rows > 1, F.length(F.bin(rows - 1))).otherwise(0)


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """One row for each block: ``tree, height, block, node``, the node with all that is below it."""
    digits = [f"d{i}" for i in range(WIDTH)]
    rows = nodes.select(
        "tree",
        "height",
        F.shiftright("rank", WIDTH).alias("block"),
        *(F.getbit("rank", F.lit(i)).alias(d) for i, d in enumerate(digits)),
        F.struct("h", "row").alias("node"),
    ).repartition("tree", "height", "block")  # once: every grouping below refines this one
    for i, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("d"), "node")
        kids = F.sort_array(F.collect_list(child)).alias("kids")
        rows = rows.groupBy("tree", "height", "block", *digits[i + 1 :]).agg(kids)
        own = F.array_join(F.col("kids.node.h"), "")
        own = F.when(F.col("height") > base + i, hashed(own)).otherwise(own)
        rows = rows.select(
            "tree", "height", "block", *digits[i + 1 :], F.struct(own.alias("h"), "kids").alias("node")
        )
    return rows


def _leaves(node: Column, level: int, height: Column, base: int, above: Column) -> Column:
    """The leaves under ``node`` as an array, each with the steps from it up to the block's root."""
    if not level:
        return F.array(F.struct(node["row"].alias("row"), above.alias("path")))
    kids, level = node["kids"], level - 1

    def under(kid: Column) -> Column:
        left = F.when(kid["d"] == 1, kids[0]["node"]["h"]).otherwise("")
        right = F.coalesce(F.when(kid["d"] == 0, F.get(kids, F.lit(1))["node"]["h"]), F.lit(""))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.concat(F.when(height > base + level, step).otherwise(F.slice(step, 1, 0)), above)
        return _leaves(kid["node"], level, height, base, path)

    return F.flatten(F.transform(kids, under))


def _paths(nodes: DataFrame, base: int = 0) -> tuple[DataFrame, DataFrame]:
    """``tree, rank, row, path, top`` for nodes of level ``base``, ``top`` being their tree's root,
    and ``tree, top`` for each tree."""
    blocks = keep(_blocks(nodes, base), "merkle_blocks")
    none = F.array().cast("array<struct<left:string,right:string>>")
    inside = _leaves(F.col("node"), WIDTH, F.col("height"), base, none)
    highest = blocks.agg(F.max("height").alias("height")).first()["height"]
    if highest is None or highest <= base + WIDTH:
        whole = blocks.withColumn("above", none).withColumn("top", F.col("node.h"))
    else:
        tops = blocks.select("tree", F.col("block").alias("rank"), "height", "node.h")
        tops = tops.withColumn("row", F.struct(F.lit(0).alias("_")))
        layer, _ = _paths(tops, base + WIDTH)
        layer = layer.select("tree", F.col("rank").alias("block"), F.col("path").alias("above"), "top")
        whole = _joined(blocks, keep(layer, "merkle_layer"), ["tree", "block"], "above")
    leaf = F.posexplode(inside).alias("place", "leaf")
    found = whole.select("tree", "block", "above", "top", leaf)
    placed = found.select(
        "tree",
        (F.shiftleft("block", WIDTH) + F.col("place")).alias("rank"),
        "leaf.row",
        F.concat("leaf.path", "above").alias("path"),
        "top",
    )
    return placed, whole.filter("block = 0").select("tree", "top")


def _joined(rows: DataFrame, proofs: DataFrame, on: list[str], path: str) -> DataFrame:
    """``rows`` with the proofs of what they belong to, which are broadcast only if they are small."""
    row = F.lit(256) + _STEP_BYTES * F.size(path)
    size = proofs.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]
    small = F.broadcast(proofs) if size <= BROADCAST_BYTES else proofs.hint("merge")
    return rows.join(small, on)
