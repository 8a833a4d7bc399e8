"""Links inside clusters of candidates, compared block by block.

Candidates that share a posting are in one cluster. A cluster is dealt to blocks of a bounded
number of sets, and each pair of blocks is one small piece of work that gives only the links it
finds, never the pairs it has compared. So a large group of sets that are nearly, but not quite,
similar enough is compared whole, by many tasks, and makes no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import by_size, keep
from starflow.llm.components import components

# Shingles whose columns are multiplied at once.
_COLUMNS = 4096


def open_edges(posts: DataFrame, heads: DataFrame, roots: DataFrame, group: list[str]) -> DataFrame:
    """``a, b``: the members of each posting group that is in several components, tied to its head.

    ``posts`` has ``group`` and ``id``, ``heads`` has ``group`` and ``head``, ``roots`` has ``node``
    and ``root``.
    """
    named = posts.join(roots.withColumnRenamed("node", "id").hint("merge"), "id", "left")
    named = named.select(*group, F.coalesce("root", "id").alias("root"))
    mixed = named.groupBy(*group).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.filter(F.col("low") != F.col("high")).select(*group)
    heads = heads.join(mixed.hint("merge"), group, "left_semi")
    tied = posts.join(heads.hint("merge"), group).filter(F.col("id") != F.col("head"))
    return tied.select(F.col("id").alias("a"), F.col("head").alias("b"))


def blocks(edges: DataFrame, size: int) -> DataFrame:
    """``id, cluster, blocks, block``: blocks of about ``size`` members of each cluster."""
    placed = components(edges).select(F.col("node").alias("id"), F.col("root").alias("cluster"))
    counts = placed.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))
    placed = placed.join(counts.hint("merge"), "cluster")
    return placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def blocks_by_items(edges: DataFrame, sizes: DataFrame, most: int, sets: int) -> DataFrame:
    """Like ``blocks``, for sets of very different sizes: ``sizes`` has ``id`` and ``n``, and a block
    has about ``most`` items and ``sets`` sets at most, or one set that has more. The result is stored."""
    nodes = components(edges).select(F.col("node").alias("id"), F.col("root").alias("cluster"))
    placed = keep(nodes.join(sizes.hint("merge"), "id"), "cluster_nodes")
    needed = F.greatest(F.sum("n") / most, F.count(F.lit(1)) / sets)
    large = placed.groupBy("cluster").agg(F.ceil(needed).cast("int").alias("blocks"))
    # Clusters of one block, nearly all, are not looked up.
    large = keep(large.filter(F.col("blocks") > 1), "cluster_large")
    placed = by_size(placed, large, ["cluster"], "left").fillna(1, ["blocks"])
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    return keep(placed.select("id", "cluster", "blocks", block), "cluster_blocks")


def cluster_members(sets: DataFrame, placed: DataFrame, roots: DataFrame) -> DataFrame:
    """``id, root, items, cluster, blocks, block`` of ``sets`` with ``id, items``."""
    roots = roots.withColumnRenamed("node", "id")
    return (
        sets.join(placed.hint("merge"), "id")
        .join(roots.hint("merge"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )


def links_by_columns(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between different components among ``members`` whose ids are numbers.

    A pair of blocks gives no more links than connect what it can connect.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("other", other).select(
        "cluster",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "id",
        "root",
        "items",
    )

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        block = table.column("block").to_numpy()
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        ids, roots = table.column("id").to_numpy(), table.column("root").to_numpy()
        items = table.column("items").combine_chunks()
        pairs = _similar(items, left, right, roots, percent) if len(right) else []
        kept = _spanning([(int(roots[i]), int(roots[j]), int(ids[i]), int(ids[j])) for i, j in pairs])
        return pa.table(
            {
                "a": pa.array([max(x, y) for x, y in kept], pa.int64()),
                "b": pa.array([min(x, y) for x, y in kept], pa.int64()),
            }
        )

    return dealt.groupBy("cluster", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def _similar(items, left: np.ndarray, right: np.ndarray, roots: np.ndarray, percent: int):
    """Pairs of rows in different components with ``100 * both >= percent * either``."""
    offsets, values = items.offsets.to_numpy(), items.values.to_numpy()
    sizes = np.diff(offsets)

    def flat(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [values[offsets[r] : offsets[r + 1]] for r in rows]
        return np.concatenate(parts), np.repeat(np.arange(len(rows)), sizes[rows])

    left_values, left_rows = flat(left)
    right_values, right_rows = flat(right)
    common = np.intersect1d(left_values, right_values)
    both = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(common), _COLUMNS):
        part = common[start : start + _COLUMNS]
        both += _incidence(left_values, left_rows, len(left), part) @ _incidence(
            right_values, right_rows, len(right), part
        ).T
    both = both.astype(np.int64)
    either = sizes[left][:, None] + sizes[right][None, :] - both
    good = (100 * both >= percent * either) & (roots[left][:, None] != roots[right][None, :])
    return [(left[i], right[j]) for i, j in np.argwhere(good).tolist()]


def _incidence(values: np.ndarray, rows: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
    hit = columns[at] == values
    matrix = np.zeros((n, len(columns)), np.float32)
    matrix[rows[hit], at[hit]] = 1
    return matrix


def _spanning(links: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Of ``(root, root, id, id)`` those links that join two components not joined before."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for root_a, root_b, a, b in links:
        x, y = top(root_a), top(root_b)
        if x != y:
            parent[y] = x
            kept.append((a, b))
    return kept


# The least items of a set that are compared first, and how many of them two sets must share. Of sets
# that are 80 percent alike at least 51 are expected, and fewer than ``_ALIKE`` are found with a
# probability of 2 in a hundred million; smaller sets are compared whole.
_LEAST = 64
_ALIKE = 32


def links_by_arrays(rows: DataFrame, percent: int, cut) -> DataFrame:
    """``a, b``: like ``links_by_columns``, for ids of any type and with DataFrame functions only; the
    links are between the roots, and some are given several times.

    ``rows`` has ``id, root, raw, cluster, blocks, block``; ``cut`` gives the items of a ``raw``, which
    are several times larger and made only where they are compared. The least items of two sets
    rule out most pairs before the sets are intersected; for ``percent`` below 80 nothing is ruled out.
    """
    held = F.collect_list(F.struct("id", "root", "raw")).alias("held")
    # Little to read and much to compare: as many files as tasks, which their bytes alone would not give.
    spread = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cluster", "block")
    packed = keep(spread.groupBy("cluster", "blocks", "block").agg(held), "cluster_packed")

    def sets(name: str):
        cut_up = F.transform(
            name, lambda x: F.struct(x["id"].alias("id"), x["root"].alias("root"), cut(x["raw"]).alias("items"))
        )
        return F.transform(
            cut_up, lambda x: F.struct(
                x["id"].alias("id"), x["root"].alias("root"), x["items"].alias("items"),
                F.size(x["items"]).alias("n"), F.slice(F.sort_array(x["items"]), 1, _LEAST).alias("least"),
            )
        )

    # Nearly all clusters are one block, which meets itself alone.
    alone = packed.filter("blocks = 1").select(
        F.lit(True).alias("same"), F.inline(F.array(F.struct(sets("held").alias("left"))))
    )
    alone = alone.select("same", "left", F.col("left").alias("right"))
    several = packed.filter("blocks > 1")
    others = F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("with_block")
    one = several.select("cluster", "block", F.col("held").alias("held_left"), others)
    other = several.select("cluster", F.col("block").alias("with_block"), F.col("held").alias("held_right"))
    met = one.join(other.hint("merge"), ["cluster", "with_block"]).select(
        (F.col("block") == F.col("with_block")).alias("same"),
        # A generated row is computed once, however often the comparison reads it.
        F.inline(F.array(F.struct(sets("held_left").alias("left"), sets("held_right").alias("right")))),
    )

    def similar(x, y):
        small, large = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
        alike = (small <= 2 * _LEAST) | (F.size(F.array_intersect(x["least"], y["least"])) >= _ALIKE)
        both = F.size(F.array_intersect(x["items"], y["items"]))
        return (
            (x["root"] != y["root"])
            & (~F.col("same") | (x["id"] > y["id"]))
            & (100 * small >= percent * large)
            & (alike if percent >= 80 else F.lit(True))
            & (100 * both >= percent * (x["n"] + y["n"] - both))
        )

    def partners(x):
        # One link for each component, however many of its members are similar.
        close = F.transform(F.filter("right", lambda y: similar(x, y)), lambda y: y["root"])
        return F.transform(F.array_distinct(close), lambda y: F.struct(x["root"].alias("x"), y.alias("y")))

    found = F.explode(F.flatten(F.transform("left", partners))).alias("link")
    return alone.unionByName(met).select(found).select(
        F.greatest("link.x", "link.y").alias("a"), F.least("link.x", "link.y").alias("b")
    )
