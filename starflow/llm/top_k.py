"""Exact top-k inner products by aggregation of sorted lists without random access.

Vectors are packed into blocks. In a block each dimension is a sorted list, which a query reads
from its better end, a stretch at a time and in step with the others. What has been read gives
each vector a lower and an upper bound of its score; a vector whose upper bound is below the k-th
best lower bound is out. After the first stretch the scores of the few that lead are resolved, as
their k-th is a far better lower bound than what partial sums give. When no outsider can qualify
and few vectors are left, their final scores are resolved. The best of each block are then merged
by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.common import BATCH_ROWS, in_batches, keep

K = 10
SCALE = 1024

# Vectors of one block and queries of one block; a joined row holds one of each.
BLOCK = 8192
QUERY_BLOCK = 256
JOINED_ROWS = 4

# How far the lists are read before the bounds are looked at, and the share of a block whose final
# scores are resolved at once when no more are left.
DEPTHS = (1 / 8, 1 / 2, 5 / 8, 3 / 4, 1)
FEW = 3 / 8

# Bounds are exact in double precision up to here.
_EXACT = 2**52

_PACKED = "dims int, n int, ids binary, data binary"


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors of one length: ``dims, n, ids, data`` (64-bit numbers)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = vector.values
                if values is None or values.null_count or not len(values):
                    continue
                scaled = np.floor(SCALE * values.to_numpy().astype(np.float64))
                if not np.isfinite(scaled).all() or np.abs(scaled).max() >= 2.0**62:
                    continue
                block = waiting.setdefault(len(scaled), [])
                block.append((vec_id, scaled.astype(np.int64)))
                if len(block) == size:
                    yield _block(waiting.pop(len(scaled)))
        for block in waiting.values():
            yield _block(block)

    return rows.mapInArrow(pack, _PACKED)


def _block(vectors: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    ids = np.array([i for i, _ in vectors], np.int64)
    data = np.stack([v for _, v in vectors])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([data.shape[1]], pa.int32()), pa.array([len(ids)], pa.int32()),
            pa.array([ids.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary()),
        ],
        names=["dims", "n", "ids", "data"],
    )


class Lists:
    """The sorted lists of a block."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        self.ids, self.data = ids, data
        self.order = np.argsort(data, axis=0, kind="stable").T.astype(np.int32)  # a row per dimension
        self.values = np.take_along_axis(data.T, self.order, axis=1)
        self.largest = int(np.abs(data).max())

    def best(self, query_id: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """``(id, score)`` of the ``k`` best rows but the query's own, ties to the lesser id. With
        ``least``, rows below it may be missing."""
        n, dims = self.data.shape
        own = self.ids == query_id
        size = int(np.abs(query).max())
        left = np.flatnonzero(~own)
        if len(left) > k and size and self.largest * size * dims < _EXACT:
            left = self._candidates(query, own, k, least)
        if self.largest * size * dims < 2**62:
            scores = (self.data[left] @ query).tolist()
        else:
            scores = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in self.data[left]]
        found = sorted(zip(self.ids[left].tolist(), scores), key=lambda x: (-x[1], x[0]))
        return found[:k]

    def _candidates(self, query, own, k: int, least: int | None) -> np.ndarray:
        """Rows that may be among the best, ties included."""
        n = len(self.ids)
        falls, rises = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        weight = query[np.r_[falls, rises]].astype(np.float64)
        # The end of each list where the products are least; a positive factor reads from the other.
        ends = np.r_[self.values[falls, 0], self.values[rises, -1]]
        worst = weight * ends
        low = np.full(n, worst.sum())  # an unread part counts as the worst of its list
        left, depth, read = np.flatnonzero(~own), 0, []
        bound = -np.inf if least is None else float(least)
        for part in DEPTHS:
            to = max(depth + 1, min(n, int(n * part)))
            stretch = [(falls, slice(n - to, n - depth)), (rises, slice(depth, to))]
            ids = np.concatenate([self.order[dims, at] for dims, at in stretch])
            products = np.concatenate([self.values[dims, at] for dims, at in stretch])
            products = weight[:, None] * products
            low += np.bincount(ids.ravel(), (products - worst[:, None]).ravel(), n)
            frontier = np.r_[products[: len(falls), 0], products[len(falls) :, -1]]
            read.append(ids)
            depth = to
            if part == DEPTHS[0]:
                lead = left[np.argpartition(low[left], len(left) - k)[-min(4 * k, len(left)) :]]
                scores = np.sort(self.data[lead] @ query)
                bound = max(bound, float(scores[len(lead) - k]))
                continue  # nothing is out so early
            bound = max(bound, float(np.partition(low[left], len(left) - k)[len(left) - k]))
            # The upper bound puts the frontier in the place of the worst where nothing was read.
            above = frontier - worst
            seen = np.bincount(np.concatenate(read, axis=1).ravel(), np.repeat(above, depth), n)
            high = (low + above.sum() - seen)[left]
            left = left[high >= bound - 0.5]  # equal ones may win by their id; scores are whole
            if len(left) <= max(4 * k, FEW * n) or depth == n:
                break
        return left


def top_k(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest scores of each query.

    Components become ``floor(1024 * x)``; the score is the integer inner product with every row
    but those with the query's id; ties go to the lesser id. NULL ids, NULL vectors, empty vectors
    and vectors with a NULL or non-finite component (or one from 2**62 / 1024 on) take no part, and
    vectors are compared with those of their own length. A query without candidates has no row. A
    repeated query id is one query for each of its rows and the ranks go over all of them. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    in_batches(spark)
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("v"),
        is_query.alias("asks"),
    )
    parts = rows.count() // BLOCK + 1
    dealt = rows.select("id", "v").repartition(parts, "id")
    blocks = keep(_packed(dealt, 2 * BLOCK), "top_k_blocks")
    asked = keep(_packed(rows.filter("asks").select("id", "v"), QUERY_BLOCK), "top_k_queries")
    # Blocks are dealt to slots and the query blocks go to every slot: each meets each once.
    slots = max(1, min(blocks.count(), 4 * spark.sparkContext.defaultParallelism))
    blocks = blocks.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int"))
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        "dims",
        F.col("n").alias("q_n"),
        F.col("ids").alias("q_ids"),
        F.col("data").alias("q_data"),
    )
    joined = blocks.join(asked.hint("merge"), ["slot", "dims"]).select(
        "dims", "ids", "data", "q_ids", "q_data"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lists, bounds = None, None, {}
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for dims, ids, data, q_ids, q_data in zip(*(c.to_pylist() for c in batch.columns)):
                if ids != last:
                    block = np.frombuffer(data, np.int64).reshape(-1, dims)
                    last, lists = ids, Lists(np.frombuffer(ids, np.int64), block)
                queries = np.frombuffer(q_data, np.int64).reshape(-1, dims)
                if len(bounds) > 50_000:
                    bounds.clear()
                for query_id, query in zip(np.frombuffer(q_ids, np.int64).tolist(), queries):
                    key = (query_id, query.tobytes())
                    found = lists.best(query_id, query, k, bounds.get(key))
                    if len(found) == k:
                        bounds[key] = max(found[-1][1], bounds.get(key, found[-1][1]))
                    out += [(query_id, vec_id, score) for vec_id, score in found]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
            )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(JOINED_ROWS))
    found = joined.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    found = keep(found, "top_k_found")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
