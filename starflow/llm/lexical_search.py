"""Ranked lexical search by NRA: impact-sorted lists, read from the top, without random access.

Documents are packed into blocks, and in a block each term of the queries is a list of documents by
falling impact. A query reads its lists in step, a stretch at a time. What has been read gives each
document a lower bound of its score; the upper bound adds the next impact of each list in which the
document has not been seen. A document whose upper bound is below the k-th best lower bound is out.
A list is read on as long as some document that is left has not been seen in it, and reading ends
when the two bounds of every such document meet, so that members, ties and scores are final.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starflow.llm.common import Shared, keep, small_batches

K = 50

# Documents and postings that make a block; the block ends after the document that reaches either.
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 2_000_000

# Bytes of query texts that are answered in one pass over the documents.
QUERY_BYTES = 16 * 1024 * 1024

# Postings read of each list in the first stretch; each further stretch is as long as all before.
FIRST = 64

# Documents left from which on it is looked up in which lists each has been seen.
FEW = 4096

# Bytes of a text that are matched at once.
PIECE = 1 << 20

# Sums are exact in double precision up to here.
_EXACT = 2**53

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_ARRAYS = ("ids", "named", "lengths", "docs", "terms", "counts")
_PACKED = "n_docs bigint, n_words bigint, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def term_counts(text: bytes) -> Counter[bytes]:
    """Occurrences of each term. In UTF-8 all bytes of other letters are from 0x80 on, and
    ``bytes.lower`` changes A to Z alone. Long texts are matched in pieces that end with a term."""
    text = text.lower()
    if len(text) <= PIECE:
        return Counter(_TERM.findall(text))
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        tail = _TERM.match(text, end)
        end = tail.end() if tail else end
        counts.update(_TERM.findall(text, at, end))
        at = end
    return counts


def _packed(docs: DataFrame, terms: Shared) -> DataFrame:
    """Blocks: id, whether there is one, and length of each document with a term; its postings."""

    def block(ids, named, lengths, docs, found, counts) -> pa.RecordBatch:
        parts = (
            np.array(ids, np.int64), np.array(named, bool), np.array(lengths, np.int64),
            np.repeat(np.arange(len(docs), dtype=np.int32), docs),
            np.array(found, np.int32), np.array(counts, np.int64),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)]), pa.array([sum(lengths)])] + [pa.array([p.tobytes()]) for p in parts],
            names=["n_docs", "n_words", *_ARRAYS],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = terms.get()
        columns: tuple[list, ...] = ([], [], [], [], [], [])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_buffer().to_pybytes()) if text.is_valid else {}
                if not counts:
                    continue
                known = [(number[t], n) for t, n in counts.items() if t in number]
                for column, value in zip(
                    columns, (doc_id or 0, doc_id is not None, sum(counts.values()), len(known))
                ):
                    column.append(value)
                columns[4].extend(t for t, _ in known)
                columns[5].extend(n for _, n in known)
                if len(columns[0]) >= BLOCK_DOCS or len(columns[4]) >= BLOCK_POSTINGS:
                    yield block(*columns)
                    columns = ([], [], [], [], [], [])
        if columns[0]:
            yield block(*columns)

    return docs.mapInArrow(pack, _PACKED)


def _holders(packed: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term, over all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(n_terms, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found += np.bincount(np.frombuffer(value.as_buffer(), np.int32), minlength=n_terms)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(found[held])], names=["term", "docs"]
        )

    counted = packed.select("terms").mapInArrow(count, "term int, docs bigint")
    held = np.zeros(n_terms, np.int64)
    for row in counted.groupBy("term").agg(F.sum("docs").alias("docs")).toLocalIterator():
        held[row["term"]] = row["docs"]
    return held


class Lists:
    """The impact-sorted lists of one block."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_words: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.named = np.frombuffer(row["named"], bool)
        lengths = np.frombuffer(row["lengths"], np.int64)
        docs = np.frombuffer(row["docs"], np.int32)
        terms = np.frombuffer(row["terms"], np.int32)
        counts = np.frombuffer(row["counts"], np.int64)
        norm = 50 + (50 * lengths * n_docs) // n_words
        impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * norm[docs]))
        order = np.lexsort((-impacts, terms))
        self.docs, self.impacts = docs[order], impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def best(self, terms: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """``(score, id)`` of the ``k`` best documents, ties to the lesser id; those below
        ``least`` may be missing."""
        at, ends = self.starts[terms], self.starts[terms + 1]
        held = at < ends
        at, ends = at[held].copy(), ends[held]
        exact = int(self.impacts[at].sum()) < _EXACT
        n, depth, bound = len(self.ids), FIRST, max(least, 1)
        low, left = np.zeros(n, np.int64), np.flatnonzero(self.named)
        read_docs, read_lists = [], []
        going = np.ones(len(at), bool)
        while True:
            for i in np.flatnonzero(going):
                to = min(at[i] + depth, ends[i])
                part = self.docs[at[i] : to]
                read_docs.append(part)
                read_lists.append(np.full(len(part), i, np.int32))
                low[part] += self.impacts[at[i] : to]  # a document is in a list once
                at[i] = to
            unread = at < ends
            frontier = np.zeros(len(at), np.int64)
            frontier[unread] = self.impacts[at[unread]]
            seen_docs = np.concatenate(read_docs) if read_docs else np.zeros(0, np.int32)
            seen_lists = np.concatenate(read_lists) if read_lists else np.zeros(0, np.int32)
            # The next impact of every list but those in which the document has been seen.
            spare = np.zeros(n, np.int64)
            if exact:
                spare += np.bincount(seen_docs, frontier[seen_lists], n).astype(np.int64)
            else:
                np.add.at(spare, seen_docs, frontier[seen_lists])
            high = low[left] + frontier.sum() - spare[left]
            if len(left) > k:
                bound = max(bound, int(np.partition(low[left], len(left) - k)[len(left) - k]))
            stays = high >= bound
            left, high = left[stays], high[stays]
            if not unread.any() or (high == low[left]).all():
                break
            going = unread
            if len(left) <= FEW:
                place = np.full(n, -1, np.int32)
                place[left] = np.arange(len(left), dtype=np.int32)
                here = place[seen_docs]
                seen = np.bincount(seen_lists[here >= 0], minlength=len(at))
                going = unread & (seen < len(left))  # read on where one of them was not seen
            depth *= 2
        found = sorted(zip((-low[left]).tolist(), self.ids[left].tolist()))[:k]
        return [(-score, doc_id) for score, doc_id in found]


def rank_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query_col, rank, id_col, score`` of the ``k`` best documents of each query, by a
    length-normalised saturating term weight in whole numbers. Only scores above 0 are listed,
    equal ones by ascending id.

    Statistics cover all documents with a term. NULL texts have none. A document without an id
    counts in the statistics but cannot be listed; one that is there twice is listed twice. Each
    row of ``queries`` is a query, also with a NULL or repeated id. Without documents or queries
    there are no rows. Texts are read whole. Other columns are not read, whatever their names.

    Queries are answered in as many passes as their texts fill ``query_bytes``, which bounds what
    is broadcast: their terms, with a number each, and the weights of these.
    """
    spark = docs.sparkSession
    asked = queries.select(F.col(query_col).alias("id"), F.col(query_text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // query_bytes + 1
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    found = [
        _answer(texts, asked.filter(F.pmod(F.xxhash64("text", "id"), F.lit(parts)) == part), k)
        for part in range(parts)
    ]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("id").alias(query_col), "rank", F.col("doc").alias(id_col), "score")


def _answer(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``id, rank, doc, score`` for queries whose texts fit into memory."""
    spark = docs.sparkSession
    id_type = asked.schema["id"].dataType
    queries = [(row["id"], term_counts((row["text"] or "").encode())) for row in asked.collect()]
    number = {t: i for i, t in enumerate(sorted(set().union(*(t for _, t in queries))))}
    with small_batches(spark):
        packed = keep(_packed(docs, Shared(spark, number, lambda known: known)), "search_packed")
        held = _holders(packed, len(number))
    totals = packed.agg(F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words")).first()
    n_docs, n_words = totals["docs"] or 0, totals["words"] or 0
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
    terms = [np.array(sorted(number[t] for t in found), np.int64) for _, found in queries]
    shared = Shared(spark, ([i for i, _ in queries], terms, weights), lambda value: value)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, weights = shared.get()
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        for batch in batches:
            for row in batch.to_pylist():
                lists = Lists(row, weights, n_docs, n_words)
                for q, asks in enumerate(terms):
                    least = best[q][-1][0] if len(best[q]) == k else 0
                    more = lists.best(asks, k, least)
                    if more:
                        best[q] = sorted(best[q] + more, key=lambda x: (-x[0], x[1]))[:k]
        rows = [(q, i, doc, score) for q, i in enumerate(ids) for score, doc in best[q]]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int32(), to_arrow_type(id_type), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "id", "doc", "score"]
        )

    schema = f"query int, id {id_type.simpleString()}, doc bigint, score bigint"
    with small_batches(spark, 1):
        found = keep(packed.mapInArrow(search, schema), "search_found")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("id", "rank", "doc", "score")
