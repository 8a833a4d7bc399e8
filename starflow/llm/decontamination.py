"""Benchmark decontamination by a broadcast set of word windows.

The windows of all benchmark items (13 consecutive words; a shorter item is one window) are sent
to the executors, in slices of a bounded number. Each document is read once per slice: its words
become small numbers, runs of words that benchmarks know are hashed window by window, and each hit
is verified word by word.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import in_batches, keep, texts_of

WINDOW = 13

# Windows that are broadcast at once; at about 150 bytes each this is 150 MB in a Python worker.
# A benchmark with more of them is read in several passes, so the result is the same.
MAX_WINDOWS = 1_000_000

# A document is contaminated if at least one word in this many is hit.
SHARE = 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[bytes]:
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield b" ".join(words[i : i + size])


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct ``(item_id, gram)``. A NULL ``item_id`` counts as the id ``null``."""
    in_batches(benchmark.sparkSession)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, grams = [], []
            for i, text in enumerate(texts_of(batch)):
                for gram in set(windows_of(words_of(text), size)):
                    row.append(i)
                    grams.append(gram)
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(grams, pa.binary())], names=["item_id", "gram"]
            )

    return items.mapInArrow(cut, "item_id string, gram binary").distinct()


class Windows:
    """A slice of the windows, ready to be looked up."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        hashes: dict[int, set[int]] = {}
        for item, gram in rows:
            words = gram.split(b" ")
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            self.items.setdefault(ids, []).append(item)
        for ids in self.items:
            one = self.hashes(np.array(ids, dtype=np.uint64), np.zeros(1, np.int64), len(ids))
            hashes.setdefault(len(ids), set()).add(int(one[0]))
        self.by_length = {n: np.sort(np.array(list(h), np.uint64)) for n, h in hashes.items()}

    @staticmethod
    def hashes(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        total = np.zeros(len(starts), np.uint64)
        for i in range(length):
            total = (total ^ ids[starts + i]) * _STEP
            total ^= total >> np.uint64(29)
        return total

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges that lie in a window, and the items the windows come from."""
        n = len(words)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, n)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        marks, items = np.zeros(n + 1, np.int64), set()
        for length, hashes in self.by_length.items():
            if length > n:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(starts):
                continue
            found = self.hashes(ids, starts, length)
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for start in starts[hashes[at] == found].tolist():
                if of := self.items.get(tuple(ids[start : start + length].tolist())):
                    items.update(of)
                    marks[start] += 1
                    marks[start + length] -= 1
        if not items:
            return [], items
        inside = np.concatenate([[0], np.cumsum(marks)[:-1] > 0, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(inside))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist())), items


_LOADED: dict[str, Windows] = {}


def loaded(shared) -> Windows:
    """The lookup of a broadcast slice; built once in each Python worker, one slice at a time."""
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = Windows(shared.value)
    return _LOADED[shared.id]


class _Shared:
    """A broadcast with the name that tells the slices apart."""

    def __init__(self, broadcast, name: str):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def cut_out(text: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` without the words in the ranges and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data.lower())]
    kept, at = [], 0
    for start, end in ranges:
        kept.append(data[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_HITS = (
    "n_words bigint, ranges array<struct<start: int, end: int>>, item_ids array<string>"
)


def scan(
    docs: DataFrame, benchmark: DataFrame, columns: list[str], text_col: str = "text", **scanned
) -> DataFrame:
    """``columns`` of each row with ``n_words``, the hit word ``ranges`` and the ``item_ids``.

    The text must be among the columns. NULL and empty texts have no words. An empty benchmark hits
    nothing. Rows are neither dropped nor told apart by an id, so NULL and repeated ids are fine.
    """
    found = _scan(docs, benchmark, columns, text_col, **scanned)
    return found.toDF(*columns, "n_words", "ranges", "item_ids")


def _scan(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    text_col: str,
    size: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """Like ``scan``, with the columns named ``c0``, ``c1``, ... so that no name clashes."""
    spark = docs.sparkSession
    in_batches(spark)
    grams = keep(benchmark_windows(benchmark, size), "benchmark_windows")
    slices = max(1, -(-grams.count() // max_windows))
    inner = [f"c{i}" for i in range(len(columns))]
    frame = docs.select(*[F.col(c).alias(i) for c, i in zip(columns, inner)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
    text_at = columns.index(text_col)
    for number in range(slices):
        part = grams.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == number)
        rows = [(r["item_id"], bytes(r["gram"])) for r in part.toLocalIterator()]
        shared = _Shared(spark.sparkContext.broadcast(rows), uuid.uuid4().hex)
        frame = frame.mapInArrow(_scanner(shared, text_at, number > 0), f"{schema}, {_HITS}")
        if number + 1 < slices:  # so that two slices are never in one worker
            frame = keep(frame, "decontamination_pass")
    return frame


def _scanner(shared: _Shared, text_at: int, later: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = loaded(shared)
        for batch in batches:
            counts, ranges, items = [], [], []
            for i, value in enumerate(batch.column(text_at)):
                words = words_of(value.as_py() or "")
                hit, of = windows.find(words)
                if later:
                    before = batch.column(batch.num_columns - 2)[i].as_py()
                    hit = union([*hit, *((r["start"], r["end"]) for r in before)])
                    of = of | set(batch.column(batch.num_columns - 1)[i].as_py())
                counts.append(len(words))
                ranges.append([{"start": s, "end": e} for s, e in hit])
                items.append(sorted(of))
            passed = batch.columns[:-3] if later else batch.columns
            names = batch.schema.names[: len(passed)]
            yield pa.RecordBatch.from_arrays(
                [
                    *passed,
                    pa.array(counts, pa.int64()),
                    pa.array(ranges, _RANGES),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*names, "n_words", "ranges", "item_ids"],
            )

    return find


def hit_words() -> Column:
    lengths = F.transform("ranges", lambda r: (r["end"] - r["start"]).cast("bigint"))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n)


def contaminated(share: int = SHARE) -> Column:
    n = hit_words()
    return (n > 0) & (n * share >= F.col("n_words"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: int = SHARE, **scanned
) -> DataFrame:
    """``docs`` without the contaminated rows; all other rows and columns are as they were.

    NULL and empty texts have no words and stay, and so do all rows if the benchmark is empty. Rows
    with NULL or repeated ids are judged each by its own text. An empty table gives no rows.
    """
    columns = docs.columns
    found = _scan(docs, benchmark, columns, text_col, **scanned).filter(~contaminated(share))
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **scanned
) -> DataFrame:
    """``docs`` with the hit words cut out of the texts; no row is dropped.

    NULL stays NULL, and a text without a hit is as it was. A text of hits alone becomes empty. NULL
    and repeated ids and all other columns are passed on; an empty table gives no rows.
    """
    columns = docs.columns
    text_at = columns.index(text_col)
    inner = _scan(docs, benchmark, columns, text_col, **scanned)
    schema = inner.drop("n_words", "ranges", "item_ids").schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, ranges in zip(batch.column(text_at), batch.column(len(columns) + 1)):
                text, cut = value.as_py(), [(r["start"], r["end"]) for r in ranges.as_py()]
                texts.append(cut_out(text, cut) if cut else text)
            arrays = list(batch.columns[: len(columns)])
            arrays[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[: len(columns)])

    return inner.mapInArrow(clean, schema).toDF(*columns)
