"""Toxicity by class-conditional Kneser-Ney bigram models.

Two models, of the documents labelled toxic and of the others, back off from bigrams to counts that
both classes share, then to words and to shared counts again. Every bigram and word that was seen
has discounted counts of its own in each class. The less the classes differ in it, the more of them
is discounted and left to the backoff, but never all. The score of a document is the mean
difference of the log-likelihoods per bigram, turned into a probability on labelled documents that
the models have not seen.

Counts and models are tables that grow with the corpus, and are joined with the bigrams and words
of the documents.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starflow.llm.common import (
    BROADCAST_BYTES,
    Tables,
    by_size,
    drop_folder,
    in_batches,
    keep,
    remainder,
    shared_folder,
    texts_of,
)
from starflow.operators.joins import measured_bytes

DISCOUNT = 0.75

# Where the likelihood ratio of the classes (G squared) has this value, half of a count is kept; the
# kept part rises with its square.
STRENGTH = 100.0

# Bins of the score that calibration counts; all labelled documents of its fold are in them.
BINS = 1000

# Bigrams, and documents, that a worker gathers before it passes them on.
COUNTED = 400_000
GATHERED = 30_000

REMEMBERED = 100_000

# Parts of the documents that are looked up one after the other where the model is not broadcast, so
# that the disk holds the lookups of one part.
PARTS = 8

# Deletes the shuffled files of a job when it ends.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_WORD = re.compile(r"[^\W_]+")
_BEGIN = np.uint64(0x2545F4914F6CDD1D)

# In place of the word, or of the history, in the keys of what is known of one of them alone.
_HEAD = 0x1E3779B97F4A7C15
_ALONE = 0x3C79AC492BA7B653


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Hashes()


def bigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct bigrams of a text as hashes: histories and words. The first word follows the
    beginning of the text. A text counts each bigram once, so that repetition weighs nothing."""
    words = _WORD.findall(text.lower())
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    h = np.concatenate([[_BEGIN], w])[: len(w)].astype(np.uint64)
    _, at = np.unique(pair(h, w), return_index=True)
    return h[at], w[at]


def pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``xxhash64(h, w)`` of Spark."""
    one, two, three, four, five = (
        np.uint64(p)
        for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                  0x27D4EB2F165667C5)
    )

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    x = np.full(max(np.size(h), np.size(w)), 42, np.uint64)
    for part in (h, w):
        x = (x + five + np.uint64(8)) ^ (turned(part * two, 31) * one)
        x = turned(x, 27) * one + four
        x = (x ^ (x >> np.uint64(33))) * two
        x = (x ^ (x >> np.uint64(29))) * three
        x = x ^ (x >> np.uint64(32))
    return x


def _summed(h: np.ndarray, w: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Each bigram of a block once, with its number in either class."""
    order = np.lexsort((w, h))
    h, w, label = h[order], w[order], label[order]
    if not len(h):
        return [h, w, label, label]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    n1 = np.add.reduceat(label, first)
    n = np.diff(np.r_[first, len(h)])
    return [h[first], w[first], n - n1, n1]


def bigram_counts(labelled: DataFrame) -> DataFrame:
    """``h, w, n0, n1`` over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for text, label in zip(texts_of(batch), batch.column(1).to_pylist()):
                h, w = bigrams(text)
                parts.append((h, w, np.full(len(h), label, np.int64)))
                size += len(h)
                if size > COUNTED:
                    yield from tables(parts)
                    parts, size = [], 0
        yield from tables(parts)

    def tables(parts) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        h, w, label = (np.concatenate([p[i] for p in parts]) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int64)) for c in _summed(h, w, label)],
            names=["h", "w", "n0", "n1"],
        )

    rows = labelled.select("text", "label").mapInArrow(
        count, "h bigint, w bigint, n0 bigint, n1 bigint"
    )
    return rows.groupBy("h", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _ratio(a: Column, b: Column, total_a: float, total_b: float) -> Column:
    """The likelihood ratio (G squared) of two classes with the same share."""

    def part(n: Column, total: float) -> Column:
        expected = (a + b) * (total / (total_a + total_b))
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    return 2 * (part(a, total_a) + part(b, total_b))


def _weight(ratio: Column) -> Column:
    return ratio * ratio / (ratio * ratio + STRENGTH**2)


def _own(count: Column) -> Column:
    return F.greatest(count - DISCOUNT, F.lit(0.0))


def fit(labelled: DataFrame) -> tuple[DataFrame, float] | None:
    """``key, value`` of every bigram, history and word in ``text, label`` rows of the whole corpus,
    and the value of a word that is in none. ``None`` if a class has no bigram.

    The log-likelihood difference of a bigram is the sum of the values of its history, its word and
    itself, where known, and the value of an unknown word, which is left out of those of words.
    What the model was made from is deleted as soon as it is stored.
    """
    tables = Tables(labelled.sparkSession, "toxicity")
    counts = tables.put("counts", bigram_counts(labelled))
    tokens = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not tokens["n0"] or not tokens["n1"]:
        tables.drop("counts")
        return None
    n = [float(tokens[f"n{c}"]) for c in (0, 1)]
    # Types (continuation counts) and tokens of each word.
    words = counts.groupBy("w").agg(
        F.sum("n0").alias("n0"),
        F.sum("n1").alias("n1"),
        F.sum((F.col("n0") > 0).cast("bigint")).alias("t0"),
        F.sum((F.col("n1") > 0).cast("bigint")).alias("t1"),
        F.count(F.lit(1)).alias("t"),
    )
    words = tables.put("types", words)
    types = words.agg(*[F.sum(c).alias(c) for c in ("t0", "t1", "t")]).first()
    t = [float(types[f"t{c}"]) for c in (0, 1)]
    ratio = F.least(
        _ratio(F.col("t0"), F.col("t1"), *t), _ratio(F.col("n0"), F.col("n1"), *n)
    )
    words = words.select(
        "w", "t", *[(_own(F.col(f"t{c}")) * _weight(ratio) / t[c]).alias(f"o{c}") for c in (0, 1)]
    )
    kept = words.agg(F.sum("o0").alias("o0"), F.sum("o1").alias("o1")).first()
    left = [1 - kept[f"o{c}"] for c in (0, 1)]
    other = float(np.log(left[1]) - np.log(left[0]))
    shared = F.col("t") / float(types["t"])
    words = words.select("w", *[(F.col(f"o{c}") + left[c] * shared).alias(f"b{c}") for c in (0, 1)])
    words = tables.put("words", words)
    tables.drop("types")
    weight = _weight(_ratio(F.col("n0"), F.col("n1"), *n))
    pairs = counts.select(
        "h", "w", "n0", "n1", _own(F.col("n0") + F.col("n1")).alias("s"),
        *[(_own(F.col(f"n{c}")) * weight).alias(f"o{c}") for c in (0, 1)],
    )
    heads = pairs.groupBy("h").agg(
        *[F.greatest(F.sum(f"n{c}"), F.lit(1)).alias(f"h{c}") for c in (0, 1)],
        *[F.sum(f"o{c}").alias(f"m{c}") for c in (0, 1)],
        F.sum(F.col("n0") + F.col("n1")).alias("hs"),
        F.sum("s").alias("ms"),
    )
    heads = tables.put(
        "heads",
        heads.select(
            "h", "h0", "h1", "hs", (1 - F.col("ms") / F.col("hs")).alias("rs"),
            *[(1 - F.col(f"m{c}") / F.col(f"h{c}")).alias(f"r{c}") for c in (0, 1)],
        ),
    )
    joined = by_size(by_size(pairs, heads, ["h"], "inner"), words, ["w"], "inner")

    def both(c: int) -> Column:
        back = F.col("s") / F.col("hs") + F.col("rs") * F.col(f"b{c}")
        return F.col(f"o{c}") / F.col(f"h{c}") + F.col(f"r{c}") * back

    def difference(one: Column, zero: Column) -> Column:
        return F.log(one) - F.log(zero)

    of_head, of_word = (difference(F.col(f"{x}1"), F.col(f"{x}0")) for x in "rb")
    model = (
        joined.select(
            F.xxhash64("h", "w").alias("key"), (difference(both(1), both(0)) - of_head - of_word).alias("value")
        )
        .unionByName(heads.select(F.xxhash64("h", F.lit(_HEAD)).alias("key"), of_head.alias("value")))
        .unionByName(
            words.select(F.xxhash64(F.lit(_ALONE), "w").alias("key"), (of_word - other).alias("value"))
        )
    )
    model = keep(model, "toxicity_model")
    tables.drop("counts", "words", "heads")
    return model, other


def _differences(words: dict, pairs: dict, totals: tuple[float, float, float]) -> dict:
    """The formulas of ``fit`` for counts in memory, to compare with.

    ``kept`` is the part of the discounted counts that stays with a row, all of it if missing.
    ``s`` is the probability of a bigram in the shared counts and ``rs`` what its history leaves
    there; without them a bigram backs off to its word at once.
    """
    shared = totals[2]

    def own(rows: dict, name: str) -> np.ndarray:
        return np.maximum(rows[name] - DISCOUNT, 0.0) * rows.get("kept", 1.0)

    own_types = [own(words, f"t{c}") for c in (0, 1)]
    left = [1 - own_types[c].sum() / totals[c] for c in (0, 1)]
    order = np.argsort(words["w"])

    def word_probability(rows: dict, c: int) -> np.ndarray:
        at = order[np.searchsorted(words["w"], rows["w"], sorter=order)]
        return own_types[c][at] / totals[c] + left[c] * rows["t"] / shared

    word = [word_probability(words, c) for c in (0, 1)]
    heads, at = np.unique(pairs["h"], return_inverse=True)
    mass, both = [], []
    for c in (0, 1):
        seen = own(pairs, f"n{c}") / np.maximum(pairs[f"h{c}"], 1)
        rest = 1 - np.bincount(at, seen, len(heads))
        mass.append(rest)
        back = pairs.get("s", 0.0) + pairs.get("rs", 1.0) * word_probability(pairs, c)
        both.append(seen + rest[at] * back)
    key = pair(pairs["h"].astype(np.uint64), pairs["w"].astype(np.uint64))
    order, word_order = np.argsort(key), np.argsort(words["w"].astype(np.uint64))
    head_order = np.argsort(heads.astype(np.uint64))
    ratio = lambda p: np.log(p[1]) - np.log(p[0])
    return {
        "pairs": (key[order], ratio(both)[order]),
        "words": (words["w"].astype(np.uint64)[word_order], ratio(word)[word_order]),
        "heads": (heads.astype(np.uint64)[head_order], ratio(mass)[head_order]),
        "other": float(np.log(left[1]) - np.log(left[0])),
    }


def gathered(docs: DataFrame) -> DataFrame:
    """What is to be looked up for ``text``, and the other columns of ``docs``, in one table.

    Documents are gathered in blocks. A row with ``docs`` has a key once for a block and names the
    documents it is in, as often as it counts. A row with ``n`` is a document of the block and has
    its number of bigrams and its columns; its key is of no expression.
    """
    names = [c for c in docs.columns if c != "text"]
    fields = [f for f in docs.schema.fields if f.name != "text"]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    head, every = np.uint64(_HEAD), np.uint64(_ALONE)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, parts, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            if size > COUNTED or first > GATHERED:
                yield terms(block, parts)
                block, first, parts, size = block + 1, 0, [], 0
            n = []
            for i, text in enumerate(texts_of(batch)):
                h, w = bigrams(text)
                n.append(len(h))
                if len(h):
                    keys = np.concatenate([pair(h, w), pair(h, head), pair(every, w)])
                    parts.append((keys, np.full(len(keys), first + i, np.int32)))
                size += len(h)
                if size > COUNTED:
                    yield terms(block, parts)
                    parts, size = [], 0
            places = np.arange(first, first + len(n))
            first += len(n)
            known = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            yield rows(
                len(n),
                block=pa.array(np.full(len(n), block, np.int64)),
                key=pa.array(pair(np.full(len(n), block, np.uint64), places.astype(np.uint64)).view(np.int64)),
                doc=pa.array(places.astype(np.int32)),
                n=pa.array(n, pa.int64()),
                **known,
            )
        yield terms(block, parts)

    def terms(block: int, parts: list) -> pa.RecordBatch:
        keys = np.concatenate([np.empty(0, np.uint64), *[k for k, _ in parts]])
        at = np.concatenate([np.empty(0, np.int32), *[d for _, d in parts]])
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        offsets = np.r_[new, len(keys)].astype(np.int32)
        return rows(
            len(new),
            block=pa.array(np.full(len(new), block, np.int64)),
            key=pa.array(keys[new].view(np.int64)),
            docs=pa.ListArray.from_arrays(pa.array(offsets), pa.array(at)),
        )

    empty = {"block": pa.int64(), "key": pa.int64(), "docs": pa.list_(pa.int32()), "doc": pa.int32(),
             "n": pa.int64()}
    empty |= {f.name: to_arrow_type(f.dataType) for f in fields}

    def rows(size: int, **columns: pa.Array) -> pa.RecordBatch:
        arrays = [columns[c] if c in columns else pa.nulls(size, t) for c, t in empty.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(empty))

    schema = "block bigint, key bigint, docs array<int>, doc int, n bigint"
    return docs.mapInArrow(gather, f"{schema}, {types}")


def differences(
    docs: DataFrame, model: tuple[DataFrame, float] | None, bound: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs`` with ``x`` in place of ``text``: the difference of each whole text, NULL without
    words or model. The result is stored. ``id`` deals the documents to parts."""
    names = [c for c in docs.columns if c != "text"]
    if model is None:
        return keep(docs.select(*names, F.lit(None).cast("double").alias("x")), "toxicity_scores")
    table, other = model
    if measured_bytes(table) <= bound:
        found = gathered(docs).join(F.broadcast(table), "key", "left")
        return keep(_totals(found, names, other), "toxicity_scores")
    spark = docs.sparkSession
    part = F.coalesce(remainder("id", PARTS), F.lit(0))
    # In buckets of the key the model is shuffled and sorted once, not again for each part.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, folder = f"toxicity_{uuid.uuid4().hex}", shared_folder(spark, "toxicity_buckets")
    dealt = table.repartition(n, "key").write.bucketBy(n, "key").sortBy("key")
    dealt.option("compression", "zstd").option("path", folder).saveAsTable(name)
    try:
        kept = []
        for i in range(PARTS):
            found = gathered(docs.filter(part == i)).join(spark.table(name).hint("merge"), "key", "left")
            kept.append(keep(_totals(found, names, other), "toxicity_scores"))
    finally:
        spark.sql(f"DROP TABLE {name}")
        drop_folder(spark, folder)
    return reduce(DataFrame.unionByName, kept)


def _totals(found: DataFrame, names: list[str], other: float) -> DataFrame:
    """Each document's ``names`` and ``x``, from its expressions with their values."""
    # A key that is not in the model adds nothing; a document is a row of its own.
    found = found.filter(F.col("n").isNotNull() | F.col("value").isNotNull())
    place = F.explode(F.coalesce("docs", F.array("doc")))
    sums = found.select("block", place.alias("at"), "n", "value", *names).groupBy("block", "at")
    sums = sums.agg(
        F.sum("value").alias("value"),
        F.max("n").alias("n"),
        *[F.first(c, ignorenulls=True).alias(c) for c in names],
    )
    x = F.when(F.col("n") > 0, other + F.coalesce("value", F.lit(0.0)) / F.col("n"))
    return sums.select(*names, x.alias("x"))


def _on_curve(found: DataFrame, curve: tuple[list[float], list[float], float]) -> DataFrame:
    """``found`` with the probability in place of the difference ``x``."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("x")
            x = [probability(value, *curve) for value in batch.column(at).to_pylist()]
            yield batch.set_column(at, "x", pa.array(x, pa.float64()))

    return found.mapInArrow(place, types)


def probability(x: float | None, places: list[float], values: list[float], base: float) -> float:
    """The curve at ``x``; a thousandth of it rises with ``x``, so that equal levels keep order."""
    if x is None or not places:
        return base
    level = float(np.interp(x, places, values))
    return 0.999 * level + 0.001 / (1 + float(np.exp(-10 * max(-1.0, min(1.0, x)))))


def calibrate(scored: DataFrame) -> tuple[list[float], list[float], float]:
    """Places and values of a rising curve from differences to probabilities, and the base rate.

    ``scored`` has ``x`` and ``label``. All its rows are counted, in bins of a fixed number.
    """
    bin_ = F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("x"))) * BINS)
    rows = (
        scored.groupBy(bin_.alias("bin"))
        .agg(F.sum(1 - F.col("label")).alias("n0"), F.sum("label").alias("n1"))
        .collect()
    )  # at most 2 * BINS + 2
    n0, n1 = sum(r["n0"] for r in rows), sum(r["n1"] for r in rows)
    base = (n1 + 0.5) / (n0 + n1 + 1)
    blocks: list[list[float]] = []  # pooled neighbours: first and last place, n0, n1
    for r in sorted((r for r in rows if r["bin"] is not None), key=lambda r: r["bin"]):
        place = (r["bin"] + 0.5) / BINS
        blocks.append([place, place, r["n0"], r["n1"]])
        while len(blocks) > 1 and _rate(blocks[-2]) >= _rate(blocks[-1]):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    places, values = [], []
    for first, last, no, yes in blocks:
        rate = (yes + 0.5) / (no + yes + 1)
        rate = max(rate, values[-1]) if values else rate
        places += [first] if first == last else [first, last]
        values += [rate] if first == last else [rate, rate]
    return places, values, base


def _rate(block: list[float]) -> float:
    return block[3] / (block[2] + block[3])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learns: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``id_col, score`` per row, learned from the labelled rows of ``docs`` where ``learns``.

    A fifth of these, by ``crc32`` of the id, calibrates and is not in the models. Labels are 0 or
    1; NULL labels and ids teach nothing. Texts without words, and all texts if a class has no
    example, have the base rate (a half without any label). Repeated rows count each time; an empty
    table gives no rows. Texts of any length are read whole, each expression once. Other columns are
    not read, whatever their names.
    """
    in_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("bigint").alias("label"))
    rows = docs.filter(learns).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    labelled = by_size(rows, known, ["id"], "inner")
    fold = remainder("id", 5) == 0
    texts = docs.select(
        F.col(id_col).alias("id"), learns.alias("learns"), F.col(text_col).alias("text")
    )
    spark = docs.sparkSession
    before = spark.conf.get(_CLEANED, "false")
    spark.conf.set(_CLEANED, "true")
    try:
        found = differences(texts, fit(labelled.filter(~fold)))
    finally:
        spark.conf.set(_CLEANED, before)
    scored = by_size(found.filter("learns").select("id", "x"), known, ["id"], "inner").filter(fold)
    return _on_curve(found.select("id", "x"), calibrate(scored)).toDF(id_col, "score")
