"""Language identification by words first, with backoff to character n-grams.

A word that the languages use often enough is scored by its log frequency in each of them. Any
other word is covered by the longest known character n-grams, falling back to shorter ones place
by place. A document has the language with the greatest sum.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import Shared, in_batches, keep, texts_of

UNKNOWN = "und"

# A word is known if its mean share over the languages is at least this, so at most 1 / WORD_SHARE
# words are, whatever the corpus. The same holds for the n-grams of each length.
WORD_SHARE = 5e-6
GRAM_SHARE = 1e-5
LONGEST = 4

# Entries that a worker counts before it passes them on, and unknown words that it remembers.
COUNTED = 400_000
REMEMBERED = 400_000

# Words of a text that are looked up at once; fewer than a worker remembers.
PART = 100_000

_RUN = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    words = _RUN.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, words)):
        return words
    return [part for word in words for part in _LETTERS.findall(word)]


def grams_of(word: str, longest: int = LONGEST) -> list[str]:
    """All n-grams of the word between boundary marks."""
    padded = f"^{word}$"
    size = len(padded) + 1
    return [padded[i : i + n] for n in range(1, longest + 1) for i in range(size - n)]


class _Tally:
    """Counts by language, passed on whenever there are too many of them."""

    def __init__(self):
        self.by_lang: dict[str, Counter] = {}

    def of(self, lang: str) -> Counter:
        return self.by_lang.setdefault(lang, Counter())

    def full(self) -> bool:
        return sum(map(len, self.by_lang.values())) > COUNTED

    def taken(self) -> pa.RecordBatch:
        langs, items, counts = [], [], []
        for lang, counter in self.by_lang.items():
            langs += [lang] * len(counter)
            items += counter.keys()
            counts += counter.values()
        self.by_lang = {}
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(items, pa.string()), pa.array(counts, pa.int64())],
            names=["lang", "item", "n"],
        )


_COUNTS = "lang string, item string, n bigint"


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, item, n`` over all documents with a language; counted in the workers first."""
    rows = docs.filter(F.col(lang_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                tally.of(lang).update(words_of(text))
                if tally.full():
                    yield tally.taken()
        yield tally.taken()

    return rows.mapInArrow(count, _COUNTS).groupBy("lang", "item").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, item, n`` of the n-grams in the counted words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for lang, word, n in zip(*columns):
                counter = tally.of(lang)
                for gram in grams_of(word, longest):
                    counter[gram] = counter.get(gram, 0) + n
            if tally.full():
                yield tally.taken()
        yield tally.taken()

    return words.mapInArrow(count, _COUNTS).groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, share: float, by_length: bool) -> tuple[list[str], np.ndarray, list[str]]:
    """The items with a mean share of ``share`` or more, and their log frequencies by language."""
    size = F.length("item") if by_length else F.lit(0)
    counts = counts.withColumn("size", size)
    totals = {
        (r["lang"], r["size"]): r["n"]
        for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    }  # a row per language and length
    langs = sorted({lang for lang, _ in totals})
    if not langs:
        return [], np.zeros((0, 0)), []
    spark = counts.sparkSession
    known = spark.createDataFrame(
        [(lang, size, float(n)) for (lang, size), n in totals.items()],
        "lang string, size int, total double",
    )
    shares = counts.join(F.broadcast(known), ["lang", "size"]).groupBy("item").agg(
        F.sum(F.col("n") / F.col("total")).alias("share"),
        F.collect_list(F.struct("lang", "n")).alias("by_lang"),  # one entry per language
    )
    rows = shares.filter(F.col("share") >= share * len(langs)).select("item", "by_lang").collect()
    place = {lang: i for i, lang in enumerate(langs)}
    found = np.full((len(rows), len(langs)), 0.5)
    base = np.empty_like(found)
    for i, row in enumerate(rows):
        for entry in row["by_lang"]:
            found[i, place[entry["lang"]]] += entry["n"]
        size = len(row["item"]) if by_length else 0
        base[i] = [totals.get((lang, size), 0) + 0.5 * len(rows) for lang in langs]
    return [r["item"] for r in rows], np.log(found / base), langs


class Model:
    """Scores of words, for one Python worker."""

    def __init__(self, parts):
        self.langs, words, word_logs, grams, gram_logs = parts
        self.grams = {gram: i for i, gram in enumerate(grams)}
        self.gram_logs = np.asarray(gram_logs, np.float64)
        self.known = len(words)
        self.table = np.zeros((self.known + REMEMBERED, len(self.langs)))
        self.table[: self.known] = word_logs
        self.place = {word: i for i, word in enumerate(words)}
        self.met: list[str] = []

    def backoff(self, words: list[str]) -> np.ndarray:
        """A row per word: the longest known n-gram from each place on, falling back to shorter
        ones; each stands for its part of the word."""
        rows, weights, of = [], [], []
        for number, word in enumerate(words):
            padded = f"^{word}$"
            for i in range(len(padded)):
                for n in range(min(LONGEST, len(padded) - i), 0, -1):
                    at = self.grams.get(padded[i : i + n])
                    if at is not None:
                        rows.append(at)
                        weights.append(1.0 / n)
                        of.append(number)
                        break
        logs = self.gram_logs[rows] * np.array(weights)[:, None] if rows else None
        return np.stack(
            [
                np.bincount(of, logs[:, i], len(words)) if rows else np.zeros(len(words))
                for i in range(len(self.langs))
            ],
            axis=1,
        )

    def _learn(self, words: list[str]) -> None:
        if len(self.met) + len(words) > REMEMBERED:
            for word in self.met:
                del self.place[word]
            self.met = []
        start = self.known + len(self.met)
        self.table[start : start + len(words)] = self.backoff(words)
        self.place.update(zip(words, range(start, start + len(words))))
        self.met += words

    def predict(self, text: str) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for start in range(0, len(words), PART):
            part = words[start : start + PART]
            new = [word for word in set(part) if word not in self.place]
            if new:
                self._learn(new)
                # Learning may have made room.
                new = [word for word in set(part) if word not in self.place]
                if new:
                    self._learn(new)
            rows = np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))
            total += self.table[rows].sum(axis=0)
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))  # the first of equal ones
        return self.langs[best], float(odds[best] / odds.sum())


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang"):
    """The model parts, from all documents with a language. Counts are made by the executors; the
    driver gets the known words and n-grams, whose number is bounded by the shares."""
    in_batches(docs.sparkSession)
    counts = keep(word_counts(docs, text_col, lang_col), "language_words")
    words, word_logs, langs = _frequent(counts, WORD_SHARE, by_length=False)
    counted = keep(gram_counts(counts), "language_grams")
    grams, gram_logs, _ = _frequent(counted, GRAM_SHARE, by_length=True)
    return langs, words, word_logs, grams, gram_logs


def identify(
    docs: DataFrame, parts, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, lang_pred, score`` per row, from whole texts.

    ``score`` is the share of the language in the likelihoods. NULL texts, texts without a letter,
    and all texts if nothing was learned, are ``und`` with 0. Equal languages give the first in
    order. NULL and repeated ids are passed on, each row with its own result; an empty table gives
    no rows. Texts of any length are read whole. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    in_batches(spark)
    shared = Shared(spark, parts, Model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for batch in batches:
            found = [model.predict(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    schema = f"id {id_type}, lang_pred string, score double"
    return rows.mapInArrow(predict, schema).withColumnRenamed("id", id_col)
