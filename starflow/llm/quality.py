"""Quality by hierarchical empirical Bayes.

A logistic model gives each document evidence from its text: what it looks like, and the words in
it, hashed. Hosts and paths below them get posteriors by grouped aggregation over all documents:
labels where there are any, the evidence where there are none. A sparse path is shrunk towards its
host and a sparse host towards the global prior, as far as the spread between sites says. The
evidence and the posterior of the site without the document itself are combined as odds, so that
what a document says about itself counts once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import by_size, in_batches, keep, texts_of

# Labelled documents that the logistic model is fitted on, in the order of a hash of their id.
# Everything else covers all documents.
FITTED = 20_000

# Documents with a lower chance of good quality are rejected. A rejected document is lost, so the
# bound is well on the safe side of a half.
LEAST = 0.2

# Leading bits of the hash by which rows are counted to find those.
PART_BITS = 12

ROUNDS = 30
RIDGE = 1.0

# Strength of the prior where the spread between sites says nothing.
STRONGEST = 1e6

_SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ODD = b"#$%&*|!~^=<>{}[]\\_@"

# Words are counted in so many places, by their hash.
HASHED = 64


def features(text: str) -> list[float]:
    """What the text looks like, whatever its language, and the shares of its words by their hash."""
    data = text.encode("utf-8", "surrogatepass")
    n = max(1, len(data))
    words = data.split()
    w = max(1, len(words))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    upper = n - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = n - len(data.translate(None, b"0123456789"))
    symbols = n - len(data.translate(None, _SYMBOLS))
    odd = n - len(data.translate(None, _ODD))
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = data.count(b"\n") + 1
    hashed = [0] * HASHED
    for word, count in counts.items():
        hashed[zlib.crc32(word.lower()) % HASHED] += count
    return [
        math.log1p(len(words)),
        math.log(n / w),
        len(counts) / w / (w**-0.15),
        top / w,
        math.log1p(100 * upper / n),
        math.log1p(100 * digits / n),
        math.log1p(100 * symbols / n),
        math.log1p(100 * odd / n),
        math.log1p(100 * same / w),
        math.log1p(100 * data.count(b"|") / w),
        math.log1p(100 * lines / w),
        1.0 if not words else 0.0,
        *(math.sqrt(count / w) for count in hashed),
    ]


N_FEATURES = len(features(""))


def _expanded(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, rows**2], axis=1)


def fit(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights of a ridge logistic regression, by Newton steps."""
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = _expanded(np.clip((rows - centre) / scale, -6, 6))
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[0] = 1e-6
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (labels - p) - penalty * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return centre, scale, weights


def evidence(rows: np.ndarray, model) -> np.ndarray:
    """Log odds of good quality."""
    centre, scale, weights = model
    x = _expanded(np.clip((rows - centre) / scale, -6, 6))
    return np.clip(weights[0] + x @ weights[1:], -12, 12)


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def site_sums(documents: DataFrame, host: str, path: str) -> tuple[DataFrame, float, float, float]:
    """``host, path, good, n, host_good, host_n`` for each path, the global prior, and the strengths
    of the prior at hosts and of hosts at paths, from ``y``: a label or a chance.

    The strength of a level is the prior's equivalent number of documents, by moments of the site
    rates. Documents are summed by path before anything is shuffled, so hot sites do not matter.
    """
    paths = documents.groupBy(host, path).agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n"))
    paths = keep(paths, "quality_paths")
    hosts = paths.groupBy(host).agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    hosts = keep(hosts, "quality_hosts")
    total = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n")).first()
    same = F.col(host).eqNullSafe(F.col("__host"))
    paths = paths.join(hosts.withColumnRenamed(host, "__host"), same).drop("__host")
    if not total["n"]:
        return paths, 0.5, 1.0, 1.0
    prior = (total["good"] + 0.5) / (total["n"] + 1)
    above = _strength(hosts, "host_good", "host_n", F.lit(prior), prior)
    paths = keep(paths, "quality_sites")
    rate = _rate("host_good", "host_n", above, F.lit(prior))
    return paths, prior, above, _strength(paths, "good", "n", rate, prior)


def _rate(good: str, n: str, strength: float, parent: Column, without: Column | None = None) -> Column:
    """``(good + strength * parent) / (n + strength)``; ``without`` is the share of one document that
    is left out."""
    if without is None:
        return (F.col(good) + strength * parent) / (F.col(n) + strength)
    return (F.greatest(F.col(good) - without, F.lit(0.0)) + strength * parent) / (F.col(n) - 1 + strength)


def posteriors(documents: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """``host, path, site`` for each path, and the global prior.

    ``site`` is ``(sum + strength * parent) / (n + strength)``, at the host with the prior as its
    parent, at the path with the host.
    """
    paths, prior, above, below = site_sums(documents, host, path)
    parent = _rate("host_good", "host_n", above, F.lit(prior))
    return paths.select(host, path, _rate("good", "n", below, parent).alias("site")), prior


def _strength(sites: DataFrame, good: str, n: str, parent: Column, prior: float) -> float:
    """How many documents the parent's rate counts for: little if the sites differ much."""
    rate = F.col(good) / F.col(n)
    row = sites.agg(
        F.sum(F.col(n) * (rate - parent) ** 2).alias("spread"),
        F.sum(n).alias("n"),
        F.sum(F.col(n).cast("double") ** 2).alias("squares"),
        F.count(F.lit(1)).alias("sites"),
    ).first()
    chance = prior * (1 - prior)
    rest = row["n"] - row["squares"] / row["n"]
    between = (row["spread"] - (row["sites"] - 1) * chance) / rest if rest > 0 else 0.0
    if between <= chance / STRONGEST:
        return STRONGEST
    return max(1.0, chance / between - 1)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fitted: int = FITTED,
) -> DataFrame:
    """``id_col, evidence, site, score``, one row per input row.

    ``evidence`` is the chance of good quality by the text alone, ``site`` that of the other documents
    of the path, and ``score`` both together. ``host`` and ``path`` are expressions over ``docs``; NULL is a site of
    its own. Labels are 0 or 1; NULL labels and ids teach nothing. NULL texts are empty texts.
    Without labels of both kinds the evidence is the rate of the labels there are, or a half. The
    classifier is fitted on at most ``fitted`` labelled rows, the site posteriors cover all rows. If
    an id is repeated or has several labels, the rows count each time, with the mean label. An empty
    table gives no rows. Texts of any length are read whole. Other columns are not read, but by
    ``host`` and ``path``.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.avg(label_col).alias("label"))
    described = _scored(docs, known, host, path, id_col, text_col, fitted)
    scored = described.withColumn("y", F.coalesce("label", "evidence"))
    sites, prior, above, below = site_sums(scored, "host", "path")
    sums = ("good", "n", "host_good", "host_n")
    key = lambda h, p: F.concat_ws("\u0001", F.coalesce(h, F.lit("\0")), F.coalesce(p, F.lit("\0")))
    sites = keep(sites.select(key(F.col("host"), F.col("path")).alias("key"), *sums), "quality_posteriors")
    found = by_size(scored.withColumn("key", key(F.col("host"), F.col("path"))), sites, ["key"], "left")
    parent = _rate("host_good", "host_n", above, F.lit(prior), F.col("y"))
    found = found.withColumn("site", _rate("good", "n", below, parent, F.col("y")))
    odds = _logit(F.col("evidence")) + _logit(F.col("site")) - _logit(F.lit(prior))
    return found.select(
        F.col("id").alias(id_col), "evidence", "site", (1 / (1 + F.exp(-odds))).alias("score")
    )


def _first_rows(taught: DataFrame, fitted: int) -> DataFrame:
    """The first ``fitted`` rows in the order of a hash of the id.

    Rows are counted by the leading bits of the hash first, and only those up to the part where the
    number is reached are sorted: what a task sends does not grow with the table.
    """
    part = F.shiftright(F.xxhash64("id"), 64 - PART_BITS)
    counts = taught.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    reached, last = 0, None
    for row in sorted(counts):
        reached, last = reached + row["n"], row["part"]
        if reached >= fitted:
            break
    first = taught.filter(part <= last) if last is not None else taught
    return first.orderBy(F.xxhash64("id"), "id", "x").limit(fitted)


def _taught(taught: DataFrame, fitted: int):
    """The model, ``None`` without labels of both kinds, and the rate of the labels. One task fits it
    on its bounded sample, and only the weights go to the driver."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [
            (batch.column(0).flatten().to_numpy().reshape(-1, N_FEATURES), batch.column(1).to_numpy())
            for batch in batches
            if batch.num_rows
        ]
        rows = np.concatenate([np.empty((0, N_FEATURES)), *(x for x, _ in parts)])
        y = np.concatenate([np.empty(0), *(y for _, y in parts)])
        del parts
        model = fit(rows, y) if len(np.unique(y)) > 1 else (None, None, None)
        yield pa.RecordBatch.from_arrays(
            [pa.array([float(y.mean()) if len(y) else 0.5]), *(pa.array([m], pa.list_(pa.float64())) for m in model)],
            names=["chance", "centre", "scale", "weights"],
        )

    schema = "chance double, centre array<double>, scale array<double>, weights array<double>"
    found = _first_rows(taught, fitted).select("x", "label").mapInArrow(learn, schema).collect()
    if not found:  # no labels, and so no task
        return None, 0.5
    row = found[0]
    model = tuple(np.array(row[c]) for c in ("centre", "scale", "weights")) if row["weights"] else None
    return model, row["chance"]


def _scored(docs, known, host, path, id_col, text_col, fitted: int) -> DataFrame:
    """``id, host, path, label, evidence`` of each row; labels are NULL where there are none."""
    spark = docs.sparkSession
    in_batches(spark)
    rows = docs.select(
        F.col(id_col).alias("id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.col(text_col).alias("text"),
    )
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))],
                names=["id", "host", "path", "x"],
            )

    described = rows.mapInArrow(describe, ", ".join([*fields, "x array<double>"]))
    described = keep(described, "quality_features")
    described = keep(by_size(described, keep(known, "quality_labels"), ["id"], "left"), "quality_labelled")
    model, chance = _taught(described.filter(F.col("label").isNotNull()), fitted)
    if model is None:
        return described.select("id", "host", "path", "label", F.lit(chance).alias("evidence"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(4).values.to_numpy().reshape(-1, N_FEATURES)
            chance = 1 / (1 + np.exp(-evidence(x, model)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(chance, pa.float64())],
                names=["id", "host", "path", "label", "evidence"],
            )

    schema = ", ".join([*fields, "label double, evidence double"])
    columns = described.select("id", "host", "path", "label", "x")
    return keep(columns.mapInArrow(judge, schema), "quality_evidence")


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col="doc_id", **options):
    """``docs`` without the rows whose score is below ``LEAST``; all columns as they were. Of rows
    that repeat an id, all go if one of them scores below. Rows with a NULL id stay."""
    scored = score_quality(docs, labels, host, path, id_col, **options)
    gone = scored.filter((F.col("score") < LEAST) & F.col(id_col).isNotNull())
    gone = keep(gone.select(F.col(id_col).alias("__gone")).distinct(), "quality_gone")
    names = docs.columns
    key = f"c{names.index(id_col)}"
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return by_size(inner, gone.withColumnRenamed("__gone", key), [key], "left_anti").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    )
