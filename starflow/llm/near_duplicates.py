"""MinHash near-duplicates by an inverted join on signature coordinates.

Each document posts its value of every signature coordinate. Two documents can agree in at least
``matches`` of ``k`` coordinates only if they share one of the ``k - matches + 1`` rarest postings
of each (prefix), and a document with fewer than ``matches`` shared postings is skipped at once.
Pairs from the prefixes are counted over whole signatures, and those that reach the threshold are
confirmed on full shingle sets.

No group is ever expanded into all pairs. First each posting group links its members to one of
them, confirmed links become components, and only what is still in different components is
looked at after that, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.clusters import blocks, cluster_members, links_by_columns, open_edges
from starflow.llm.common import by_size, in_batches, keep, texts_of
from starflow.llm.components import components

WORDS = 5
PERCENT = 75

# A pair of 75 percent agrees in 48 of 64 coordinates on average, with a deviation of 3.5; fewer
# than 32 are as likely as two in a million.
COORDINATES = 64
MATCHES = 32

# Documents of one block where those that are still apart are compared.
BLOCK = 512

# Words of which a worker remembers the hash; beyond that it starts anew.
REMEMBERED = 100_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Hashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words, A-Z being lower-cased.

    Words are parted by ASCII white space. With fewer words the whole sequence is the one run,
    without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = (total ^ h[i : i + n]) * _STEP
        total ^= total >> np.uint64(32)
    return np.unique(_mixed(total))


@lru_cache(maxsize=4)
def orders(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that put the hashes in ``k`` orders: ``(hash ^ first) * second``, with odd factors."""
    i = np.arange(1, 2 * k + 1, dtype=np.uint64)
    drawn = _mixed(i * _STEP)
    return drawn[:k], drawn[k:] | np.uint64(1)


def signature(hashes: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The least of the hashes in each of ``k`` orders. Long sets are taken in blocks, so memory
    is bounded."""
    flips, factors = orders(k)
    least = np.full(k, np.iinfo(np.uint64).max)
    for start in range(0, len(hashes), 2048):
        block = (hashes[None, start : start + 2048] ^ flips[:, None]) * factors[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, k: int) -> DataFrame:
    """``id, n, fp1, fp2, sig`` per row: size, 128-bit fingerprint and signature of its set."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    in_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp1, fp2, sig = [], [], [], []
            for text in texts_of(batch):
                h = shingle_hashes(text, size)
                n.append(len(h))
                fp1.append(int(_mixed(h ^ _STEP).sum(dtype=np.uint64).astype(np.int64)))
                fp2.append(int(_mixed(h + _STEP).sum(dtype=np.uint64).astype(np.int64)))
                sig.append(signature(h, k).astype(np.int64) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()),
                    pa.array(fp2, pa.int64()), pa.array(sig, pa.list_(pa.int64())),
                ],
                names=["id", "n", "fp1", "fp2", "sig"],
            )

    return rows.mapInArrow(sign, "id bigint, n bigint, fp1 bigint, fp2 bigint, sig array<bigint>")


def shared_postings(signed: DataFrame, k: int, matches: int) -> DataFrame:
    """``id, coordinate, value`` of the prefix of each document that can have a partner."""
    posts = signed.select("id", F.posexplode("sig").alias("coordinate", "value"))
    often = posts.groupBy("coordinate", "value").agg(F.count(F.lit(1)).alias("freq"))
    often = often.filter(F.col("freq") > 1)
    # A document has k postings, so the list of one is bounded.
    shared = (
        posts.join(often.hint("merge"), ["coordinate", "value"])
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("freq", "coordinate", "value"))).alias("posts"))
        .filter(F.size("posts") >= matches)
    )
    # Postings that nobody shares are the rarest: they come first in the prefix of k-matches+1.
    length = F.size("posts") - F.lit(matches - 1)
    prefix = F.slice("posts", F.lit(1), length)
    return shared.select("id", F.explode(prefix).alias("p")).select(
        "id", "p.coordinate", "p.value"
    )


def enough_matches(pairs: DataFrame, signed: DataFrame, matches: int) -> DataFrame:
    """The pairs ``a, b`` whose whole signatures agree in ``matches`` coordinates or more."""
    left = signed.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = signed.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    equal = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
    count = F.aggregate(equal, F.lit(0), lambda total, one: total + one)
    return (
        pairs.join(left.hint("merge"), "a")
        .join(right.hint("merge"), "b")
        .select("a", "b", count.alias("agree"))
        .filter(F.col("agree") >= matches)
    )


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have ``100 * both >= percent * either``."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = (
        pairs.select("a", "b")
        .join(left.hint("merge"), "a")
        .join(right.hint("merge"), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None
        for batch in batches:
            good = []
            for i, (one, other) in enumerate(zip(batch.column(2), batch.column(3))):
                one, other = one.as_py() or "", other.as_py() or ""
                if other != before:  # rows of one b stand together
                    before, last = other, shingle_hashes(other, size)
                mine = shingle_hashes(one, size)
                both = len(np.intersect1d(mine, last, assume_unique=True))
                if both and 100 * both >= percent * (len(mine) + len(last) - both):
                    good.append(i)
            rows = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"]
            )

    return joined.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WORDS,
    percent: int = PERCENT,
    k: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept``, one row per input row.

    Documents are linked if their shingle sets have a Jaccard similarity of ``percent`` or more;
    ``component_id`` is the least id that can be reached and ``kept`` marks the row that has it.
    NULL and empty texts have an empty set and are linked with nothing. Rows with a NULL id take no
    part: their component is NULL and they are kept. Rows that share an id must hold the same text
    to be one document; if they do not, their links are joined. Ids must be integers. An empty
    table gives no rows. Texts of any length are compared whole; one set must fit into a worker's
    memory, eight bytes for each distinct shingle. Other columns are not read, whatever their names.
    """
    signed = keep(signatures(docs, id_col, text_col, size, k), "near_signatures")
    # Equal sets are one document from here on.
    full = signed.filter((F.col("n") > 0) & F.col("id").isNotNull())
    # Stored, so that both sides of the join are shuffled and a large group can be split.
    groups = full.groupBy("fp1", "fp2", "n").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    groups = groups.filter(F.col("first") != F.col("last")).drop("last")
    groups = keep(groups, "near_groups")
    equal = keep(
        full.select("id", "fp1", "fp2", "n").join(groups.hint("merge"), ["fp1", "fp2", "n"])
        .filter(F.col("id") != F.col("first")).select("id", "first").distinct(),
        "near_equal",
    )
    copies = equal.select("id").distinct()
    reps = full.select("id", "sig").join(copies.hint("merge"), "id", "left_anti")
    posts = keep(shared_postings(reps, k, matches), "near_postings")
    members = posts.select("id").distinct()
    signed_members = keep(reps.join(members.hint("merge"), "id", "left_semi"), "near_members")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    texts = keep(
        by_size(texts, keep(members, "near_ids"), ["id"], "left_semi").dropDuplicates(["id"]),
        "near_texts",
    )
    links = _all_links(posts, signed_members, texts, size, percent, matches)
    edges = links.unionByName(equal.select(F.col("id").alias("a"), F.col("first").alias("b")))
    roots = keep(components(edges), "near_components")
    return (
        signed.select("id", "n")
        .join(roots.withColumnRenamed("node", "id").hint("merge"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("root", "id").alias("component_id"),
            F.coalesce(F.coalesce("root", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def _all_links(posts, signed, texts, size: int, percent: int, matches: int) -> DataFrame:
    """Links between representatives that give the same components as all links would."""
    # Each posting group names one member; the order differs from group to group.
    shuffled = F.col("id").bitwiseXOR(F.xxhash64("coordinate", "value"))
    heads = posts.groupBy("coordinate", "value").agg(F.min(shuffled).alias("least"))
    heads = heads.select(
        "coordinate",
        "value",
        F.col("least").bitwiseXOR(F.xxhash64("coordinate", "value")).alias("head"),
    )
    heads = keep(heads, "near_heads")
    stars = (
        posts.join(heads.hint("merge"), ["coordinate", "value"])
        .filter(F.col("id") != F.col("head"))
        .select(F.greatest("id", "head").alias("a"), F.least("id", "head").alias("b"))
        .distinct()
    )
    stars = keep(enough_matches(stars, signed, matches), "near_stars")
    # The closest partner of each document first: most links come from these.
    best = stars.groupBy("a").agg(F.max("agree").alias("agree"))
    nearest = (
        stars.join(best.hint("merge"), ["a", "agree"]).groupBy("a").agg(F.min("b").alias("b"))
    )
    links = keep(confirmed(nearest, texts, size, percent), "near_links")
    roots = keep(components(links), "near_roots")
    # All other pairs of the stars that are not connected yet.
    tested = stars.select("a", "b").join(nearest.hint("merge"), ["a", "b"], "left_anti")
    more = keep(confirmed(_apart(tested, roots), texts, size, percent), "near_links")
    links = links.unionByName(more)
    roots = keep(components(links), "near_roots")
    # Members of a posting group that are still apart are compared in blocks, on full sets.
    tied = keep(open_edges(posts, heads, roots, ["coordinate", "value"]).distinct(), "near_open")
    placed = keep(blocks(tied, BLOCK), "near_blocks")
    sets = _sets(texts.join(placed.select("id").hint("merge"), "id", "left_semi"), size)
    rows = cluster_members(keep(sets, "near_sets"), placed, roots)
    return links.unionByName(keep(links_by_columns(rows, percent), "near_links"))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``id, items``: the shingle hashes of each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(text, size).astype(np.int64) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "items"]
            )

    return texts.select("id", "text").mapInArrow(cut, "id bigint, items array<bigint>")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose members are in different components."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return (
        pairs.join(a.hint("merge"), "a", "left")
        .join(b.hint("merge"), "b", "left")
        .filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select("a", "b")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """``docs`` with one document of each component, the one with the least id; rows with a NULL
    id stay, and rows that repeat an id stay or go together. All columns are as they were."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = keep(found.filter(~F.col("kept")).select(F.col(id_col).alias("__gone")), "near_gone")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = f"c{names.index(id_col)}"
    gone = gone.select(F.col("__gone").alias(key)).distinct()
    return by_size(inner, gone, [key], "left_anti").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    )
