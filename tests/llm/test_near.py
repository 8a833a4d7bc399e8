"""Components, near-duplicates and line dedup against plain versions."""

from __future__ import annotations

import random

import numpy as np
from brute import near_duplicates, shingles

from starflow.llm import components as c
from starflow.llm import near_duplicates as near


def variants(seed=7, groups=12):
    """Texts with exact and near copies, borderline pairs, shared passages, and odd ones."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    texts = [None, "", "  \n", "one two", "One  two", "one two three", "a b c d e", "x y z w v u"]
    for _ in range(groups):
        base = [word() for _ in range(rnd.choice([4, 8, 30, 120, 300]))]
        for _ in range(rnd.choice([2, 3, 9])):
            words = list(base)
            for _ in range(rnd.choice([0, 1, 2, 5])):
                words[rnd.randrange(len(words))] = word()
            texts.append(" ".join(words))
            texts.append("\n".join(words))
        texts.append(" ".join(base[: len(base) * 3 // 4]))
        texts.append(" ".join([*passage, *base[:20]]))
    return list(enumerate(texts, 1))


def plain_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_near_duplicates_of_variants(spark):
    docs = variants()
    frame = spark.createDataFrame([(i, t, i, "z") for i, t in docs],
                                  "doc_id bigint, text string, id bigint, root string").repartition(5)
    expected = sorted(near_duplicates(docs))
    assert plain_rows(near.near_duplicates(frame)) == expected
    kept = near.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in expected if r[3]]


def test_a_chain_of_near_copies_is_one_component(spark):
    words, docs = [f"w{i}" for i in range(100)], []
    for i in range(25):
        docs.append((i + 1, " ".join(words)))
        words[4 * i : 4 * i + 2] = [f"n{i}", f"m{i}"]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r["component_id"] for r in near.near_duplicates(frame).collect()} == {1}


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (9, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(str, map(tuple, near.near_duplicates(frame).collect())))
    assert got == sorted(
        ["(None, 2, None, True)", "(5, 2, 5, True)", "(5, 2, 5, True)", "(7, 2, 5, False)",
         "(9, 0, 9, True)"]
    )
    assert near.near_duplicates(frame.limit(0)).count() == 0
    assert near.keep_one(frame.limit(0)).count() == 0


def test_shingle_sets_have_the_right_size():
    for _, text in variants(3):
        assert len(near.shingle_hashes(text or "")) == len(shingles(text))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share, size in ((0.5, 200), (0.75, 200), (0.9, 200), (0.75, 20), (0.75, 8)):
        agree = []
        for _ in range(200):
            both = rng.integers(0, 2**64, int(size * share), np.uint64)
            rest = rng.integers(0, 2**64, size - len(both), np.uint64)
            half = len(rest) // 2
            one, other = np.r_[both, rest[:half]], np.r_[both, rest[half:]]
            agree.append((near.signature(one) == near.signature(other)).mean())
        assert abs(np.mean(agree) - share) < 0.03
        assert np.std(agree) < 1.3 * np.sqrt(share * (1 - share) / 64)


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(4000, 4100)]
    edges += [(None, 1), (2, None), (8, 8)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    expected = sorted((n, root(n)) for n in list(parent))
    assert plain_rows(c.components(frame)) == plain_rows(c.components(frame, split_rows=5)) == expected
    assert c.components(frame.limit(0)).count() == 0
