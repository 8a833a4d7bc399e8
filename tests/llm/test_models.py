"""Language, toxicity, quality, URL lists and top-k search."""

from __future__ import annotations

import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from brute import top_k as plain_top_k
from compare import connect, differences
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from starflow.llm import language_id, quality, top_k, toxicity, url_filters
from starflow.llm.queries import ORACLE, QUERIES
from starflow.session import shared_root

BIG = "/root/testdata/sf0.01"


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- language --------------------------------------------------------------------------------


def test_language_query_predicts_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, BIG)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    got = found.join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.99


def test_language_of_odd_texts(spark):
    taught = spark.createDataFrame(
        [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("x", None)],
        "text string, lang string",
    )
    asked = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 ² ½ !"), (4, "the the"), (5, "chiens chats"), (None, "et le"),
         (6, "the " * 150_000), (7, "the²le")],
        "doc_id int, text string",
    )
    learned = language_id.fit(taught.withColumn("doc_id", F.lit(1)))
    got = {r[0]: r[1:] for r in rows(language_id.identify(asked, learned))}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (4, 5, None, 6)] == ["en", "fr", "fr", "en"]
    nothing = language_id.fit(taught.limit(0))
    assert {r[1:] for r in rows(language_id.identify(asked, nothing))} == {("und", 0.0)}
    assert language_id.identify(asked.limit(0), learned).count() == 0


def test_language_beside_columns_of_any_name(spark):
    taught = spark.createDataFrame(
        [("the cat", "en", "x", 1), ("le chat", "fr", "y", 2)], "text string, lang string, id string, score int"
    )
    asked = spark.createDataFrame(
        [(1, "le le", "zz", 0.5, "a"), (1, "le le", "zz", 0.5, "a"), (2, "the", "zz", None, "b")],
        "doc_id int, text string, lang_pred string, score double, id string",
    )
    found = language_id.identify(asked, language_id.fit(taught.withColumn("doc_id", F.lit(1))))
    assert found.columns == ["doc_id", "lang_pred", "score"]
    assert sorted(r[:2] for r in rows(found)) == [(1, "fr"), (1, "fr"), (2, "en")]


def test_known_words_come_first_and_then_the_longest_grams():
    logs = np.log([[0.9, 0.1], [0.1, 0.9]])
    parts = (["a", "b"], ["word"], logs[:1], ["^wo", "d"], logs[::-1])
    model = language_id.Model(parts)
    assert model.predict("word")[0] == "a"
    assert np.allclose(model.backoff(["wox", ""]), [logs[1] / 3, [0, 0]])
    assert model.predict("wox")[0] == "b"


def test_a_worker_that_forgets_words_gives_the_same(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abc") for _ in range(6)) for _ in range(3000))
    grams = ["a", "b", "c", "ab", "^c"]
    logs = np.log([[0.6, 0.4], [0.5, 0.5], [0.3, 0.7], [0.9, 0.1], [0.2, 0.8]])
    parts = (["x", "y"], ["abcabc"], np.log([[0.5, 0.5]]), grams, logs)
    whole = language_id.Model(parts).predict(text)
    monkeypatch.setattr(language_id, "REMEMBERED", 120)
    monkeypatch.setattr(language_id, "PART", 100)
    assert language_id.Model(parts).predict(text) == pytest.approx(whole)


# ---- toxicity --------------------------------------------------------------------------------


def test_toxicity_query_separates_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op3_toxicity"](spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = found.join(labels, "doc_id", "left").collect()
    assert len(got) == 10_000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [r for r in got if r["held_out"] and r["toxic"] is not None]
    chosen = [r["toxic"] for r in held if r["predicted"]]
    assert len(chosen) > 50 and np.mean(chosen) > 0.95
    # About one label in twenty is toxic without any sign in the text.
    assert sum(chosen) / sum(r["toxic"] for r in held) > 0.55


def toxic_corpus(n=400):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(3)) for _ in range(40)]
        if bad := i % 5 == 0:
            words[7] = words[20] = words[33] = "vile"
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_small_and_odd_tables(spark):
    docs, labels = toxic_corpus()
    docs += [(1000, None), (1001, ""), (None, "a vile b"), (1002, "vile vile"), (1002, "vile vile"), (1003, "a b c d e")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("toxic", F.lit("x"))
    known = spark.createDataFrame([*labels, (None, 1), (1003, None)], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(frame, known, F.col("doc_id") % 3 != 1).collect()
    assert len(got) == len(docs)
    score = {r["doc_id"]: r["score"] for r in got}
    bad = {i for i, y in labels if y}
    assert min(score[i] for i in bad) > max(score[i] for i, y in labels if not y)
    assert score[1002] > 0.7 > score[1003] and 0 < score[1000] == score[1001] < 0.4
    none = toxicity.score_toxicity(frame, known.limit(0), F.lit(True))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert toxicity.score_toxicity(frame.limit(0), known, F.lit(True)).count() == 0


def test_kept_probabilities_sum_to_one():
    words = {"w": np.array([5, 9]), "t0": np.array([10, 1]), "t1": np.array([2, 30]), "t": np.array([11, 30])}
    pairs = {"h": np.array([5]), "w": np.array([9]), "n0": np.array([1]), "n1": np.array([20]),
             "h0": np.array([40]), "h1": np.array([25]), "t0": np.array([1]), "t1": np.array([30]),
             "t": np.array([30])}
    model = toxicity._differences(words, pairs, (100.0, 80.0, 150.0))
    left = [1 - (9.25 + 0.25) / 100, 1 - (1.25 + 29.25) / 80]
    assert model["other"] == pytest.approx(math.log(left[1] / left[0]))
    back = [0.25 / 100 + left[0] * 0.2, 29.25 / 80 + left[1] * 0.2]
    seen = [0.25 / 40, 19.25 / 25]
    whole = [seen[c] + (1 - seen[c]) * back[c] for c in (0, 1)]
    assert model["pairs"][1][0] == pytest.approx(math.log(whole[1] / whole[0]))


def test_every_seen_expression_is_in_the_model(spark):
    docs, labels = toxic_corpus()
    docs = [(t + (" rare slur" if i in (5, 10) else ""), y) for (i, t), (_, y) in zip(docs, labels)]
    frame = spark.createDataFrame(docs, "text string, label bigint")
    table, other = toxicity.fit(frame.repartition(3))
    n = {}
    for text, label in docs:
        for at in set(zip(*(x.tolist() for x in toxicity.bigrams(text)))):
            n.setdefault(at, [0, 0])[label] += 1
    heads, words = {h for h, _ in n}, {w for _, w in n}
    value = {r["key"] % 2**64: r["value"] for r in table.collect()}
    assert len(value) == len(n) + len(heads) + len(words)
    # The same by the formulas for counts in memory.
    total = [sum(c[k] for c in n.values()) for k in (0, 1)]

    def weight(a, b, sums):
        parts = [(x, (a + b) * y / sum(sums)) for x, y in zip((a, b), sums)]
        ratio = 2 * sum(x * math.log(x / e) for x, e in parts if x)
        return ratio * ratio / (ratio * ratio + toxicity.STRENGTH**2), ratio

    by_word = {w: [c for (_, v), c in n.items() if v == w] for w in words}
    t = {w: [sum(c[k] > 0 for c in cs) for k in (0, 1)] for w, cs in by_word.items()}
    types = [sum(x[k] for x in t.values()) for k in (0, 1)]
    kept = {}
    for w, cs in by_word.items():
        tokens = [sum(c[k] for c in cs) for k in (0, 1)]
        kept[w] = min(weight(*tokens, total), weight(*t[w], types), key=lambda x: x[1])[0]
    column = lambda values: np.array(list(values))
    hashes = lambda values: np.array(list(values), np.uint64)
    plain_words = {"w": hashes(kept), "kept": column(kept.values()), "t": column(len(by_word[w]) for w in kept),
                   **{f"t{k}": column(t[w][k] for w in kept) for k in (0, 1)}}
    by_head = {h: [c for (g, _), c in n.items() if g == h] for h in heads}
    pooled = {h: sum(map(sum, cs)) for h, cs in by_head.items()}
    pairs = {"h": hashes(h for h, _ in n), "w": hashes(w for _, w in n),
             "kept": column(weight(*c, total)[0] for c in n.values()),
             "t": column(len(by_word[w]) for _, w in n),
             "s": column((sum(c) - 0.75) / pooled[h] for (h, _), c in n.items()),
             "rs": column(0.75 * len(by_head[h]) / pooled[h] for h, _ in n),
             **{f"n{k}": column(c[k] for c in n.values()) for k in (0, 1)},
             **{f"h{k}": column(sum(c[k] for c in by_head[h]) for h, _ in n) for k in (0, 1)}}
    plain = toxicity._differences(plain_words, pairs, (*types, len(n)))
    assert other == pytest.approx(plain["other"])
    of_head, of_word = dict(zip(*map(np.ndarray.tolist, plain["heads"]))), dict(zip(*map(np.ndarray.tolist, plain["words"])))
    whole = dict(zip(*map(np.ndarray.tolist, plain["pairs"])))
    one = lambda h, w: int(toxicity.pair(np.array([h], np.uint64), np.array([w], np.uint64))[0])
    for h, w in n:
        at = value[one(h, w)] + value[one(h, toxicity._HEAD)] + value[one(toxicity._ALONE, w)] + other
        assert at == pytest.approx(whole[one(h, w)], abs=1e-9)
        assert value[one(h, toxicity._HEAD)] == pytest.approx(of_head[h], abs=1e-9)
        assert value[one(toxicity._ALONE, w)] + other == pytest.approx(of_word[w], abs=1e-9)
    # Two occurrences are evidence.
    texts = spark.createDataFrame([(1, "rare slur"), (2, "rare other"), (3, None)], "id int, text string")
    x = {r["id"]: r["x"] for r in toxicity.differences(texts, (table, other)).collect()}
    assert x[1] > x[2] and x[3] is None


# ---- quality ---------------------------------------------------------------------------------


def test_quality_query(spark):
    found = QUERIES["op6_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    got = found.join(labels, "doc_id", "left").collect()
    assert len(got) == 10_000
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.995 and np.mean(bad) < 0.03


def test_posteriors_shrink_sparse_sites(spark):
    made = [("h1", "p1", 1.0)] * 300 + [("h1", "p2", 0.0)] * 5 + [("h2", "p3", 0.0)] * 200
    made += [("h2", "p4", 1.0), (None, None, 0.5), ("h3", "p5", 1.0)]
    frame = spark.createDataFrame(made, "host string, path string, y double")
    sites, prior = quality.posteriors(frame, "host", "path")
    site = {r["path"]: r["site"] for r in sites.collect()}
    assert prior == pytest.approx((sum(y for *_, y in made) + 0.5) / (len(made) + 1))
    assert site["p1"] > 0.95 > site["p2"] > 0 and site["p3"] < 0.05
    assert site["p3"] < site["p4"] < site["p5"] < 1
    nothing, prior = quality.posteriors(frame.limit(0), "host", "path")
    assert nothing.count() == 0 and prior == 0.5


def test_scores_leave_the_document_out_of_its_site(spark):
    """The whole of the combination, against a plain version from the evidence on."""
    rnd = random.Random(6)
    docs = [
        (i, " ".join(rnd.choice(["good", "words", "here", "%%%", "###"][: 3 + i % 3]) for _ in range(20)),
         rnd.choice(["h1", "h1", "h2", None]), rnd.choice("pqr"))
        for i in range(150)
    ] + [(900, "alone", "h9", "p")]
    labels = {i: int(i % 3 == 0) for i in range(0, 150, 2)}
    frame = spark.createDataFrame(docs, "doc_id int, text string, h string, p string")
    taught = spark.createDataFrame(list(labels.items()), "doc_id int, quality int")
    where = F.col("h"), F.concat_ws("/", "h", "p")
    got = {r["doc_id"]: r for r in quality.score_quality(frame, taught, *where).collect()}
    y = {i: labels.get(i, got[i]["evidence"]) for i, *_ in docs}
    path = {i: "/".join(x for x in (h, p) if x) for i, _, h, p in docs}
    host = {i: h for i, _, h, _ in docs}
    prior = (sum(y.values()) + 0.5) / (len(y) + 1)

    def sums(of, without=None):
        found = {}
        for i in y:
            if i != without:
                found.setdefault(of(i), []).append(y[i])
        return found

    def strength(groups, parent):
        n = [len(g) for g in groups.values()]
        spread = sum(len(g) * (sum(g) / len(g) - parent(k)) ** 2 for k, g in groups.items())
        chance = prior * (1 - prior)
        rest = sum(n) - sum(x * x for x in n) / sum(n)
        between = (spread - (len(n) - 1) * chance) / rest if rest > 0 else 0
        return quality.STRONGEST if between <= chance / quality.STRONGEST else max(1.0, chance / between - 1)

    hosts = sums(host.get)
    above = strength(hosts, lambda _: prior)
    rate = {k: (sum(g) + above * prior) / (len(g) + above) for k, g in hosts.items()}
    keys = {(host[i], path[i]) for i in y}
    below = strength(sums(lambda i: (host[i], path[i])), lambda k: rate[k[0]])
    assert len(keys) > 8
    for i, row in got.items():
        others = sums(lambda j: (host[j], path[j]), i).get((host[i], path[i]), [])
        at_host = sums(host.get, i).get(host[i], [])
        parent = (sum(at_host) + above * prior) / (len(at_host) + above)
        site = (sum(others) + below * parent) / (len(others) + below)
        assert row["site"] == pytest.approx(site, abs=1e-9)
        logit = lambda v: math.log(v / (1 - v))
        odds = logit(min(max(row["evidence"], 1e-6), 1 - 1e-6)) + logit(site) - logit(prior)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-9)
    assert got[900]["site"] == pytest.approx(prior)


def test_quality_of_odd_tables(spark):
    docs = [(i, "some words of text " + "x" * (i % 7), "s", "p") for i in range(40)]
    docs += [(50 + i, "### $$$ %%% " * (5 if i else 100_000), None, "p") for i in range(40)] + [(None, None, None, None), (99, "", "t", None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, label string, x string")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(30)] + [(50 + i, 0) for i in range(30)] + [(None, 1), (3, None)],
        "doc_id bigint, quality int",
    )
    where = F.col("label"), F.concat_ws("/", "label", "x")
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(frame, labels, *where).collect()}
    assert len(got) == 82 and all(0 <= s <= 1 for s in got.values())
    assert min(got[i] for i in range(40)) > 0.5 > max(got[50 + i] for i in range(40))
    kept = quality.keep_good(frame, labels, *where)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} >= {None, *range(40)}
    for some in (labels.limit(0), labels.filter("quality = 1")):
        assert quality.score_quality(frame, some, *where).count() == 82
    assert quality.score_quality(frame.limit(0), labels, *where).count() == 0


# ---- URL lists -------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, BIG), connect(BIG), ORACLE[name]) == []


def test_captures_are_judged_as_of_their_time(spark):
    month = url_filters.PERIOD
    entries = spark.createDataFrame(
        [("bad.org", "spam", 100), ("bad.org", "remove", 500), ("bad.org", "adult", 9 * month),
         ("x.bad.org", "remove", 200), ("bad.org/a/", "malware", 600), ("tie.org", "spam", 10),
         ("tie.org", "adult", 10), (None, "spam", 1), ("bad.org", None, 1), ("bad.org", "spam", None)],
        "pattern string, category string, listed_at bigint",
    )
    captures = spark.createDataFrame(
        [(1, "http://bad.org/", 99), (2, "http://bad.org/", 100), (3, "http://bad.org", 499),
         (4, "http://BAD.org:80/a/b?c", 500), (5, "http://u@bad.org/a/b", 600), (6, "http://y.bad.org/", 20 * month),
         (7, "http://x.bad.org/", 300), (8, None, 5), (9, "nothing", 5), (10, "http://bad.org/", None),
         (11, "http://tie.org/", 10), (11, "http://tie.org/", 10), (12, "http://bad.org/a", 700),
         (13, "http://bad.org/", 5 * month), (14, "http://org/", 5)],
        "page_id int, url string, fetched_at bigint",
    ).withColumn("category", F.lit("old"))
    found = url_filters.judge(captures, entries)
    assert found.columns == ["page_id", "url", "fetched_at", "host", "blocked", "pattern", "category", "listed_at"]
    got = sorted((r["page_id"], r["blocked"], r["category"]) for r in found.collect() if r["page_id"] != 11)
    assert [(i, b) for i, b, _ in sorted(got, key=lambda r: r[0])] == [
        (1, False), (2, True), (3, True), (4, False), (5, True), (6, True), (7, False), (8, False),
        (9, False), (10, False), (12, False), (13, False), (14, False),
    ]
    assert [r["category"] for r in found.filter("page_id = 11").collect()] == ["spam", "spam"]
    assert url_filters.judge(captures.limit(0), entries).count() == 0
    assert not any(r["blocked"] for r in url_filters.judge(captures, entries.limit(0)).collect())


def test_a_far_time_and_a_deep_path_cost_nothing(spark):
    month, far = url_filters.PERIOD, 253_402_300_799
    entries = spark.createDataFrame(
        [(f"s{i}.org", "spam", i * month) for i in range(50)] + [("s1.org/a/", "remove", 5)],
        "pattern string, category string, listed_at bigint",
    )
    deep = "http://s1.org/" + "a/" * 20_000
    captures = spark.createDataFrame(
        [(1, "http://s1.org/", far), (2, deep, far), (3, "http://s3.org/", 2 * month), (4, deep, 4)],
        "page_id int, url string, fetched_at bigint",
    )
    asked = captures.select(
        F.floor(F.col("fetched_at") / month).alias("period"),
        F.explode(url_filters.patterns_of(F.col("url"), url_filters._deepest(entries))).alias("pattern"),
    )
    assert asked.count() < 20
    cut = url_filters._by_period(url_filters.intervals(entries), asked.select("pattern", "period").distinct())
    assert cut.count() <= 51 + 4  # each entry once, and where it is asked for later
    found = sorted((r["page_id"], r["blocked"], r["pattern"]) for r in url_filters.judge(captures, entries).collect())
    assert found == [(1, True, "s1.org"), (2, False, "s1.org/a/"), (3, False, None), (4, False, None)]


def test_judged_as_by_looking_at_every_entry(spark):
    rnd = np.random.default_rng(8)
    month = url_filters.PERIOD
    listed = [("a.org", "b.org", "x.a.org", "a.org/p/")[i % 4] for i in range(60)]
    entries = [(p, ["spam", "remove", "adult"][i % 3], int(rnd.integers(0, 12 * month))) for i, p in enumerate(listed)]
    urls = ["http://a.org/", "http://x.a.org/p/q", "http://a.org/p/q", "http://c.org/"]
    captures = [(i, urls[i % 4], int(rnd.integers(0, 40 * month))) for i in range(200)]
    frame = spark.createDataFrame(entries, "pattern string, category string, listed_at bigint")
    asked = spark.createDataFrame(captures, "page_id int, url string, fetched_at bigint")
    matches = {
        urls[0]: ["a.org"], urls[1]: ["x.a.org", "a.org"], urls[2]: ["a.org/p/", "a.org"], urls[3]: [],
    }
    for r in url_filters.judge(asked, frame).collect():
        active = [
            max((e for e in entries if e[0] == p and e[2] <= r["fetched_at"]), key=lambda e: e[2], default=None)
            for p in matches[r["url"]]
        ]
        best = max((e for e in active if e), key=lambda e: (len(e[0]), e[0]), default=None)
        assert (r["pattern"], r["category"], r["listed_at"]) == (best or (None, None, None))
        assert r["blocked"] == bool(best and best[1] != "remove")


# ---- top-k -----------------------------------------------------------------------------------


def test_top_k_query(spark):
    data = spark.read.parquet(f"{BIG}/embeddings.parquet").collect()
    got = rows(QUERIES["op8_top_k"](spark, BIG))
    assert sorted(got) == sorted(plain_top_k([(r["vec_id"], r["embedding"]) for r in data]))


@pytest.mark.parametrize("block", [4096, 50])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(top_k, "BLOCK", block)
    rng = np.random.default_rng(4)
    made = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(420)]
    made += [(1000 + i, made[0][1]) for i in range(40)] + [(2000 + i, [0.0] * 6) for i in range(0, 200, 50)]
    made += [(3000, None), (3100, []), (3200, [1.0] * 5 + [None]), (3300, [float("nan")] * 6),
             (3400, [float("inf")] * 6), (None, [1.0] * 6), (3500, [1.0, 2.0]), (3501, [1.0, 3.0]),
             (3600, [1e200] * 6), (3700, [3e9] * 6)]
    frame = spark.createDataFrame(made, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(0))
    plain = plain_top_k([v for v in made if v[0] not in (3600, 3700)])
    frame_ = frame.filter("vec_id is null or vec_id not in (3600, 3700)")
    assert sorted(rows(top_k.top_k(frame_, F.col("vec_id") % 100 == 0))) == sorted(plain)
    assert top_k.top_k(frame.filter("vec_id = 3600 or vec_id < 5"), F.col("vec_id") % 100 == 0).count() == 4
    assert top_k.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_end_the_reading_early():
    rng = np.random.default_rng(0)
    data = rng.normal(size=(4096, 8)).astype(np.float64)
    lists = top_k.Lists(np.arange(4096), np.floor(1024 * data).astype(np.int64))
    query = lists.data[7]
    left = lists._candidates(query, lists.ids == 7, 10, None)
    assert len(left) <= 1536
    best = np.argsort(-(lists.data @ query), kind="stable")
    assert {i for i in best[:11].tolist() if i != 7} <= set(left.tolist())


def test_looked_up_in_parts_gives_the_same(spark):
    docs, labels = toxic_corpus(200)
    docs += [(None, "a vile b"), (None, None), (300, ""), (300, "vile")]
    known = spark.createDataFrame(labels, "id bigint, label bigint")
    texts = spark.createDataFrame(docs, "id bigint, text string")
    model = toxicity.fit(texts.join(known, "id"))
    names = {t.name for t in spark.catalog.listTables()}
    whole = toxicity.differences(texts, model).collect()
    parts = toxicity.differences(texts, model, bound=0).collect()
    assert {t.name for t in spark.catalog.listTables()} == names
    key = lambda r: (r["id"] is None, r["id"] or 0, r["x"] is None, r["x"] or 0.0)
    assert len(whole) == len(docs)
    for a, b in zip(sorted(whole, key=key), sorted(parts, key=key), strict=True):
        assert a["id"] == b["id"] and (a["x"] is None) == (b["x"] is None)
        assert a["x"] is None or a["x"] == pytest.approx(b["x"], abs=1e-12)


def test_only_the_model_is_left_of_what_it_was_made_from(spark):
    docs, labels = toxic_corpus(60)
    root = Path(shared_root(spark).removeprefix("file:"))
    texts = spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs, labels)], "text string, label bigint")
    before = {p for p in root.glob("toxicity_*/run=*")}
    assert toxicity.fit(texts) is not None
    left = {p.parent.name for p in set(root.glob("toxicity_*/run=*")) - before}
    assert left == {"toxicity_model"}


def test_the_quality_sample_stays_on_the_executors(spark, monkeypatch):
    rows_ = [(i % 150, f"word{i % 7} " * (i % 30), "s", "p") for i in range(600)]
    docs = spark.createDataFrame(rows_, "doc_id bigint, text string, host string, path string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id bigint, quality int")
    taught = docs.select(F.col("doc_id").alias("id"), F.length("text").alias("x"))
    order = (F.xxhash64("id"), "id", "x")
    for most in (1, 50, 600, 1000):
        plain = taught.orderBy(*order).limit(most).collect()
        assert quality._first_rows(taught, most).collect() == plain
    seen, collect = [], DataFrame.collect

    def noted(frame):
        seen.append(frame.columns)
        return collect(frame)

    monkeypatch.setattr(type(docs), "collect", noted)
    quality.score_quality(docs, labels, F.col("host"), F.col("path"))
    assert seen and not any("x" in columns for columns in seen)
