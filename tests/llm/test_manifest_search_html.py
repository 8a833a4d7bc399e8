"""Merkle manifest, lexical search and page text against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from starflow.llm import html_text, lexical_search, merkle
from starflow.llm.queries import QUERIES

# ---- Merkle manifest -------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, add: int = 0) -> str:
    written = ""
    for name in FIELDS:
        value = row[name]
        if value is not None and name == "n_chars":
            value += add
        written += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(written)


def plain_levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def plain_manifest(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r))
    trees = [plain_levels([plain_leaf(r) for r in sorted(groups[n], key=order)]) for n in names]
    forest = plain_levels([t[-1][0] for t in trees])
    found = []
    for g, name in enumerate(names):
        for i, row in enumerate(sorted(groups[name], key=order)):
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node, proof = plain_leaf(row, int(tampered)), ""
            for levels, place in ((trees[g], i), (forest, g)):
                for level in levels[:-1]:
                    first = place // 2 * 2
                    run = level[first : first + 2]
                    proof += "".join(x for j, x in enumerate(run, first) if j != place)
                    node = h("".join(node if j == place else x for j, x in enumerate(run, first)))
                    place //= 2
            root = forest[-1][0]
            found.append((row["doc_id"], plain_leaf(row), trees[g][-1][0], root, h(proof), node, node == root))
    return sorted(found, key=repr)


def run_manifest(spark, docs, tmp_path):
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in QUERIES["op12_merkle"](spark, str(tmp_path)).collect()), key=repr)


def test_manifest_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = sorted((tuple(r) for r in QUERIES["op12_merkle"](spark, folder).collect()), key=repr)
    assert found == plain_manifest(rows)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_manifest_of_odd_rows(spark, tmp_path):
    rows = [(i, "é" * (i % 5), ["a", "b", None, "ä", ""][i % 7 % 5], None if i % 3 else "s", i) for i in range(700)]
    rows += [(None, None, None, None, None)] * 2 + [(5, "same", "a", "s", 1)] * 3
    rows += [(9001, "x" * 200_000, "lone", "", None), (7, "5:a", "a", "1:s", -4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert run_manifest(spark, docs, tmp_path) == plain_manifest(docs.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256, 257, 513])
def test_manifest_around_the_block_size(spark, tmp_path, n):
    rows = [(i, "t", "en", "s", 1) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert run_manifest(spark, docs, tmp_path) == plain_manifest(docs.collect())


def test_manifest_with_clashing_names_and_own_fields(spark):
    rows = [(i, f"k{i % 2}", i, i, i, i) for i in range(5)]
    docs = spark.createDataFrame(rows, "id int, kind string, tree int, leaf int, rank int, path int")
    found = merkle.manifest(docs, ["id", "leaf"], "kind", "id", {"tree": F.col("tree")}).collect()
    assert {(r["id"], r["kind"], r["tree"]) for r in found} == {(r[0], r[1], r[2]) for r in rows}
    assert all(r["leaf"] == h(f"1:{r['id']}1:{r['id']}") for r in found)
    assert len({r["root"] for r in found}) == 1 and len({r["subroot"] for r in found}) == 2


# ---- lexical search --------------------------------------------------------------------------


def plain_terms(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, k: int = 50) -> list[tuple]:
    terms = [(doc, plain_terms(text)) for doc, text in docs]
    terms = [(doc, found) for doc, found in terms if found]
    n_docs, n_words = len(terms), sum(len(found) for _, found in terms)
    df: dict[str, int] = {}
    for _, found in terms:
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    rows = []
    for item, text in items:
        scored = []
        for doc, found in terms:
            m = 50 + (50 * len(found) * n_docs) // n_words
            score = 0
            for t in set(plain_terms(text)):
                if tf := found.count(t):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        rows += [(item, i, doc, -s) for i, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


ODD = [
    (1, "The cat; the CAT's café"), (2, "the the the"), (3, None), (4, ""), (5, " ... "), (6, "ÉCOLE école"),
    (7, "cat " * 30_000), (8, "x" * 50_000 + " cat"), (9, "cat dog"), (9, "cat dog"), (None, "cat dog bird"),
    (10, "dog cat"), (11, "  ½ cat\x7fdog_1"),
]


def searched(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("rank", F.lit("x"))
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit(1))
    found = lexical_search.rank_documents(d, q.withColumn("doc_id", F.lit(0)), **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


ITEMS = [(1, "cat dog"), (2, "The École ÉCOLE"), (3, None), (4, "nothing here"), (None, "dog"), (5, "cat"), (5, "dog")]


@pytest.mark.parametrize("more", [{}, {"k": 2}, {"query_bytes": 8}])
def test_search_of_odd_texts(spark, more):
    assert searched(spark, ODD, ITEMS, **more) == plain_search(ODD, ITEMS, more.get("k", 50))


def test_search_of_nothing(spark):
    assert searched(spark, [], ITEMS) == [] and searched(spark, ODD, []) == []
    assert searched(spark, [(1, None), (2, "?")], ITEMS) == []


def test_search_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words[: 5 + i % 55], 1 + i % 40))) for i in range(900)]
    items = [(i, " ".join(rng.choice(words, 1 + i))) for i in range(12)]
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 50)
    monkeypatch.setattr(lexical_search, "FIRST", 4)
    assert searched(spark, docs, items, k=7) == plain_search(docs, items, 7)


def test_lists_are_not_read_to_their_end():
    n = 4000
    row = {
        "ids": np.arange(n).tobytes(), "named": np.ones(n, bool).tobytes(),
        "lengths": np.full(n, 10).tobytes(), "docs": np.r_[np.arange(n), np.arange(n)].astype(np.int32).tobytes(),
        "terms": np.repeat(np.arange(2, dtype=np.int32), n).tobytes(),
        "counts": np.tile(np.r_[np.full(5, 9), np.ones(n - 5, int)], 2).astype(np.int64).tobytes(),
    }
    lists = lexical_search.Lists(row, np.array([7, 9]), n, 10 * n)
    read = []
    lists.docs = type("Watched", (), {"__getitem__": lambda _, s, a=lists.docs: read.append(s) or a[s]})()
    assert [i for _, i in lists.best(np.array([0, 1]), 3, 0)] == [0, 1, 2]
    assert sum(s.stop - s.start for s in read) == 2 * lexical_search.FIRST


def test_long_texts_in_pieces(monkeypatch):
    text = "ab Cé-1 x2 " * 50 + "é" * 40
    whole = lexical_search.term_counts(text.encode())
    monkeypatch.setattr(lexical_search, "PIECE", 7)
    assert lexical_search.term_counts(text.encode()) == whole


# ---- page text -------------------------------------------------------------------------------


def test_page_query(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op13_html_text"](spark, folder).collect()
    assert len(found) == len(pages)
    for row in found:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[row["page_id"]])[1]
        parts = (re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?(?:p|h1)>", article))
        lines = (" ".join(unescape(p).split()) for p in parts)
        assert row["text"] == "\n".join(x for x in lines if x)
        assert row["n_chars"] == len(row["text"])


PAGES = [
    (None, ""), ("", ""), ("just text", "just text"), ("a &lt;b&gt; &amp;amp; &#65;&eacute; &am", "a <b> &amp; Aé &am"),
    ("<p>one<p>two <b>bold<p>three</b> end", "one\ntwo bold\nthree end"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"),
    ("x<br>y<br/>z<hr>w", "x y z\nw"),
    ("<ul><li>1<li>2<ul><li>3</ul></ul>", "1\n2\n3"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ("<script>var a='<p>no</p>';</script>yes<style>p{}</style><!-- <p>no --><noscript>no</noscript>", "yes"),
    ("<p>cut <a href='x", "cut"), ("<p>a < b > c &lt d", "a < b > c < d"), ("<p>a<!-- open <p>no", "a"),
    ("<script>never closed <p>no", ""), ("<p title='a > b'>q</p><p title=it's>r</p>", "q\nr"),
    ("<head><title>no</title><body><main><p>in</main><p>out", "in"),
    ("<nav>no</nav><article><header><h1>T</h1><p>By</p></header><p>x</p><aside>no</aside>"
     "<form>no</form><section class='comments'><article>no</article></section></article><p>no</p>", "T\nx"),
    ("<div class=layout-sidebar><article><p>x</p></article><div id=sidebar>no</div></div>", "x"),
    ("<form id=aspnet><article><p>x</p></article></form><footer>no", "x"),
    ("<article><p>x <span class='ad'>no</span>y <button>no</button>z</p><div class=cookieNotice>no</div></article>", "x y z"),
    ("<div class='has-sidebar'><p>x</p><div role=navigation>no</div></div>", "x"),
    ("<p>" + "long " * 100_000, ("long " * 100_000).strip()), ("<div>" * 30_000 + "deep", "deep"),
    ("<a" * 50_000, ""), ("<p>x<table>" + "<div>" * 20_000 + "y", "x\ny"),
    ("<button>" * 20_000 + "</a>" * 20_000, ""), ("<p>a<button>b<div>c</button>d</div>e", "a\nde"),
    ("a<span class=ad>b<div><span>c</span>d</div>e</span>f", "a\nf"), ("<svg/>a<svg><g/>b</svg>c", "ac"), ("<p> a \n b\t</p><p> </p>", "a b"), ("<P>Up</P><DIV>Case</DIV>", "Up\nCase"),
    ("<div>no</div><div class='post-content'><p>x</p><div class=share>no</div></div><p>no", "x"),
    ("<p>no</p><div role=main>x</div><div id='content'>y</div>", "x\ny"),
    ("<div class='content'><p>no</p><article><p>x</p></article></div>", "x"),
    ("</p></b></div>stray", "stray"), ("<article class=ad>no</article><p>x", "x"),
]


def extracted(spark, rows):
    schema = "page_id bigint, url string, html string, text string, host int"
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], schema)
    found = html_text.extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "removed"]
    return found.collect()


def test_pages_of_odd_markup(spark):
    rows = [(i, None if i % 2 else f"http://h{i}.example/", html) for i, (html, _) in enumerate(PAGES)]
    found = {r["page_id"]: r["text"] for r in extracted(spark, rows + [(None, "http://x", "y")] * 2)}
    assert found.pop(None) == "y"
    assert [found[i] for i in range(len(PAGES))] == [text for _, text in PAGES]


def test_no_pages(spark):
    assert extracted(spark, []) == []


def site(host, n, page, same=False):
    return [(i, f"https://{host}/p{i}", page(0 if same else i)) for i in range(n)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_what_a_site_repeats_goes(spark, monkeypatch, broadcast):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", 1 << 20 if broadcast else -1)
    top = "<div><ul><li>Home<li>About us</ul><div>Call us</div></div>"
    plain = lambda i: f"{top}<div><p>Text {i}</p><p>{'shared' if i == 1 else i}</p></div>"
    rows = site("A.example:80", 4, plain) + site("b.example", 2, plain)
    found = extracted(spark, rows)
    for r in found:
        i = r["page_id"]
        body = f"Text {i}\n{'shared' if i == 1 else i}"
        many = "A.example" in r["url"]
        assert (r["text"], r["removed"]) == ((body, 3) if many else (f"Home\nAbout us\nCall us\n{body}", 0))


def test_what_articles_share_stays(spark):
    page = lambda i: f"<article><p>Text {i}</p>{'<p>Licence</p>' if i % 2 else ''}<p>Ask us!</p></article>"
    found = extracted(spark, site("a.example", 12, page))
    assert {r["text"] for r in found} == {f"Text {i}" + "\nLicence" * (i % 2) for i in range(12)}
    # Copies of one page are one page, so nothing of it is a template.
    found = extracted(spark, site("a.example", 12, page, same=True))
    assert {r["text"] for r in found} == {"Text 0\nAsk us!"}
