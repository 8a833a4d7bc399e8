"""Packing, personal data and decontamination against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
from brute import (
    base_sha256,
    base_spans,
    decontaminated,
    ids_crc32,
    token_ids,
)
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starflow.llm import decontamination as d
from starflow.llm import packing, pii
from starflow.llm.queries import QUERIES, TOKENIZER

ODD = [
    None, "", " \n\t ", "a", "It's the CAFÉ's £5.50, straße ½ ²x", "İstanbul ΣΑΣ ﬁ Ǆ", "é ñ",
    "<|endoftext|> <|startoftext|>", "中文 字符 test", "\x01\x02  x\u0085y", "\U0001f600 ok", "1234567",
    "don't we'll I'd 'sun 'so ''s", "a" * 5000, "ab " * 4000,
]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "null id", "x", "y")] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, start string, ids string")


# ---- packing ---------------------------------------------------------------------------------


def check_pieces(rows, docs, tokenizer):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for doc, text in docs:
        ids, at = token_ids(tokenizer, text), 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["offset"]) == (at, len(ids), 0)
            assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048
            assert r["ids_crc32"] == ids_crc32(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_packing_query_holds_every_id_once(spark, folder, documents):
    rows = QUERIES["op5_packing"](spark, folder).collect()
    check_pieces(rows, documents, Tokenizer.from_file(TOKENIZER))


def test_packing_of_odd_texts(spark, odd_docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = packing.decompose(odd_docs, TOKENIZER).collect()
    for i, text in enumerate(ODD):
        mine = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in mine), "<u4").tolist()
        assert ids == token_ids(tokenizer, text)
    twice = [r for r in pieces if r["doc_id"] is None]
    assert len(twice) == 2 * len({r["start"] for r in twice})
    assert packing.decompose(odd_docs.limit(0), TOKENIZER).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), max_size=30)))
def test_word_ids_equal_the_tokenizer(texts):
    encoder = packing.word_ids(TOKENIZER)
    for text in texts:
        assert np.frombuffer(encoder.of(text), "<u4").tolist() == token_ids(encoder.tokenizer, text)[:-1]


def test_other_tokenizers_are_not_taken_by_words():
    import public_tokenizers

    assert packing.WordIds(TOKENIZER).by_word
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, plain = packing.WordIds(path), Tokenizer.from_file(path)
    assert not other.by_word
    for text in filter(None, ODD):
        assert other.of(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_sequences_are_stored_by_their_length(spark, odd_docs, tmp_path):
    pieces = packing.decompose(odd_docs, TOKENIZER)
    packing.write_buckets(pieces, f"{tmp_path}/out")
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, stored.select("sequence_id", "length").collect())) == sorted(
        map(str, pieces.select("sequence_id", "length").collect())
    )
    folders = {int(f.name.split("=")[1]) for f in (tmp_path / "out").glob("bucket=*")}
    assert folders == {r["length"] for r in pieces.collect()}
    packing.write_buckets(pieces.limit(0), f"{tmp_path}/none")


def test_pieces_sum_up():
    for n in (1, 2, 3, 2047, 2048, 2049, 10000):
        assert sum(packing.pieces_of(n, 2048)) == n
    with pytest.raises(ValueError):
        packing.decompose(None, TOKENIZER, max_length=1000)


# ---- personal data ---------------------------------------------------------------------------

PII = [
    "a.b@c.d.e, x@y@z.org @a.b q@-.-.", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 01.002.003.0004 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111-5 4111111111111111", "+1 (555) 010-9999 +49 30 1234567) +12",
    "+1234567890123456 ++1 2 3 4 5 6 7 8", "a@b.c.d@e.f", "9" * 5000 + ".1.2.3", "+1.2.3.4 5 6 7 8 9@x.y",
    "see https://u:p@ex.org/a?b=1). token = \"0b96a8c8d79c4a5085c9\" IBAN: DE89 3704 0044 0532 0130 00",
]


@pytest.mark.parametrize("text", PII)
def test_base_spans(text):
    assert [s for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.text("ab@.+-( )012345é %", max_size=60))
def test_base_spans_of_any_text(text):
    assert [s for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_added_spans():
    text = PII[-1]
    added = [(k, text[s:e]) for k, s, e in pii.spans_of(text) if k not in pii.BASE_KINDS]
    assert added == [
        ("url", "https://u:p@ex.org/a?b=1"),
        ("account", "0b96a8c8d79c4a5085c9"),
        ("account", "DE89 3704 0044 0532 0130 00"),
    ]


def test_accounts_of_any_length(spark):
    key = "0123456789ab" * 10
    text = f'token = {key}, api_key="{key[:65]}" IBAN IBAN IBAN: DE89 3704 0044'
    added = [(k, text[s:e]) for k, s, e in pii.spans_of(text) if k == "account"]
    assert added == [("account", key), ("account", key[:65]), ("account", "DE89 3704 0044")]
    docs = spark.createDataFrame([(1, f"token = {key} end")], "doc_id long, text string")
    assert pii.redact(docs).first()["text"] == "token = <account> end"
    assert pii.spans_of("IBAN " * 100_000 + "x") == []


def test_pii_query(spark, folder, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op7_pii"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc, text in documents:
        spans = base_spans(text)
        assert rows[doc]["base_sha256"] == base_sha256(text)
        for kind in pii.BASE_KINDS:
            assert rows[doc][f"n_{kind}"] == sum(k == kind for k, _, _ in spans)


def test_pii_of_odd_texts(spark, odd_docs):
    assert pii.find_pii(odd_docs).count() == len(ODD) + 2
    assert pii.find_pii(odd_docs.limit(0)).count() == 0
    docs = spark.createDataFrame([(1, "é a@b.cd +1 555 010 9999"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in pii.redact(docs).orderBy("doc_id").collect()] == [
        (1, "é <email> <phone>"), (2, None)
    ]


# ---- decontamination -------------------------------------------------------------------------

ITEM = " ".join(f"w{i}" for i in range(20))
ITEMS = [(1, ITEM), (2, "short Item"), (None, "nullid here"), (3, None), (4, ""), (5, ITEM), (6, "ÉÀ é")]
TEXTS = [
    None, "", ITEM, "x " + ITEM.upper() + " y", " ".join(ITEM.split()[:12]), " ".join(ITEM.split()[3:16]),
    "a short, item and more " * 3, "nullid; here", "ÉÀ é", ITEM + " " + ITEM, "pad " * 500 + "short item",
    "w5 " * 40, ITEM.replace(" ", "--"),
]


def decontaminated_rows(found):
    return found.select(
        "doc_id", "n_words", d.hit_words(), "item_ids", d.contaminated()
    ).collect()


@pytest.mark.parametrize("at_once", [1_000_000, 5])
def test_decontamination_of_odd_texts(spark, at_once):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    docs = docs.selectExpr("doc_id", "text", "'a' AS ranges", "1 AS n_words_", "2 AS gram")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r[0]: r for r in decontaminated_rows(d.scan(docs, bench, ["doc_id", "text"], max_windows=at_once))}
    for doc, words, hit, items, _, bad in decontaminated(enumerate(TEXTS), ITEMS):
        assert (got[doc][1], got[doc][2], len(got[doc][3]), got[doc][4]) == (words, hit, items, bad)
    kept = d.drop_contaminated(docs, bench).collect()
    assert {r["doc_id"] for r in kept} == {i for i, r in got.items() if not r[4]}
    assert {r["doc_id"]: r["text"] for r in d.remove_spans(docs, bench).collect()}[3] == "x  y"
    assert d.scan(docs.limit(0), bench, ["doc_id", "text"]).count() == 0
    assert not any(r[4] for r in decontaminated_rows(d.scan(docs, bench.limit(0), ["doc_id", "text"])))


def test_decontamination_query(spark, folder, documents):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    rows = QUERIES["op10_decontamination"](spark, folder).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    expected = decontaminated(documents, [(r["item_id"], r["text"]) for r in bench])
    assert sorted(map(tuple, rows.collect())) == sorted(expected)
    assert any(r[2] for r in expected)
