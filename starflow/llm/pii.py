"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, URL schemes and words that
announce an identifier. A local parser for each kind expands around the anchor and validates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import in_batches, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://", "mailto:")
CUES = (
    "account", "acct", "iban", "ssn", "passport", "customer id", "user id", "member id",
    "api_key", "api key", "apikey", "access key", "secret", "token", "password",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_FOUR_PARTS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DIGIT_CHAIN = re.compile(r"[0-9]([\x20-]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGIT_RUN = re.compile(r"[0-9]+")
_URL_BODY = re.compile(r"[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]+")
_AFTER_CUE = re.compile(
    r"(?:[\x20_]?(?:no|nr|number|id|key)\b)?\.?[\x20]{0,3}[:=#]?[\x20]{0,3}[\"']?"
    r"(?P<value>[A-Za-z0-9](?:[A-Za-z0-9_-]|\x20(?=(?:[0-9]{1,4}|[0-9A-Z]{4})\b)){5})"
)
_VALUE_REST = re.compile(r"(?:[A-Za-z0-9_-]|\x20(?=(?:[0-9]{1,4}|[0-9A-Z]{4})\b))*+")


@lru_cache(maxsize=1)
def anchors():
    """The automaton, built once in each Python worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        for spelled in {scheme, scheme.upper(), scheme.capitalize()}:
            found.add_word(spelled, ("scheme", len(scheme)))
    for cue in CUES:
        for spelled in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(spelled, ("cue", len(cue)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def email_at(text: str, at: int, free: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``; it may not begin before ``free``."""
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def url_at(text: str, start: int, scheme_end: int) -> tuple[int, int] | None:
    """The URL from its scheme on, without closing punctuation; the host must have a dot."""
    body = _URL_BODY.match(text, scheme_end)
    if not body:
        return None
    whole = body.group().rstrip(".,;:!?)]'")
    host = re.split(r"[/?#]", whole.lstrip("/"), maxsplit=1)[0]
    return (start, scheme_end + len(whole)) if "." in host.strip(".") else None


def account_at(text: str, cue_start: int, cue_end: int, poor: int) -> tuple[int, int] | None:
    """What may be the identifier after a cue: 6 or more letters, digits, ``_`` and ``-``.

    Before ``poor`` a value ends where one that has too few digits does, and is not read again.
    """
    if cue_start and (text[cue_start - 1].isalnum()):
        return None
    found = _AFTER_CUE.match(text, cue_end)
    if not found or found.start("value") < poor:
        return None
    return found.start("value"), _VALUE_REST.match(text, found.end()).end()


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind and then start.

    Within one kind spans do not overlap, and each begins as far left as it can.
    """
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free = dict.fromkeys(KINDS, 0)
    poor = 0

    def take(kind: str, span: tuple[int, int] | None, good: bool = True) -> None:
        if span:
            free[kind] = span[1]
            if good:
                found[kind].append(span)

    for last, (what, width) in anchors().iter(text):
        at = last - width + 1
        if what == "digit":
            if at >= free["card"] and (chain := _DIGIT_CHAIN.match(text, at)):
                digits = chain.group().replace(" ", "").replace("-", "")
                take("card", chain.span(), 16 <= len(digits) <= 19 and passes_luhn(digits))
            if at >= free["ip"]:
                if parts := _FOUR_PARTS.match(text, at):
                    small = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                                for p in parts.group().split("."))
                    take("ip", parts.span(), small)
                else:
                    free["ip"] = _DIGIT_RUN.match(text, at).end()
        elif what == "at":
            if at >= free["email"]:
                take("email", email_at(text, at, free["email"]))
        elif what == "plus":
            if at >= free["phone"] and (dialled := _DIALLED.match(text, at)):
                n = sum(c in "0123456789" for c in dialled.group())
                take("phone", dialled.span(), 8 <= n <= 15)
        elif what == "scheme":
            if at >= free["url"]:
                take("url", url_at(text, at, last + 1))
        elif at >= free["account"]:
            if span := account_at(text, at, last + 1, poor):
                if len(_DIGIT.findall(text, *span)) >= 3:
                    take("account", span)
                else:
                    poor = span[1]
    return [(kind, *span) for kind in KINDS for span in found[kind]]


SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``, the personal data of each whole text, one row per input row.

    Offsets count code points, the end is exclusive. NULL and empty texts have no spans. A NULL or
    repeated id is passed on as it is. An empty table gives no rows. Other columns are not read.
    """
    in_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text)]
                for text in texts_of(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, _SPAN_TYPE)], names=["id", "spans"]
            )

    return rows.mapInArrow(scan, f"id {id_type}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the text with each span replaced by its kind in angle brackets.

    Where spans overlap, the one that begins first is replaced, the longer of two that begin
    together. NULL stays NULL and the empty text stays empty. NULL and repeated ids are passed on; an
    empty table gives no rows. Other columns are not read.
    """
    in_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for kind, start, end in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
            if start >= at:
                parts += [text[at:start], f"<{kind}>"]
                at = end
        return "".join([*parts, text[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["id", "text"]
            )

    return rows.mapInArrow(scan, f"id {id_type}, text string").toDF(id_col, text_col)
