"""Main text of web pages, with what a site repeats on its pages removed.

Each page is read once into the text blocks of its main part, each with the hashes of the element
subtrees around it. Spark counts the hashes for each host, over pages with different content; a
subtree that most pages of its host have is a template, and its blocks go. What HTML itself marks
as no content (navigation, forms, scripts and so on) goes while the page is read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import keep, small_batches
from starflow.operators.joins import BROADCAST_BYTES

# A subtree is a template if so many pages of the host, and such a share of them, have it. Where
# the page names its main part (``article`` or ``main``) the bar is higher, as what recurs there
# may well be a passage that many articles share.
LEAST_PAGES, SHARE = 3, 0.5
LEAST_MARKED, SHARE_MARKED = 10, 0.8

# Fixed values of HTML. Elements that are blocks; those of them, and those within a line, whose
# text is never content; elements that have no content; elements whose content is no markup.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption "
    "figure h1 h2 h3 h4 h5 h6 header hgroup html legend li main ol p pre section summary table "
    "tbody tfoot thead tr ul".split()
)
DROPPED = frozenset("head nav footer aside form dialog menu search noscript template frameset".split())
MUTED = frozenset("button select datalist object applet canvas audio video map svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|xmp|noembed|noframes|iframe"
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
IN_HEAD = frozenset(("base", "link", "meta", "noscript", "template"))

# Open elements that a start tag ends, and the elements beyond which they are not looked for.
_IN_TABLE = ("table",)
ENDED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), _IN_TABLE),
    "td": (("p", "li"), ("tr", "table")),
    "th": (("p", "li"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), _IN_TABLE),
    "tbody": (("thead", "tbody", "tfoot"), _IN_TABLE),
    "tfoot": (("thead", "tbody", "tfoot"), _IN_TABLE),
}

# Words of a class or an id, and roles, that say that an element is not of the main text.
NAMED = frozenset(
    "ad ads adbox adslot advert adverts advertise advertisement advertising alert alerts aside banner "
    "breadcrumb breadcrumbs colophon comment comments consent cookie cookies copyright disclaimer "
    "disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification notifications overlay pager pagination paywall popup promo promos promotion "
    "related recommended recommendations replies respond search share sharing sidebar sidebars sidenav "
    "signin signup skip social sponsor sponsored sponsors subnav subscribe subscription toolbar topbar "
    "topnav widget widgets".split()
)
# Names that pages without the elements for it give to their main part.
BODIES = frozenset(
    "article article-body article-content articlebody body-text content entry-content main main-content "
    "post-body post-content story story-body".split()
)
NOT_NAMED = frozenset(("has", "with", "without", "no", "is", "js"))
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search status toolbar".split()
)

_ATTRIBUTES = r"(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({RAW})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})(?:(?P<whole>>)|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NAME = re.compile(r"[a-z0-9]+")

_FOUND = (
    "page_id {id}, url string, host string, marked boolean, content bigint, "
    "blocks array<string>, subtrees array<struct<hash:bigint,first:int,last:int>>"
)


def named(attributes: str) -> tuple[set[str], bool]:
    """What a class, an id or a role says against the element, and whether one says that it is the
    main part."""
    against: set[str] = set()
    body = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        words = unescape("".join(values)).split()
        if name.lower() == "role":
            against |= ROLES.intersection(w.lower() for w in words)
            body = body or words == ["main"]
            continue
        for word in words:
            parts = _NAME.findall(_HUMP.sub("-", word).lower())
            if parts and parts[0] not in NOT_NAMED:
                against |= NAMED.intersection(parts)
            body = body or "-".join(parts) in BODIES
    return against, body and not against


class Page:
    """The block elements of a page, in page order, and the runs of text in them."""

    def __init__(self, html: str):
        # Of each element: the one it is in, its tag, what speaks against it, the kind of main part
        # that it is, its hash.
        self.parent, self.tag, self.against, self.kind, self.hash = [0], ["html"], [set()], [""], [0]
        self.runs: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("html", 0)]  # element 0 within a line: it is muted
        self._at: dict[str, list[int]] = {}  # where each tag is open
        self._blocks = [0]  # where a block is
        self._holds: list[list] = [[]]  # texts and hashes in each open block
        self._muted, self._text = 0, []
        at = 0
        for token in _TOKEN.finditer(html):
            if token.start() > at:
                self._say(html[at : token.start()])
            at = token.end()
            if token["whole"]:
                tag = token["tag"].lower()
                if token["end"]:
                    self._end(tag)
                else:
                    self._start(tag, token["attributes"])
        self._say(html[at:])
        while len(self._open) > 1:
            self._close()
        self._flush()

    def _say(self, text: str) -> None:
        if self._open[-1][0] == "head" and text.strip():
            self._close()
        if not self._muted:
            self._text.append(text)

    def _block(self) -> int:
        """The innermost open block."""
        return self._open[self._blocks[-1]][1]

    def _flush(self) -> None:
        text = " ".join(unescape("".join(self._text)).split())
        self._text = []
        if text:
            self.runs.append((self._block(), text))
            self._holds[-1].append(text)

    def _close(self) -> None:
        tag, element = self._open[-1]
        self._at[tag].pop()
        if not element:
            self._open.pop()
            self._muted -= 1
            return
        self._flush()
        self._open.pop()
        self._blocks.pop()
        # Texts come with their length, so that they and the hashes cannot be mixed up.
        held = (f"#{x};" if isinstance(x, int) else f"{len(x)}:{x}" for x in self._holds.pop())
        written = (tag + "|" + "".join(held)).encode("utf-8", "surrogatepass")
        self.hash[element] = xxhash.xxh3_64_intdigest(written) - 2**63
        self._holds[-1].append(self.hash[element])

    def _push(self, tag: str, element: int) -> None:
        self._at.setdefault(tag, []).append(len(self._open))
        self._open.append((tag, element))

    def _close_from(self, place: int) -> None:
        while len(self._open) > place:
            self._close()

    def _end(self, tag: str) -> None:
        if at := self._at.get(tag):  # elements within a line are only there if they are muted
            self._close_from(at[-1])

    def _end_open(self, tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        floor = max((self._at[t][-1] for t in within if self._at.get(t)), default=0)
        places = (self._at[t] for t in tags if self._at.get(t))
        first = min((at[bisect_right(at, floor)] for at in places if at[-1] > floor), default=0)
        if first:
            self._close_from(first)

    def _start(self, tag: str, attributes: str) -> None:
        if self._open[-1][0] == "head" and tag not in IN_HEAD:
            self._close()
        if tag in ("html", "body"):
            return
        if tag in ENDED:
            self._end_open(*ENDED[tag])
        if tag in BLOCKS or tag in DROPPED or tag == "hr":
            self._end_open(("p",), ("table", "caption", "button", "object"))
            if tag in HEADINGS and self._open[-1][0] in HEADINGS:
                self._close()
            self._flush()
        elif tag in ("br", "td", "th", "img"):
            self._say(" ")
        if tag in VOID:
            return
        against, body = named(attributes) if "=" in attributes and tag != "main" else (set(), False)
        if tag in BLOCKS or tag in DROPPED:
            self.parent.append(self._block())
            self.tag.append(tag)
            self.against.append(against)
            self.kind.append(tag if tag in ("article", "main") else "main" if body else "")
            self.hash.append(0)
            self._blocks.append(len(self._open))
            self._push(tag, len(self.tag) - 1)
            self._holds.append([])
        elif against or (tag in MUTED and attributes[-1:] != "/") or (self._muted and self._at.get(tag)):
            self._push(tag, 0)
            self._muted += 1

    def main(self) -> tuple[bool, list[str], list[tuple[int, int, int]]]:
        """Whether the page names its main part; the blocks of it; the hash of each subtree in it
        with the first and the last block that it has.

        The main part is the articles, else the ``main`` element or one that is named like it, else
        the page. What is named away goes, unless the first of these is in it. A header in the main
        part gives its headings.
        """
        n = len(self.tag)
        shelter = {0}
        gone, inside, header = [False] * n, [""] * n, [False] * n
        for kind in ("main", "article"):
            first = next((i for i in range(n) if self.kind[i] == kind and not self.against[i]), 0)
            while first:
                shelter.add(first)
                first = self.parent[first]
        for i in range(1, n):
            up, tag = self.parent[i], self.tag[i]
            inside[i], header[i] = inside[up], header[up]
            away = tag in DROPPED or (self.against[i] - {"header"})
            if gone[up] or (away and (i not in shelter or (tag in DROPPED and tag != "form"))):
                gone[i] = True
            elif (tag == "header" or self.against[i]) and i not in shelter:
                header[i] = bool(inside[up])
                gone[i] = not inside[up]
            if self.kind[i] and inside[i] != "article" and not gone[i]:
                inside[i] = self.kind[i]
        kept = []
        for element, text in self.runs:
            heading = not header[element] or self.tag[element] in HEADINGS
            if not gone[element] and heading:
                kept.append((element, text))
        parts = {inside[element] for element, _ in kept}
        part = next((p for p in ("article", "main") if p in parts), "")
        blocks = [(element, text) for element, text in kept if inside[element] == part]
        first, last = {}, {}
        for at, (element, _) in enumerate(blocks):
            first.setdefault(element, at)
            last[element] = at
        subtrees = []
        for i in range(n - 1, 0, -1):  # from the inside out; the main part itself is none
            up = self.parent[i]
            if i in first and (not part or inside[up] == part):
                subtrees.append((self.hash[i], first[i], last[i]))
                first[up] = min(first[i], first.get(up, first[i]))
                last[up] = max(last[i], last.get(up, last[i]))
        return bool(part), [text for _, text in blocks], subtrees


def _host(url: str | None) -> str | None:
    found = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", url or "")
    return found[1].lower() if found else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, marks, contents, texts, subtrees = [], [], [], [], []
        for url, html in zip(batch.column(1), batch.column(2)):
            marked, blocks, found = Page(html.as_py() or "").main()
            whole = "\n".join(blocks).encode("utf-8", "replace")
            hosts.append(_host(url.as_py()))
            marks.append(marked)
            contents.append(xxhash.xxh3_64_intdigest(whole) - 2**63)
            texts.append(blocks)
            subtrees.append(found)
        ends = np.cumsum([0, *map(len, subtrees)], dtype=np.int32)
        flat = list(zip(*(s for found in subtrees for s in found))) or [(), (), ()]
        kinds = (("hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32()))
        parts = [pa.array(values, kind) for values, (_, kind) in zip(flat, kinds)]
        trees = pa.StructArray.from_arrays(parts, [name for name, _ in kinds])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(hosts, pa.string()),
                pa.array(marks, pa.bool_()), pa.array(contents, pa.int64()),
                pa.array(texts, pa.list_(pa.string())), pa.ListArray.from_arrays(ends, trees),
            ],
            names=["page_id", "url", "host", "marked", "content", "blocks", "subtrees"],
        )


def templates(read: DataFrame) -> DataFrame:
    """``host, marked, templates``: the subtree hashes that most pages of a host have.

    Pages with equal content count once. As each template is on at least half of them, a host has
    at most twice as many templates as its pages have subtrees on the average.
    """
    site = ["host", "marked"]
    hosted = read.filter(F.col("host").isNotNull())
    pages = hosted.select(*site, "content").distinct().groupBy(*site).agg(F.count("*").alias("pages"))
    subtrees = F.explode(F.array_distinct("subtrees.hash")).alias("hash")
    on_pages = hosted.select(*site, "content", subtrees).distinct().groupBy(*site, "hash")
    counts = on_pages.agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    least = F.when(F.col("marked"), LEAST_MARKED).otherwise(LEAST_PAGES)
    share = F.when(F.col("marked"), SHARE_MARKED).otherwise(SHARE)
    many = counts.join(pages, site).filter(
        (F.col("n") >= least) & (F.col("n") >= share * F.col("pages"))
    )
    return many.groupBy(*site).agg(F.collect_set("hash").alias("templates"))


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, removed`` for each row of ``pages``: the main text, its blocks in page
    order on a line each, and how many blocks went because the site repeats them.

    NULL and empty pages have the empty text. A page without a host in its URL is a site of its
    own, from which nothing repeated is removed. Pages may be of any length, may be cut off and may
    have unclosed or wrongly nested elements. Repeated rows give repeated results and count as one
    page. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    schema = _FOUND.format(id=rows.schema["page_id"].dataType.simpleString())
    with small_batches(spark):
        read = keep(rows.mapInArrow(_read, schema), "html_blocks")
    found = keep(templates(read), "html_templates")
    size = found.agg(F.sum(F.size("templates") * 8 + F.octet_length("host") + 32)).first()[0] or 0
    small = F.broadcast(found) if size <= BROADCAST_BYTES else found.hint("merge")
    joined = read.join(small, ["host", "marked"], "left")
    repeated = F.filter("subtrees", lambda s: F.array_contains("templates", s["hash"]))
    joined = joined.withColumn("gone", F.coalesce(repeated, F.array()))
    kept = F.filter(
        "blocks",
        lambda _, i: ~F.exists("gone", lambda s: (s["first"] <= i) & (s["last"] >= i)),
    )
    joined = joined.withColumn("kept", kept)
    return joined.select(
        "page_id",
        "url",
        F.array_join("kept", "\n").alias("text"),
        (F.size("blocks") - F.size("kept")).alias("removed"),
    )
