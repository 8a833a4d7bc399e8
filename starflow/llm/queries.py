"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import (
    decontamination,
    html_text,
    language_id,
    lexical_search,
    line_dedup,
    merkle,
    near_duplicates,
    packing,
    pii,
    quality,
    top_k,
    toxicity,
    url_filters,
)
from starflow.llm.common import remainder, table
from starflow.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_utc(spark), folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    learned = language_id.fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    found = language_id.identify(docs, learned)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op3_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    found = toxicity.score_toxicity(docs, table(spark, folder, "labels"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op2_line_dedup(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_kept", "text"
    )


# The pages have no fetch times and there is no block list, so both are read off the pages: every
# page is a capture, and every page is a dated entry for its host, its site or its directory.
FETCHED = "1704067200 + 60 * pmod(page_id * 104729, 525600)"
LISTED = "1704067200 + 60 * pmod(page_id * 7919, 525600)"
LISTED_PAGE = f"""
    SELECT {LISTED} AS listed_at,
           CASE length(url) % 3
             WHEN 0 THEN host
             WHEN 1 THEN regexp_replace(host, '^(www|m|blog)[.]', '')
             ELSE concat(host, '/', split_part(substr(url, instr(url, '://') + 3), '/', 2), '/')
           END AS pattern,
           CASE WHEN url LIKE '%utm_source%' THEN 'remove' WHEN url LIKE '%?page%' THEN 'spam'
                WHEN url LIKE '%#top' THEN 'adult' ELSE 'malware' END AS category
    FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM {{pages}})
"""


@query
def op4_url_filters(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr(FETCHED))
    entries = spark.sql(LISTED_PAGE.format(pages="{pages}"), pages=pages)
    return url_filters.judge(captures, entries)


def _duck(sql: str) -> str:
    """The same arithmetic for non-negative ids in DuckDB's words."""
    return sql.replace("pmod(page_id * 104729, 525600)", "(page_id * 104729 % 525600)").replace(
        "pmod(page_id * 7919, 525600)", "(page_id * 7919 % 525600)"
    )


ORACLE["op4_url_filters"] = f"""
WITH entries AS ({_duck(LISTED_PAGE.format(pages="pages"))}),
dated AS (SELECT pattern, listed_at, max(category) AS category FROM entries GROUP BY ALL),
captures AS (
    SELECT page_id, url, {_duck(FETCHED)} AS fetched_at,
           lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host,
           regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path
    FROM pages
),
asked AS (
    SELECT *, unnest(list_distinct(list_concat(
        list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
                       lambda i: array_to_string(list_slice(string_split(host, '.'), i, 99), '.')),
        list_transform(range(1, len(string_split(path, '/'))),
                       lambda i: host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/') || '/')
    ))) AS pattern
    FROM captures
),
active AS (
    SELECT a.page_id, a.pattern, d.category, d.listed_at
    FROM asked a ASOF JOIN dated d ON a.pattern = d.pattern AND a.fetched_at >= d.listed_at
),
best AS (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern DESC) AS place
    FROM active
)
SELECT c.page_id, c.url, c.fetched_at, c.host,
       coalesce(b.category <> 'remove', false) AS blocked, b.pattern, b.category, b.listed_at
FROM captures c LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (page_id)
"""


def site_columns():
    """The site hierarchy of documents: the source, and each language of it."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


@query
def op6_quality(spark, folder):
    docs = table(spark, folder, "documents")
    found = quality.score_quality(docs, table(spark, folder, "labels"), *site_columns())
    return found.select(
        "doc_id", "evidence", "site", "score", (F.col("score") >= quality.LEAST).alias("kept")
    )


@query
def op8_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k.top_k(vectors, F.col("vec_id") % 100 == 0)


@query
def op5_packing(spark, folder):
    pieces = packing.decompose(table(spark, folder, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )


@query
def op7_pii(spark, folder):
    found = pii.find_pii(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def joined(spans):
        written = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, written), ",")

    def count(kind: str):
        n = F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
        return n.alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.BASE_KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op9_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


@query
def op10_decontamination(spark, folder):
    found = decontamination.scan(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id", "text"]
    )
    return found.select(
        "doc_id",
        "n_words",
        decontamination.hit_words().alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op11_lexical_search(spark, folder):
    return lexical_search.rank_documents(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op12_merkle(spark, folder):
    docs = table(spark, folder, "documents")
    changed = F.when(remainder("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    tampered = ["doc_id", "source", "lang", changed, "text"]
    claimed = merkle.leaf_hash([F.col(f) if isinstance(f, str) else f for f in tampered])
    found = merkle.manifest(docs, also={"claimed": claimed})
    folded = merkle.fold(F.col("claimed"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_hash(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_html_text(spark, folder):
    found = html_text.extract_text(table(spark, folder, "pages"))
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    return found.select("page_id", "url", "text", n_chars, "removed")


# ---- SQL equivalents -------------------------------------------------------------------------

ORACLE["op8_top_k"] = """
WITH finite AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scaled AS (
    SELECT vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM finite
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM scaled q JOIN scaled c
    ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Only A to Z are lower-cased.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op9_near_duplicates"] = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
pieces AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS piece
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM pieces a JOIN pieces b ON a.piece = b.piece AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)
),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least l USING (doc_id)
"""

ORACLE["op10_decontamination"] = rf"""
WITH doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
),
item_words AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
),
item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 11, 2))) AS i
          FROM item_words WHERE len(w) > 0)
),
placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
found AS (
    SELECT DISTINCT p.doc_id, p.i, s.size, x.item_id
    FROM placed p CROSS JOIN (SELECT DISTINCT size FROM item_windows) s
    JOIN item_windows x ON x.size = s.size AND x.words = array_to_string(p.w[p.i : p.i + s.size - 1], ' ')
    WHERE p.i + s.size - 1 <= len(p.w)
),
hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_LOWER)

ORACLE["op11_lexical_search"] = f"""
WITH doc_terms AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL
),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM doc_terms CROSS JOIN corpus GROUP BY term, docs
),
norms AS (SELECT doc_id, 50 + (50 * n * docs) // words AS m FROM lengths CROSS JOIN corpus),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM asked JOIN doc_terms USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
    GROUP BY ALL
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

# A value as the leaf has it, and the unsigned crc32 of a decimal number.
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT],
                list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                  lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(_FIELD.format(f) for f in fields) + ")"


ORACLE["op12_merkle"] = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
           {_leaf(f"CASE WHEN {_CRC32} % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS claimed
    FROM documents
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
    FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, rank AS place, leaf AS h FROM ranked
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1
    GROUP BY tree, level, place // 2
),
subroots AS (
    SELECT tree, h, level AS height, row_number() OVER (ORDER BY tree) - 1 AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY level DESC) AS last FROM nodes)
    WHERE last = 1
),
forest AS (
    SELECT 0 AS level, place, h FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM forest) WHERE n > 1
    GROUP BY level, place // 2
),
top AS (SELECT h AS root, level AS height FROM forest ORDER BY level DESC LIMIT 1),
steps AS (
    SELECT l.doc_id, l.tree, l.rank, n.level, n.h, n.place & 1 AS goes_right
    FROM ranked l JOIN subroots s ON s.tree = l.tree CROSS JOIN range(0, 64) AS r(level)
    LEFT JOIN nodes n ON n.tree = l.tree AND n.level = r.level AND n.place = xor(l.rank >> r.level, 1)
    WHERE r.level < s.height AND n.h IS NOT NULL
    UNION ALL
    SELECT l.doc_id, l.tree, l.rank, 100 + f.level, f.h, f.place & 1
    FROM ranked l JOIN subroots s ON s.tree = l.tree CROSS JOIN range(0, 64) AS r(level)
    CROSS JOIN top t
    LEFT JOIN forest f ON f.level = r.level AND f.place = xor(s.place >> r.level, 1)
    WHERE r.level < t.height AND f.h IS NOT NULL
),
proofs AS (
    SELECT doc_id, tree, rank, string_agg(h, '' ORDER BY level) AS siblings FROM steps GROUP BY ALL
),
folded AS (
    SELECT tree, rank, 0 AS level, claimed AS h FROM ranked
    UNION ALL
    SELECT f.tree, f.rank, f.level + 1,
           sha256(CASE WHEN s.goes_right = 0 THEN s.h || f.h WHEN s.goes_right = 1 THEN f.h || s.h ELSE f.h END)
    FROM folded f JOIN subroots r ON r.tree = f.tree CROSS JOIN top t
    LEFT JOIN steps s ON s.tree = f.tree AND s.rank = f.rank
        AND s.level = CASE WHEN f.level < r.height THEN f.level ELSE 100 + f.level - r.height END
    WHERE f.level < r.height + t.height
)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.h AS folded_root, f.h = t.root AS verified
FROM ranked l JOIN subroots s ON s.tree = l.tree CROSS JOIN top t
LEFT JOIN proofs p ON p.tree = l.tree AND p.rank = l.rank
JOIN folded f ON f.tree = l.tree AND f.rank = l.rank AND f.level = s.height + t.height
"""
