"""URL filters by a temporal list join.

Dated list entries become intervals in which they hold: each ends where the next entry for the
same pattern begins. Every capture is evaluated against the entries that were active when it was
fetched, by an as-of join on pattern and period, and the most specific pattern decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.common import keep

# Seconds of a period. Intervals are cut at period ends, so that captures and entries meet by
# equality and no pattern's whole history comes into one task.
PERIOD = 30 * 24 * 3600

REMOVED = "remove"


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column, deepest: Column | int = 2**30) -> Column:
    """All patterns that can match: the host, its parent domains (from two labels on), and the host
    with each leading part of the path that ends in a slash, up to ``deepest`` slashes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.greatest(n - i + 1, F.lit(0))), "."),
    )
    parts = F.split(path_of(url), "/")
    depth = F.least(F.size(parts) - 1, F.lit(deepest))
    prefixes = F.when(
        depth >= 1,
        F.transform(
            F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
            lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    found = F.array_distinct(F.concat(domains, prefixes))
    return F.when(host != "", found).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, listed_at, until`` from ``pattern, category, listed_at`` (seconds).

    An entry holds from ``listed_at`` until the next one of its pattern (``until`` is NULL for the
    last). Of several at one second the greatest category counts. Entries with a NULL are left
    out. The next entry is sought within a period, and then among the first ones of the periods,
    so a pattern with very many entries is spread over its periods.
    """
    dated = entries.filter(
        F.col("pattern").isNotNull() & F.col("category").isNotNull() & F.col("listed_at").isNotNull()
    )
    dated = dated.groupBy("pattern", "listed_at").agg(F.max("category").alias("category"))
    dated = dated.withColumn("period", F.floor(F.col("listed_at") / PERIOD))
    first = dated.groupBy("pattern", "period").agg(F.min("listed_at").alias("first"))
    later = Window.partitionBy("pattern").orderBy("period")
    first = first.withColumn("then", F.lead("first").over(later)).drop("first")
    within = Window.partitionBy("pattern", "period").orderBy("listed_at")
    following = F.lead("listed_at").over(within)
    return (
        dated.withColumn("following", following)
        .join(first.hint("merge"), ["pattern", "period"])
        .select("pattern", "category", "listed_at", F.coalesce("following", "then").alias("until"))
    )


def _by_period(dated: DataFrame, wanted: DataFrame) -> DataFrame:
    """The intervals by ``pattern, period``: in the period where each begins, and in each wanted one
    that it reaches from an earlier one.

    An interval is not copied to the periods that it spans; the last one of each period is carried
    forward to those that are asked for, however far they are apart.
    """
    fields = ("category", "listed_at", "until")
    began = F.floor(F.col("listed_at") / PERIOD).alias("period")
    starts = dated.select("pattern", began, *fields)
    newest = F.max(F.struct("listed_at", "category", "until")).alias("newest")
    ends = starts.groupBy("pattern", "period").agg(newest)
    marks = ends.select("pattern", "period", "newest", F.lit(False).alias("asked")).unionByName(
        wanted.select("pattern", "period", F.lit(True).alias("asked")), allowMissingColumns=True
    )
    # One row for a pattern and a period, so a pattern has no more rows than there are periods.
    marks = marks.groupBy("pattern", "period").agg(
        F.max("newest").alias("newest"), F.max("asked").alias("asked")
    )
    earlier = Window.partitionBy("pattern").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("before", F.last("newest", ignorenulls=True).over(earlier))
    carried = carried.filter(F.col("asked") & F.col("before").isNotNull())
    return starts.unionByName(carried.select("pattern", "period", *(f"before.{f}" for f in fields)))


def _deepest(entries: DataFrame) -> int:
    """Slashes of the deepest listed path; longer prefixes of a URL are in no list."""
    slashes = F.length("pattern") - F.length(F.replace("pattern", F.lit("/"), F.lit("")))
    return entries.agg(F.coalesce(F.max(slashes), F.lit(0)).alias("n")).first()["n"]


def judge(
    captures: DataFrame, entries: DataFrame, url_col: str = "url", fetched_col: str = "fetched_at"
) -> DataFrame:
    """The rows of ``captures`` with ``host, blocked, pattern, category, listed_at``.

    ``fetched_col`` is in seconds. Among the entries active at that time the longest pattern decides
    (of equal length the last in order), and blocks unless its category is ``remove``; without one
    the capture is not blocked and ``pattern, category, listed_at`` are NULL. A NULL URL or time
    matches nothing; a URL without a host has an empty host. Repeated rows are judged alike. Without
    captures there are no rows, without entries nothing is blocked. Columns of those names are
    replaced. URLs of any length are read whole, but of their leading parts only those that are not
    deeper than the deepest listed one are looked up.
    """
    added = ("host", "blocked", "pattern", "category", "listed_at")
    names = [c for c in captures.columns if c not in added]
    inner = [f"c{i}" for i in range(len(names))]
    rows = captures.select(*[F.col(c).alias(i) for c, i in zip(names, inner)])
    # Stored, so that the row numbers are the same whenever they are read.
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), "url_captures")
    url, fetched = F.col(inner[names.index(url_col)]), F.col(inner[names.index(fetched_col)])
    asked = rows.filter(fetched.isNotNull()).select(
        "row",
        fetched.alias("fetched"),
        F.floor(fetched / PERIOD).alias("period"),
        F.explode(patterns_of(url, _deepest(entries))).alias("pattern"),
    )
    cut = keep(_by_period(intervals(entries), asked.select("pattern", "period").distinct()), "url_cut")
    active = asked.join(cut.hint("merge"), ["pattern", "period"]).filter(
        (F.col("listed_at") <= F.col("fetched"))
        & (F.col("until").isNull() | (F.col("until") > F.col("fetched")))
    )
    best = F.max(F.struct(F.length("pattern").alias("size"), "pattern", "category", "listed_at"))
    decided = active.groupBy("row").agg(best.alias("best"))
    return rows.join(decided.hint("merge"), "row", "left").select(
        *[F.col(i).alias(c) for i, c in zip(inner, names)],
        host_of(url).alias("host"),
        F.coalesce(F.col("best.category") != REMOVED, F.lit(False)).alias("blocked"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.category").alias("category"),
        F.col("best.listed_at").alias("listed_at"),
    )
