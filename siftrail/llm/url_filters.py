"""URL lists with dates: each capture is judged by the entries that were active when it was fetched.

A list is a log of dated entries: at some moment a pattern (a host, a parent domain, or a host and
a path prefix) is added to a list or taken off it. Consecutive entries of a pattern become validity
intervals, and an as-of join gives each capture the entries whose interval holds its fetch time.

Captures are first reduced to patterns that some list has. Then both sides are keyed by pattern and calendar month, so the captures of a host that holds a third of
all rows are dealt out by month, and an interval meets only the captures of the months it spans.

A path prefix need not end with a slash: it covers all that begins with it. Hosts are compared in lower
case, paths as they are.

Edge cases: a null or unreadable URL, or a null fetch time, matches nothing and is kept as allowed.
Entries with a null list, pattern, time or action are passed over. Of entries of one list and
pattern at the same moment the removal wins; repeated entries count once. An interval holds its
start and not its end; a pattern never removed stays active. Repeated captures are judged one by
one. With no entries every capture is allowed. Very long
URLs are read whole. Other columns pass through; outputs take other names if theirs are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftrail.llm.common import col, free_name, written

HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without a closing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def folded(pattern: Column) -> Column:
    """A pattern with its host in lower case; the letter case of a path matters."""
    return F.concat(F.lower(F.regexp_extract(pattern, "^[^/]*", 0)), F.regexp_extract(pattern, "(?s)^[^/]*(.*)$", 1))


def patterns_of(url: Column, lengths: list[int] | None = None) -> Column:
    """Every pattern that covers a URL: its host, all parent domains, all folders of its path, the whole path.

    Patterns may also end within a path, as those of one list's ``lengths`` do.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    path = F.regexp_extract(url, PATH, 1)
    parts = F.split(path, "/")
    folders = F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: (i >= 2) & (i < F.size(parts))),
        lambda i: F.concat(host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")),
    )
    full = F.concat(host, path)
    ends = F.filter(F.array(*map(F.lit, lengths or [])).cast("array<int>"), lambda n: (n > F.length(host)) & (n <= F.length(full)))
    pages = F.when(path != "", F.array(full)).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(parents, folders, pages, F.transform(ends, lambda n: F.substring(full, F.lit(1), n))))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame, list_name: str = "list", pattern: str = "pattern", at: str = "at", action: str = "action") -> DataFrame:
    """(list, pattern, since, until) of a log whose actions are ``add`` and ``remove``.

    The next entry of a pattern is sought within its month; the last entry of a month looks to the
    first entry of the next month there is, so no window holds more than a month's entries or the
    months of one pattern.
    """
    log = entries.select(F.lower(col(list_name)).alias("list"), folded(col(pattern)).alias("pattern"), col(at).cast("timestamp").alias("at"), F.lower(col(action)).alias("action"))
    log = log.where("list IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    states = log.groupBy("list", "pattern", "at").agg(F.max(F.col("action") == "remove").alias("gone")).withColumn("month", _month("at"))
    by_month = states.groupBy("list", "pattern", "month").agg(F.min("at").alias("first"))
    months = by_month.select("list", "pattern", "month", F.lead("first").over(Window.partitionBy("list", "pattern").orderBy("month")).alias("after"))
    inside = F.lead("at").over(Window.partitionBy("list", "pattern", "month").orderBy("at"))
    return states.withColumn("next", inside).join(months, ["list", "pattern", "month"]).where(~F.col("gone")).select("list", "pattern", F.col("at").alias("since"), F.coalesce("next", "after").alias("until"))


def _month(name: str) -> Column:
    return F.year(name) * 12 + F.month(name) - 1


def matches(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(url, fetched, list, pattern, since) for each entry active when a URL was fetched."""
    seen = captures.select(col(url).alias("url"), col(fetched).cast("timestamp").alias("fetched")).where("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    span = seen.agg(F.min(_month("fetched")).alias("lo"), F.max(_month("fetched")).alias("hi")).first()
    lo, hi = F.lit(span["lo"]).cast("int"), F.lit(span["hi"]).cast("int")
    inner = entries.select(folded(F.col("pattern")).alias("p")).where("p LIKE '%/%' AND p NOT LIKE '%/'").select(F.length("p").alias("n")).distinct()
    lengths = sorted(r["n"] for r in inner.collect())
    keyed = seen.select("url", "fetched", _month("fetched").alias("month"), F.explode(patterns_of(F.col("url"), lengths)).alias("pattern"))
    first, last = F.greatest(_month("since"), lo), F.least(F.coalesce(_month("until"), hi), hi)
    active = intervals(entries).where(first <= last).select("list", "pattern", "since", "until", F.explode(F.sequence(first, last)).alias("month"))
    # A pattern that no list has, as a top domain half of all captures have, goes before the as-of join;
    # what is written has a known size, so Spark sends it out if it is small and splits hot keys if not.
    active = written(active, "intervals")
    keyed = keyed.join(written(active.select("pattern").distinct(), "patterns"), "pattern", "left_semi")
    hit = keyed.join(active, ["pattern", "month"]).where("since <= fetched AND (until IS NULL OR fetched < until)")
    return hit.select("url", "fetched", "list", "pattern", "since")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Every capture with ``blocked``, the deciding ``list``, ``pattern`` and ``since``, and ``n_entries``.

    The longest pattern decides; of equal ones the list and then the pattern that sort first.
    """
    found = matches(captures, entries, url, fetched).groupBy(F.col("url").alias("found_url"), F.col("fetched").alias("found_at"))
    found = found.agg(F.min(F.struct((-F.length("pattern")).alias("n"), "list", "pattern", "since")).alias("found_top"), F.count("*").alias("found_n"))
    new = {name: free_name(captures, name) for name in ("blocked", "list", "pattern", "since", "n_entries")}
    old = [f"c{i}" for i in range(len(captures.columns))]
    rows = captures.toDF(*old)
    u, t = old[captures.columns.index(url)], old[captures.columns.index(fetched)]
    out = rows.join(found, (rows[u] == found["found_url"]) & (rows[t].cast("timestamp") == found["found_at"]), "left")
    return out.select(
        *[F.col(o).alias(c) for o, c in zip(old, captures.columns, strict=True)],
        F.col("found_top").isNotNull().alias(new["blocked"]),
        *[F.col(f"found_top.{name}").alias(new[name]) for name in ("list", "pattern", "since")],
        F.coalesce("found_n", F.lit(0).cast("bigint")).alias(new["n_entries"]),
    )
