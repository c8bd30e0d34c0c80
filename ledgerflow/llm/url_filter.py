"""URL filtering against a dated block list (temporal list join).

List entries are dated events: a pattern is added to or removed from the
list on a day.  They become validity intervals, and an as-of join
evaluates every capture against the entries active at its fetch time.

A pattern is a host (which covers its sub-domains) or a host followed by
leading path segments.  Each URL is expanded into the patterns that could
cover it, at most one per host label and path segment up to the deepest
entry of the list, so the list is joined by equality and the interval is a residual condition.

Skew: a popular host gives a hot join key on the captures' side only
(intervals of one pattern do not overlap, so a key and an instant meet one
row at most).  Both sides are read from staged files, so adaptive
execution splits the hot key.  Events of a pattern are reduced to one per
day before the only window, whose partitions the calendar bounds.

Defined results: a null or unusable URL matches nothing.  A null fetch
time matches nothing.  Events with a null pattern, day or action are
ignored; any action but ``add`` ends the interval, and of several events
of one pattern and day a removal wins.  Captures repeated in full come
back as often as they came in.  An empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stage


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port or final dot."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"[.]?(:[0-9]*)?$", "")
    return F.nullif(ascii_lower(host), F.lit(""))


def url_patterns(url: Column, host: Column, most_segments: int) -> Column:
    """Every pattern of at most so many segments that covers the URL: host suffixes, host + leading segments."""
    labels = F.split(host, "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(
        ".", F.slice(labels, i, F.size(labels))))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    n = F.least(F.size(segments), F.lit(most_segments))
    prefixes = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(
        host, F.lit("/"), F.concat_ws("/", F.slice(segments, 1, i))))).otherwise(
        F.array().cast("array<string>"))
    return F.concat(suffixes, prefixes)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(pattern, category, valid_from, valid_to) of the dated list entries.

    ``entries`` has pattern, category, action and day; ``valid_to`` is null
    while the entry stands.
    """
    daily = (entries.filter("pattern IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
             .groupBy(ascii_lower(F.col("pattern")).alias("pattern"), "day")
             .agg(F.min(F.col("action") == "add").alias("listed"),
                  F.min("category").alias("category")))
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return (daily.withColumn("valid_to", following).filter("listed")
            .select("pattern", "category", F.col("day").alias("valid_from"), "valid_to"))


def evaluate_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id",
                  url_col: str = "url", fetch_col: str = "fetch_day") -> DataFrame:
    """(id, host, fetch_day, blocked, n_active, pattern, category, listed_since).

    ``pattern`` is the most specific active entry: the longest, then the
    first in text order; category and date are that entry's.
    """
    rows = (captures.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                             F.col(fetch_col).alias("fetch_day"))
            .agg(F.count("*").alias("copies"))
            .withColumn("host", url_host(F.col("url"))))
    intervals = stage(validity_intervals(entries), "url-intervals")
    deepest = intervals.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    keyed = stage(rows.withColumn("key", F.explode_outer(url_patterns(F.col("url"), F.col("host"), deepest))),
                  "url-keys")
    active = ((F.col("key") == F.col("pattern")) & (F.col("fetch_day") >= F.col("valid_from"))
              & (F.col("valid_to").isNull() | (F.col("fetch_day") < F.col("valid_to"))))
    matched = keyed.join(intervals, active, "left")
    best = F.min(F.when(F.col("pattern").isNotNull(), F.struct(
        (-F.char_length("pattern")).alias("n"), F.col("pattern").alias("pattern"),
        F.col("category").alias("category"), F.col("valid_from").alias("since"))))
    judged = (matched.groupBy("id", "url", "fetch_day", "host", "copies")
              .agg(F.count("pattern").alias("n_active"), best.alias("best")))
    return (judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .select(F.col("id").alias(id_col), "host", F.col("fetch_day").alias(fetch_col),
                    (F.col("n_active") > 0).alias("blocked"), "n_active", "best.pattern",
                    "best.category", F.col("best.since").alias("listed_since")))
