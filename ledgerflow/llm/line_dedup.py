"""Line deduplication by site-relative frequency.

Pages are grouped by host.  The pages of a host that contain a line,
divided by the host's page total, is the line's ratio there; a line of two
pages or more whose ratio exceeds ``RATIO`` is boilerplate of that host and
is dropped from all its pages.  Rows of a host with the same text are one
page, so exact copies do not make their own lines boilerplate.  A line counts once a page;
lines are compared without surrounding ASCII white space; blank lines are
neither counted nor dropped.

Copies: with ``groups`` (``near_dedup.text_groups``) the texts of a group
are one page of their host, in a line's count and in the host's total, so a
document with many exact or near copies does not make its own body
boilerplate.  The pipeline counts so; without ``groups``, as in op5, only
equal texts are one page.  Pages whose text is so much alike
that they are near copies of each other count once, template and all.
Only texts of groups are shuffled whole, as line hashes and once a host;
a Bloom filter of their hashes tells them from the others.

Counting shuffles 64-bit line hashes with a partial sum per task, so a line
on every page of a third of all rows arrives as one row a task.  Only
lines that reach ``LEAST_PAGES`` meet the host totals.  Texts are joined by
(host, text hash) with the dropped lines of that text.

Defined results: a null host is a host of its own.  A null text stays null
and counts as a page without lines.  Repeated rows count once a host and get
the same result.  Texts of any length are read whole.  A text that loses all its lines is empty.  Extra
columns pass through unchanged.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import SPACES, stage

RATIO = 0.08
LEAST_PAGES = 2   # a line of a single page is not repeated


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _line_hashes(text: Column) -> Column:
    """Distinct hashes of the lines that are not blank."""
    bare = F.filter(F.transform(_lines(text), _bare), lambda line: line != "")
    return F.array_distinct(F.transform(bare, lambda line: F.xxhash64(line)))


def _units(pages: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, line) once a page and (host) of each page; a group of texts is one page of a host."""
    groups = groups.withColumnsRenamed({"text_key": "group_key", "group": "unit"})
    bitmap, _ = bloom.build(groups.select("group_key"), groups.count())
    rows = pages.select("host", F.xxhash64("text").alias("text_key"), "text")
    listed = bloom.might_contain(pages.sparkSession, bitmap, F.col("text_key"))
    alone = rows.filter(~listed)
    shared = rows.filter(listed).groupBy("host", "text_key").agg(F.first(_line_hashes(F.col("text"))).alias("lines"))
    shared = stage(shared, "line-shared")
    shared = stage(shared.join(groups, F.col("text_key") == F.col("group_key"), "left").select(
        "host", F.coalesce("unit", "text_key").alias("unit"), "lines"), "line-units")
    lines = alone.select("host", F.explode(_line_hashes(F.col("text"))).alias("line")).unionByName(
        shared.select("host", "unit", F.explode("lines").alias("line")).distinct().select("host", "line"))
    return lines, alone.select("host").unionByName(shared.select("host", "unit").distinct().select("host"))


def _distinct_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, line) once a page and (host) of each page; rows of a host with equal texts are one page.

    Only texts whose hash may occur twice, by a Bloom filter over all, are shuffled, as line hashes.
    """
    rows = pages.select("host", F.xxhash64("text").alias("text_key"), "text")
    keys = stage(rows.select("text_key"), "line-keys")
    _, twice = bloom.build(keys, keys.count())
    listed = bloom.might_contain(pages.sparkSession, twice, F.col("text_key"))
    shared = stage(rows.filter(listed).groupBy("host", "text_key").agg(
        F.first(_line_hashes(F.col("text"))).alias("lines")), "line-shared")
    alone = rows.filter(~listed)
    lines = alone.select("host", F.explode(_line_hashes(F.col("text"))).alias("line")).unionByName(
        shared.select("host", F.explode("lines").alias("line")))
    return lines, alone.select("host").unionByName(shared.select("host"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES,
                groups: DataFrame | None = None) -> DataFrame:
    """(host, line, pages, total) of ``pages(host, text)``: the lines to drop, by hash."""
    if groups is None:
        lines, hosts = _distinct_pages(pages)
    else:
        lines, hosts = _units(pages, groups)
    counted = (lines.groupBy("host", "line").agg(F.count("*").alias("pages"))
               .filter(F.col("pages") >= least_pages))
    counted = stage(counted, "line-counts")
    totals = stage(hosts.groupBy("host").agg(F.count("*").alias("total")), "line-totals")
    totals = totals.withColumnRenamed("host", "total_host")
    return (counted.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
            .filter(F.col("pages") > F.col("total") * F.lit(ratio))
            .select("host", "line", "pages", "total"))


def drop_boilerplate(docs: DataFrame, host: Column | str = "source", text_col: str = "text",
                     ratio: float = RATIO, least_pages: int = LEAST_PAGES,
                     groups: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and its non-blank lines counted.

    Adds n_lines and n_dropped (replacing columns of these names).
    ``groups(text_key, group)`` names the texts that count as one page.
    """
    host = F.col(host) if isinstance(host, str) else host
    text = F.col(text_col)
    pages = docs.select(host.cast("string").alias("host"), text.alias("text"))
    drop = stage(boilerplate(pages, ratio, least_pages, groups), "line-boilerplate")
    drop = drop.select(F.col("host").alias("drop_host"), F.col("line").alias("drop_line"))
    seen = pages.filter("text IS NOT NULL").select(
        "host", F.xxhash64("text").alias("text_key"), F.explode(_line_hashes(F.col("text"))).alias("line"))
    hit = (seen.join(drop, F.col("host").eqNullSafe(F.col("drop_host")) & (F.col("line") == F.col("drop_line")))
           .groupBy(F.col("host").alias("hit_host"), F.col("text_key").alias("hit_key"))
           .agg(F.collect_set("line").alias("hit_lines")))
    hit = stage(hit, "line-hits")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       host.cast("string").alias("host"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    joined = rows.join(hit, F.col("host").eqNullSafe(F.col("hit_host"))
                       & (F.col("text_key") == F.col("hit_key")), "left")
    dropped = lambda line: F.array_contains("hit_lines", F.xxhash64(_bare(line)))
    kept = F.when(F.col("hit_lines").isNull(), F.col("text")).otherwise(F.array_join(F.filter(
        _lines(F.col("text")), lambda line: (_bare(line) == "") | ~dropped(line)), "\n"))
    full = F.filter(_lines(F.col("text")), lambda line: _bare(line) != "")
    n_dropped = F.when(F.col("hit_lines").isNull(), 0).otherwise(F.size(F.filter(full, dropped)))
    added = {"n_lines": F.coalesce(F.size(full), F.lit(0)).cast("bigint"),
             "n_dropped": n_dropped.cast("bigint"), text_col: kept}
    columns = [(added.pop(c) if c in added else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return joined.select(*columns, *[value.alias(name) for name, value in added.items()])
