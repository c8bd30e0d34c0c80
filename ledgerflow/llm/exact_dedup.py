"""Exact deduplication by two passes over a Bloom filter.

Pass one hashes every whole text (white space removed) and marks the hash
in a two-level Bloom filter.  Pass two probes it: rows whose hash cannot
have occurred twice go straight to the result; only the rest are grouped,
on the full SHA-256 of the normalised text, so a false positive of the
filter costs a shuffled row and never a wrong answer.  Texts themselves
are never shuffled.

Defined results: a null text counts as empty.  Of equal texts the row with
the most code points stays, then the smallest id; a null id comes after
all others.  Rows repeated in full (same id, same text) all come back, one
of them kept.  Columns other than the id and the text are ignored.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import SPACES, stage, text_or_empty


def text_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, SHA-256, code points, 64-bit hash."""
    text = text_or_empty(text_col)
    bare = F.translate(text, SPACES, "")
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.sha2(bare.cast("binary"), 256).alias("text_sha256"),
                        F.char_length(text).alias("n_points"))
    return keyed.withColumn("h", F.xxhash64("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document."""
    spark = docs.sparkSession
    keys = stage(text_keys(docs, id_col, text_col), "exact-keys")
    _, twice = bloom.build(keys.select("h"), keys.count())
    probed = keys.withColumn("maybe", bloom.might_contain(spark, twice, F.col("h")))
    single = probed.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    rows = (probed.filter("maybe").groupBy("doc_id", "text_sha256", "n_points")
            .agg(F.count("*").alias("copies")))
    rows = stage(rows, "exact-maybe")
    best = rows.groupBy("text_sha256").agg(
        F.min(F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"),
                       F.col("doc_id").alias("c"))).alias("best"),
        F.sum("copies").alias("group_size"))
    best = stage(best, "exact-best")
    rows = rows.join(best, "text_sha256").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    stays = ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("best.c"))
             & (F.col("n_points") == -F.col("best.a")))
    shared = rows.select("doc_id", F.col("best.c").alias("keep_id"),
                         F.col("group_size").cast("bigint").alias("group_size"),
                         stays.alias("kept"), "text_sha256")
    return single.unionByName(shared)
