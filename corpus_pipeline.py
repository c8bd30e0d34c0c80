"""The corpus pipeline: documents in, checked token ids out.

Five stages, each over everything its predecessor kept, in this order:
toxic documents go, boilerplate lines go (a group of near copies counts as
one page there, so that none of its lines goes for the copies), one document of each group of
near duplicates stays, documents that overlap a benchmark item go, and the
rest is encoded (and decoded again for the check sums).  All stages but
the last return the columns of ``documents``.

Edge cases are those of the operators: null texts are empty texts, rows
with a null doc_id pass the near-duplicate stage, of rows that repeat a
doc_id that stage keeps one, extra columns pass through up to the last
stage, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import bpe, decontam, line_dedup, near_dedup, toxicity
from ledgerflow.llm.common import stage, table
from ledgerflow.llm.queries import vocabulary

NEAR_PERCENT = 80   # documents of this similarity and more are near duplicates


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(docs, groups=near_dedup.text_groups(docs, percent=NEAR_PERCENT))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids are staged between their two Python steps: one task with both holds two Python workers, which stay."""
    path, pattern = vocabulary()
    return bpe.digests(stage(bpe.encode_texts(docs, path, pattern), "pipeline-ids"), path, pattern, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

# The classifier and the sketches are not expressible in SQL; tests/llm
# holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
