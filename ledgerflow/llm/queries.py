"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align
from .bpe import digests, encode_texts
from .common import table
from .decontam import contaminated
from .exact_dedup import exact_dedup
from .license_scan import license_scan
from .line_dedup import drop_boilerplate
from .near_dedup import near_duplicates
from .ngram_join import ngram_components
from .phrases import collocations
from .substring_dedup import substring_dedup
from .toxicity import toxicity
from .url_filter import evaluate_urls, url_host
from .warc import roundtrip


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a fetch day derived from page_id (the table has none)."""
    day = F.date_add(F.to_date(F.lit("2024-01-01")), ((F.col("page_id") * 7919) % 366).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetch_day"))


def _list_entries(pages: DataFrame) -> DataFrame:
    """A dated list derived from ``pages``: hosts, parent domains, host + language.

    The first page of a pattern fixes its dates: every pattern is added, some
    are removed later, some of those added again.  Parents of two labels,
    which a third of all captures may match, are listed for nine days.
    """
    host = url_host(F.col("url"))
    language = F.regexp_extract("url", "^[a-z]+://[^/?#]*/([a-z][a-z])/", 1)
    patterns = pages.select("page_id", host.alias("host"), language.alias("language")).select(
        "page_id", F.explode(F.array(*[
            F.struct(pattern.alias("pattern"), F.lit(category).alias("category"))
            for category, pattern in (
                ("host", F.col("host")), ("section", F.concat_ws("/", "host", "language")),
                ("parent", F.regexp_replace("host", "^[^.]*[.]", "")))])).alias("p"))
    first = patterns.groupBy("p.pattern", "p.category").agg(F.min("page_id").alias("first"))
    start = F.date_add(F.to_date(F.lit("2024-01-01")), ((F.col("first") * 31) % 200).cast("int"))
    wide = ~F.col("pattern").like("%.%.%")
    events = F.array(*[
        F.when(when, F.struct(F.lit(action).alias("action"), F.date_add(start, after).alias("day")))
        for when, action, after in (
            (F.lit(True), "add", 0), (wide, "remove", 9), (~wide & (F.col("first") % 2 == 0), "remove", 45),
            (~wide & (F.col("first") % 4 == 0), "add", 90))])
    return (first.select("pattern", "category", F.explode(events).alias("e"))
            .filter("e IS NOT NULL").select("pattern", "category", "e.action", "e.day"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = _captures(spark, sf_dir)
    return evaluate_urls(captures, _list_entries(captures.select("page_id", "url")))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits text before merges."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    return digests(encode_texts(table(spark, sf_dir, "documents"), path, pattern), path, pattern)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = roundtrip(table(spark, sf_dir, "pages"))
    sound = F.when(F.col("error").isNull(), F.col("record_id")).otherwise(
        F.raise_error(F.concat(F.lit("unreadable record: "), F.col("error"))))
    page = lambda urn: F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda urn: F.nullif(page(urn), F.lit("")).cast("bigint")
    return records.select(number(sound).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number(F.col("refers_to")).alias("refers_to"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped",
                          F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


QUERIES = {
    "op11_phrase_mining": op11_phrase_mining,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_ngram_join": op13_ngram_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op3_warc": op3_warc,
    "op5_line_dedup": op5_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op6_license_scan": op6_license_scan,
    "op4_decontaminate": op4_decontaminate,
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op7_url_filter": op7_url_filter,
    "op10_exact_dedup": op10_exact_dedup,
}
