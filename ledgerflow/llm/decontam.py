"""Benchmark decontamination by spaced-seed hashing (DataFrame operations only).

A seed is a window of words read through a fixed mask: the words at the
mask's cared-for positions are hashed, the others are ignored, so a
substitution at an ignored position does not hide the window.  The seeds
of every position of every benchmark item are joined with the seeds of
every position of the documents.  A hit fixes a diagonal (document
position minus item position); there the words of both texts are compared
one by one, and the best stretch (an agreeing word counts 1, a substituted
one -2) is accepted when it has ``MIN_AGREE`` agreeing words, or four
fifths of a shorter item's words.

Guarantee: an overlap is found when some window of it differs only at
positions that one of the masks ignores.  The mask 1110111 has its only
ignored position three words from either end, so a passage with
every fourth word substituted, or fewer, is always seeded; with every third
the score does not grow and nothing is accepted.  Items shorter than the shortest
mask are seeded whole, with a mask of their own length.

Words are runs of ASCII letters, digits and non-ASCII characters, all
lower-cased.

Scale: a window can only be hit where its first two words, which every
mask heeds, follow each other in some item.  A bitmap of the items' word
pairs (``MOST_BITS`` at most, part of the plan) tells that inside the row,
so seeds are made at those places only, and only they are exploded.  A large
benchmark fills the bitmap: more seeds are made, none is lost.  The
benchmark's seeds are broadcast behind a check of their number and joined
by shuffle beyond it, and so are the keys of the documents with hits; only
those documents are read a second time.  Diagonals are scored inside the
row of their document and item.  Texts of any length are compared whole.

Defined results: null or blank texts have no words and match nothing; null
ids are kept as they are.  Documents that agree in id and text are
reported once; equal benchmark items are each reported.  Other columns are
ignored.  An empty table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, stage, text_or_empty

# Spaced masks, 1 = the word counts, 0 = it is ignored.
MASKS = ("11011011", "1110010111", "1110111")
MIN_AGREE = 10
MISMATCH = -2
MOST_BITS = 1 << 20         # of the word pair bitmap
BROADCAST_SEEDS = 500_000   # rows of about 40 bytes
BROADCAST_KEYS = 100_000


def _words(text: Column) -> Column:
    return alnum_words(text, F.lower)


def _seed(hashes: Column, mask: str, i: Column) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(hashes, i + j) for j, c in enumerate(mask) if c == "1"])


def _seed_array(hashes: Column, mask: str) -> Column:
    """Seed of every window under the mask, in order of position."""
    last = F.size(hashes) - len(mask)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: _seed(hashes, mask, i))).otherwise(
        F.array().cast("array<bigint>"))


def _exploded_seeds(rows: DataFrame, masks: tuple[str, ...], keep: list[str]) -> DataFrame:
    """``keep`` + (at, seed): every seed of ``rows.words`` under every mask."""
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    seeds = F.concat(*[F.transform(_seed_array(F.col("hashes"), m), lambda s, i: F.struct(
        i.alias("at"), s.alias("seed"))) for m in masks])
    return hashed.select(*keep, F.inline(seeds))


def _pairs(hashes: Column) -> Column:
    """Hash of every two consecutive words."""
    last = F.size(hashes) - 2
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.get(hashes, i), F.get(hashes, i + 1)))).otherwise(F.array().cast("array<bigint>"))


def _pair_bitmap(items: DataFrame) -> tuple[Column, int]:
    """Constant array of 64-bit numbers with the bits of the items' word pairs, and the number of bits."""
    pairs = items.select(F.explode(_pairs(F.transform("words", lambda w: F.xxhash64(w)))).alias("pair")).distinct()
    bits = 1 << 12
    while bits < min(MOST_BITS, 16 * pairs.count()):
        bits *= 2
    slot = F.pmod("pair", F.lit(bits))
    rows = pairs.groupBy(F.floor(slot / 64).alias("at")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))).alias("word")).collect()
    words = ["0"] * (bits // 64)
    for row in rows:
        words[row["at"]] = str(row["word"])
    return F.split(F.lit(",".join(words)), ",").cast("array<bigint>"), bits


def _likely_seeds(rows: DataFrame, items: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` + (at, seed): seeds under MASKS at the places where an item's word pair stands."""
    bitmap, bits = _pair_bitmap(items)
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def listed(pair):
        slot = F.pmod(pair, F.lit(bits))
        word = F.get(bitmap, F.floor(slot / 64).cast("int"))
        return F.call_function("shiftright", word, (slot % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1

    places = F.filter(F.transform(_pairs(F.col("hashes")), lambda pair, i: F.when(listed(pair), i)),
                      lambda i: i.isNotNull())
    # No filter on the places: pushed below, it would split the text anew at every word.
    placed = hashed.select(*keep, "hashes", places.alias("places"))
    seeds = F.flatten(F.transform("places", lambda i: F.array(*[F.struct(i.alias("at"), F.when(
        i + len(m) <= F.size("hashes"), _seed(F.col("hashes"), m, i)).alias("seed")) for m in MASKS])))
    return placed.select(*keep, F.inline(F.filter(seeds, lambda s: s["seed"].isNotNull())))


def _bounded(df: DataFrame, most_rows: int) -> DataFrame:
    """Broadcast hint where the staged table is known to be small."""
    return F.broadcast(df) if df.count() <= most_rows else df


def _best_stretch(doc: Column, item: Column, diagonal: Column) -> Column:
    """struct(start, end, agree) of the best-scoring stretch, in item positions."""
    first = F.greatest(F.lit(0), -diagonal)
    last = F.least(F.size(item), F.size(doc) - diagonal) - 1
    zero = F.struct(*[F.lit(0).alias(n) for n in ("score", "start", "agree")],
                    *[F.lit(0).alias(n) for n in ("top", "top_start", "top_end", "top_agree")])

    def step(acc: Column, q: Column) -> Column:
        same = F.get(doc, q + diagonal) == F.get(item, q)
        fresh = acc["score"] <= 0
        score = F.greatest(acc["score"], F.lit(0)) + F.when(same, 1).otherwise(MISMATCH)
        start = F.when(fresh, q).otherwise(acc["start"])
        agree = F.when(fresh, 0).otherwise(acc["agree"]) + same.cast("int")
        better = score > acc["top"]
        pick = lambda new, old: F.when(better, new).otherwise(acc[old])
        return F.struct(score.alias("score"), start.alias("start"), agree.alias("agree"),
                        pick(score, "top").alias("top"), pick(start, "top_start").alias("top_start"),
                        pick(q + 1, "top_end").alias("top_end"),
                        pick(agree, "top_agree").alias("top_agree"))

    return F.aggregate(F.sequence(first, last), zero, step)


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """Verified overlaps: (doc_id, text_key, item_id, doc_start, item_start, n_words, n_agree, item_words).

    Starts and lengths count words; ``text_key`` is the 64-bit hash of the
    document's text, which tells rows that share an id apart.
    """
    items = stage(benchmark.select(F.col(item_col).alias("item_id"), _words(
        F.col(item_text_col)).alias("words")).filter(F.size("words") > 0), "bench-items")
    shortest = min(map(len, MASKS))
    short = sorted(r[0] for r in items.select(F.size("words").alias("n"))
                   .filter(F.col("n") < shortest).distinct().collect())   # fewer than a mask's length
    whole_masks = tuple("1" * n for n in short)
    # An item gets the short mask of its own length only.
    whole = F.size("words") < shortest
    seeds = [_exploded_seeds(items.filter(~whole), MASKS, ["item_id"])]
    seeds += [_exploded_seeds(items.filter(F.size("words") == n), ("1" * n,), ["item_id"]) for n in short]
    index = seeds[0]
    for more in seeds[1:]:
        index = index.unionByName(more)
    index = stage(index.withColumnRenamed("at", "item_at"), "bench-seeds")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_key"),
                       _words(F.col(text_col)).alias("words"))
    keys = ["doc_id", "text_key"]
    seeds = _likely_seeds(rows, items, keys)
    if whole_masks:
        seeds = seeds.unionByName(_exploded_seeds(rows, whole_masks, keys))
    hits = (seeds.join(_bounded(index, BROADCAST_SEEDS), "seed")
            .groupBy("doc_id", "text_key", "item_id").agg(
                F.collect_set(F.col("at") - F.col("item_at")).alias("diagonals")))
    hits = stage(hits, "bench-hits")

    keys = stage(hits.select("doc_id", "text_key").distinct(), "bench-keys")
    keys = _bounded(keys, BROADCAST_KEYS).withColumnsRenamed({"doc_id": "k1", "text_key": "k2"})
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                        F.xxhash64(text_or_empty(text_col)).alias("text_key"))
    found = texts.join(keys, F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("text_key") == F.col("k2")),
                       "left_semi").dropDuplicates(["doc_id", "text_key"])
    found = stage(found.select("doc_id", "text_key", _words(F.col("text")).alias("doc")), "bench-found")
    pairs = hits.withColumnsRenamed({"doc_id": "d1", "text_key": "d2"}).join(
        found, F.col("d1").eqNullSafe(F.col("doc_id")) & (F.col("d2") == F.col("text_key"))).join(
        items.withColumnsRenamed({"item_id": "i1", "words": "item"}), F.col("item_id").eqNullSafe(F.col("i1")))
    scored = F.transform("diagonals", lambda d: F.struct(
        d.alias("diagonal"), _best_stretch(F.col("doc"), F.col("item"), d).alias("b")))
    best = pairs.select("doc_id", "text_key", "item_id", F.size("item").alias("item_words"), F.inline(scored))
    needed = F.least(F.lit(MIN_AGREE), F.ceil(F.col("item_words") * 4 / F.lit(5)))
    return best.filter(F.col("b.top_agree") >= needed).select(
        "doc_id", "text_key", "item_id", (F.col("b.top_start") + F.col("diagonal")).alias("doc_start"),
        F.col("b.top_start").alias("item_start"),
        (F.col("b.top_end") - F.col("b.top_start")).alias("n_words"),
        F.col("b.top_agree").alias("n_agree"), "item_words")


def contaminated(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row per (doc_id, item_id): its longest verified overlap and the share of the item it covers."""
    spans = benchmark_overlaps(docs, benchmark, **names)
    best = F.max(F.struct("n_agree", (-F.col("doc_start")).alias("d"), "n_words", "item_start",
                          "item_words")).alias("b")
    return spans.groupBy("doc_id", "item_id").agg(best, F.count("*").alias("n_spans")).select(
        "doc_id", "item_id", "n_spans", (-F.col("b.d")).cast("bigint").alias("doc_start"),
        F.col("b.item_start").cast("bigint").alias("item_start"),
        F.col("b.n_words").cast("bigint").alias("n_words"),
        F.col("b.n_agree").cast("bigint").alias("n_agree"),
        (F.col("b.n_agree") / F.col("b.item_words")).alias("coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item, all columns as they are."""
    found = benchmark_overlaps(docs, benchmark, id_col, text_col)
    found = stage(found.select(F.col("doc_id").alias("__found_id"), F.col("text_key").alias("__found_key")).distinct(),
                  "bench-contaminated")
    return docs.join(_bounded(found, BROADCAST_KEYS), F.col(id_col).eqNullSafe(F.col("__found_id"))
                     & (F.xxhash64(text_or_empty(text_col)) == F.col("__found_key")), "left_anti")
