"""Near-duplicate detection on bottom-k sketches (MinHash, one hash function).

Every text becomes its set of distinct 5-word shingles, hashed once; the
``SKETCH`` smallest values are its sketch.

1. Documents with equal sets form a class; from here on a class is one
   representative, so thousands of copies cost one row.
2. Inverted lists: each retained value lists the classes that hold it.  Two
   sets of the threshold's similarity share far over ``OVERLAP_FLOOR`` of a sketch, so
   a class with fewer shared values than that is settled as unlinked.  The
   first ``LISTS`` values of the others make the lists that generate
   overlaps: (1 - threshold)**LISTS is the chance that a linked pair shares
   none.
3. Within a list every member is paired with the list's smallest member
   only.  The union of the two sketches estimates the similarity, pairs
   clearly below the threshold go, and the rest is verified on full sets.
   Verified links merge classes into components.
4. Lists whose members are still in different components are compared
   exactly: of the full sets, only the rarest shingles (a set may miss at
   most 1 - threshold of its shingles) index a document.  First every
   document is tried with the most central one of each of its index lists, the one
   whose shingles are held most often; in a large group of near copies that is the
   copy with the fewest changes of its own, so the group's links merge without
   being listed.  Then pairs in different components are made.  Pairs
   within one component are never made.
5. Both joins carry the parity bits of the whole sets: sets whose bits differ in
   more places than the threshold allows them members of their own can't be
   linked.  This is exact, and stops the pairs of a large group's members
   that are similar but not linked inside the join.

The threshold is an argument: ``PERCENT`` for op1, the pipeline's stages ask
for 80.  Components are exact up to the sketch bounds above (below 1e-8 a
pair from ``LEAST_PERCENT`` on; lower thresholds are refused).
Full sets are rebuilt only for classes found in shared lists, selected with
a bounded Bloom filter of their ids.

Defined results: a null or blank text has no shingles and links to
nothing.  Fewer than five words give one shingle, the whole sequence.  A
null id is never compared: its component is null and the row is kept.
Rows that repeat an id are one node.  Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import small_batches, stage, trimmed
from .components import components
from .texthash import documents, windows

SHINGLE = 5
PERCENT = 85
LEAST_PERCENT = 80
SKETCH = 48
LISTS = 16
OVERLAP_FLOOR = 0.40
ESTIMATE_SLACK = 37    # percent by which an estimate may lie below the threshold
SET_VALUES = 500_000   # shingles after which a task hands on its full sets
PARITY = 8             # 64-bit numbers of a set's parity bits

SIGNATURE = "doc_id bigint, n_shingles bigint, digest binary, sketch array<bigint>"
SETS = "rep bigint, n bigint, set array<bigint>, bits array<bigint>"


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct 63-bit shingle hashes of one text's word hashes."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    width = min(SHINGLE, len(hashes))
    return np.unique((windows(hashes, width) >> np.uint64(1)).astype(np.int64))


def parity_bits(values: np.ndarray) -> np.ndarray:
    """Whether each of 64 * ``PARITY`` residues has an odd number of a set's shingles."""
    odd = np.bincount(values % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").astype(np.int64)


def _lists_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for _, _, _, _, hashes in documents(batch.column(1), lower=True):
                values = shingle_set(hashes)
                sizes.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                               if len(values) else None)
                sketches.append(values[:SKETCH])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 _lists_array(sketches)], names=["doc_id", "n_shingles", "digest", "sketch"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(trimmed(run), SIGNATURE)


def full_sets(docs: DataFrame, wanted: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(rep, n, set, bits) of the documents whose id may be in the Bloom bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(bloom.contains(shared.value, ids.view(np.uint64))))
            held, first, size = [], 0, 0
            for row, _, _, _, hashes in documents(batch.column(1), lower=True):
                held.append(shingle_set(hashes))
                size += len(held[-1])
                if size >= SET_VALUES or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(held)),
                         pa.array([len(v) for v in held], pa.int64()), _lists_array(held),
                         _lists_array([parity_bits(v) for v in held])],
                        names=["rep", "n", "set", "bits"])
                    held, first, size = [], row + 1, 0

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .filter("doc_id IS NOT NULL").mapInArrow(trimmed(run), SETS))


def estimate_passes(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Union-sketch estimate: shared values among the smallest of the union."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return shared >= F.floor(F.size(union) * F.lit((percent - ESTIMATE_SLACK) / 100))


def sizes_pass(a: Column, b: Column, percent: int = PERCENT) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    side = lambda key: classes.select(F.col("rep").alias(key), F.col("n").alias(f"n_{key}"),
                                      F.col("sketch").alias(f"s_{key}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(sizes_pass(F.col("n_a"), F.col("n_b"), percent)
                    & estimate_passes(F.col("s_a"), F.col("s_b"), percent)).select("a", "b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    side = lambda key: sets.select(F.col("rep").alias(key), F.col("set").alias(f"f_{key}"))
    both = F.size(F.array_intersect("f_a", "f_b"))
    union = F.size("f_a") + F.size("f_b") - both
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(both * 100 >= union * percent).select("a", "b"))


def _lists(classes: DataFrame) -> DataFrame:
    """(v, rep, n): the first retained values of classes with enough shared ones."""
    values = classes.select("rep", "n", F.size("sketch").alias("k"),
                            F.posexplode("sketch").alias("at", "v"))
    often = stage(values.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1"), "near-often")
    shared = values.join(often, "v").groupBy("rep", "n", "k").agg(
        F.count("*").alias("shared"), F.collect_list(F.when(F.col("at") < LISTS, F.col("v"))).alias("vs"))
    enough = F.col("shared") >= F.greatest(F.lit(1), F.floor(F.col("k") * F.lit(OVERLAP_FLOOR)))
    return stage(shared.filter(enough).select("rep", "n", F.explode("vs").alias("v")), "near-lists")


def _star_pairs(lists: DataFrame) -> DataFrame:
    pivots = stage(lists.groupBy("v").agg(F.min("rep").alias("a"), F.count("*").alias("df"))
                   .filter("df > 1").select("v", "a"), "near-pivots")
    return (lists.join(pivots, "v").filter("a <> rep")
            .select("a", F.col("rep").alias("b")).distinct())


def _residual_index(lists: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(rep, n, bits, weight, left, h): documents of mixed lists by their rarest shingles.

    ``left`` is the most that a pair can still share when h is its first
    common shingle, ``weight`` tells how often a document's shingles are held.
    """
    named = lists.join(labels, lists["rep"] == labels["node"], "left").select(
        "v", "rep", F.coalesce("component", "rep").alias("c"))
    named = stage(named, "near-named")
    mixed = stage(named.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                  .filter("lo <> hi").select("v"), "near-mixed")
    open_docs = stage(named.join(mixed, "v").select("rep").distinct(), "near-open")
    rows = stage(sets.join(open_docs, "rep"), "near-open-sets")
    values = rows.select("rep", "n", "bits", F.explode("set").alias("h"))
    df = stage(values.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "near-df")
    # Shingles held by one document only come first in the order; they fill
    # the prefix without generating anything, so only their number counts.
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    shared = values.join(df, "h").groupBy("rep", "n", "bits").agg(
        F.array_sort(F.collect_list(F.struct("df", "h"))).alias("hs"), F.sum("df").alias("weight"))
    room = prefix - (F.col("n") - F.size("hs"))
    return stage(shared.filter(room > 0).select(
        "rep", "n", "bits", "weight", F.size("hs").alias("later"),
        F.posexplode(F.slice("hs", F.lit(1), room.cast("int"))).alias("at", "x"))
        .select("rep", "n", "bits", "weight", (F.col("later") - F.col("at")).alias("left"), "x.h"), "near-index")


def _may_link(percent: int) -> Column:
    """Whether index rows x and y of different components can be of a linked pair, exactly."""
    sizes = F.col("x.n") + F.col("y.n")
    apart = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(PARITY)), F.lit(0))
    return ((F.col("x.c") != F.col("y.c"))
            & (F.least("x.left", "y.left") * (100 + percent) >= sizes * percent)
            & (apart * (100 + percent) <= sizes * (100 - percent)))


def _labelled(index: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    return stage(index.join(labels, index["rep"] == labels["node"], "left").select(
        *index.columns, F.coalesce("component", "rep").alias("c")), name)


def _central_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Every document with the most central one of each of its index lists."""
    pivots = stage(index.groupBy("h").agg(
        F.max(F.struct("weight", "rep", "n", "left", "c", "bits")).alias("p"), F.min("c").alias("lo"),
        F.max("c").alias("hi")).filter("lo <> hi").select("h", "p.*"), "near-central")
    return (index.alias("x").join(pivots.alias("y"), F.col("x.h") == F.col("y.h")).filter(_may_link(percent))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())


def _cross_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that share one of their rarest shingles."""
    a, b = index.alias("x"), index.alias("y")
    return (a.join(b, F.col("x.h") == F.col("y.h"))
            .filter((F.col("x.rep") < F.col("y.rep")) & _may_link(percent))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())


def _merged(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components of nodes with labels and further links."""
    if links.isEmpty():
        return labels
    known = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return stage(components(known.unionByName(links)), name)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, repeated: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document.

    ``repeated``: rows repeat an id together with its text; such sets are compared once.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent {percent} is not in {LEAST_PERCENT}..100")
    small_batches(docs.sparkSession)
    signed = stage(signatures(docs, id_col, text_col), "near-signatures")
    named = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = stage(named.groupBy("digest", F.col("n_shingles").alias("n")).agg(
        F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "near-classes")

    lists = _lists(classes)
    members = lists.select("rep").distinct()
    wanted, _ = bloom.build(members, members.count())
    sets = full_sets(docs, wanted, id_col, text_col)
    sets = stage(sets.distinct() if repeated else sets, "near-sets")
    links = stage(_verified(_estimated(_star_pairs(lists), classes, percent), sets, percent), "near-links")
    labels = stage(components(links), "near-labels")
    index = _residual_index(lists, sets, labels, percent)
    central = _central_pairs(_labelled(index, labels, "near-labelled"), percent)
    labels = _merged(labels, stage(_verified(central, sets, percent), "near-core"), "near-core-labels")
    cross = _cross_pairs(_labelled(index, labels, "near-relabelled"), percent)
    found = _merged(labels, stage(_verified(cross, sets, percent), "near-more"), "near-components")

    # A class may be one node with another id of a repeated document.
    label = stage(classes.join(found, classes["rep"] == found["node"], "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")), "near-class-labels")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (signed.select("doc_id", "n_shingles", "digest").join(label, "digest", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")))


def text_groups(docs: DataFrame, text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(text_key, group) of every text that has an exact or near copy; the key is its 64-bit hash.

    A text that occurs once and has no near copy is left out.
    """
    key = F.xxhash64(text_col)
    texts = docs.select(key.alias("text_key"), F.col(text_col).alias("text"))
    keyed = stage(near_duplicates(texts, "text_key", percent=percent, repeated=True).groupBy(
        F.col("doc_id").alias("text_key"), F.col("component_id").alias("group"))
        .agg(F.count("*").alias("copies")), "near-texts")
    linked = keyed.filter(F.col("text_key") != F.col("group"))
    found = keyed.filter((F.col("text_key") != F.col("group")) | (F.col("copies") > 1)).select("text_key", "group")
    return stage(found.unionByName(linked.select(F.col("group").alias("text_key"), "group")).distinct(), "near-groups")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns as they are.

    Of rows that repeat a kept id, one stays.  Rows with a null id stay.
    Rows whose id can't be in a Bloom filter of the ids to drop pass
    straight through; only the others are shuffled to those ids.
    """
    judged = stage(near_duplicates(docs, id_col, text_col, percent).select(
        F.col("doc_id").alias("__judged_id"), "kept"), "near-judged")
    gone = stage(judged.filter(~F.col("kept")).select("__judged_id"), "near-gone")
    again = (judged.filter(F.col("kept") & F.col("__judged_id").isNotNull()).groupBy("__judged_id").count()
             .filter("count > 1").select("__judged_id"))
    same = F.col(id_col) == F.col("__judged_id")
    bitmap, _ = bloom.build(gone, gone.count())
    listed = bloom.might_contain(docs.sparkSession, bitmap, F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)))
    left = docs.filter(~listed).unionByName(docs.filter(listed).join(gone, same, "left_anti"))
    if again.isEmpty():
        return left
    again = stage(again, "near-again")
    one = left.join(again, same, "left_semi").dropDuplicates([id_col])
    return left.join(again, same, "left_anti").unionByName(one)
