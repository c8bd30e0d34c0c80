"""Toxicity classifier: character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character 4- to 8-grams of the lower-cased text
with every run of other characters than letters as one blank, hashed into
``FEATURES`` slots.  The log-count ratio of every slot comes
from all labelled training rows, counted in Spark.  A logistic regression
on the ratios of the slots present is then fitted on at most ``FIT_ROWS``
training rows of each class, the ones with the smallest id hashes,
weighted back to the class totals.  Scoring is one pass over the texts
with the weight table (16 MB).  A text longer than ``WINDOW`` characters is
judged by all its windows of that size, half a window apart; the highest
score counts, so clean surroundings do not hide a toxic passage.

The constants were chosen by four-fold cross-validation within training
rows, never on held-out ones.

Only the slot counts (64 MB as bounded by ``FEATURES``) and the fitting sample's
informative slots reach the driver.  Texts of training rows are found
with a bounded Bloom filter of their ids, so that only those are shuffled
to their labels.

Defined results: texts of any length are read whole.  Rows that repeat an
id are scored each by its own text, and count each in training.  A null text counts as empty and scores the intercept.  Of
several labels of one document the largest counts; labels with a null id
or value are ignored.  Without labels of both classes the score is the
smoothed share of toxic rows.  A null doc_id scores by its text and is not
held out.  Columns other than id and text are never read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import local_rows, release_memory, small_batches, stage, trimmed

BITS = 22
FEATURES = 1 << BITS
BLOCK = 1 << 16        # slots of a row of partial counts
ORDERS = (4, 5, 6, 7, 8)
WINDOW = 2000          # characters
PIECE = 1 << 18        # characters hashed at a time
FIT_ROWS = 3000
LEAST_DOCS = 5         # training rows a slot must occur in
LEAST_Z = 3.0          # two-proportion z score of an informative slot
LEAST_RATIO = 0.5      # its least absolute log-count ratio
RIDGE = 0.2
ROUNDS = 200
THRESHOLD = 0.3
HELD_OUT_PART = 2      # of four, by crc32 of the id

_OTHER = re.compile(r"[\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_PART, F.lit(False))


def characters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, runs of other characters than letters as one blank."""
    bare = " " + _OTHER.sub(" ", (text or "").lower()) + " "
    return np.frombuffer(bare.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def grams(points: np.ndarray):
    """(start, slots) of the n-grams of each order: all those that begin in a piece, from ``start`` on."""
    for at in range(0, len(points), PIECE):
        piece = points[at:at + PIECE + max(ORDERS) - 1].astype(np.uint64)
        running = np.zeros(len(piece), dtype=np.uint64)
        for order in range(1, max(ORDERS) + 1):
            if len(piece) < order:
                break
            running = running[:len(piece) - order + 1]
            running = (running + piece[order - 1:]) * _MULTIPLIER
            running ^= running >> np.uint64(29)
            if order in ORDERS:
                yield at, (running[:PIECE] >> np.uint64(64 - BITS)).astype(np.int64)


def slots(text: str | None) -> np.ndarray:
    """Sorted distinct feature slots of one whole text."""
    points = characters(text)
    if len(points) <= PIECE:
        found = [held for _, held in grams(points)]
        return np.unique(np.concatenate([*found, np.empty(0, dtype=np.int64)]))
    seen = np.zeros(FEATURES, dtype=bool)
    for _, held in grams(points):
        seen[held] = True
    return np.flatnonzero(seen)


def telling(points: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, in order, and slots of the n-grams that are not 0 in ``table``."""
    places, held = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for at, found in grams(points):
        hit = np.flatnonzero(table[found])
        places.append(hit + at)
        held.append(found[hit])
    places, held = np.concatenate(places), np.concatenate(held)
    order = np.argsort(places, kind="stable")
    return places[order], held[order]


def margin(text: str | None, weights: np.ndarray, bias: float) -> float:
    """Log odds of one whole text: of its highest window."""
    points = characters(text)
    places, held = telling(points, weights)
    if len(points) <= WINDOW:
        return bias + float(weights[np.unique(held)].sum())
    starts = np.arange(0, len(points) - WINDOW // 2, WINDOW // 2)
    lows, highs = np.searchsorted(places, starts), np.searchsorted(places, starts + WINDOW)
    return bias + max(float(weights[np.unique(held[a:b])].sum()) for a, b in zip(lows, highs))


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, toxic) of the labelled rows that are not held out."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~is_held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.max("toxic").alias("toxic")))
    known = stage(known, "toxic-labels")
    wanted, _ = bloom.build(known.select("label_id"), known.count())
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    near = texts.filter("doc_id IS NOT NULL").filter(
        bloom.might_contain(docs.sparkSession, wanted, F.col("doc_id")))
    return near.join(known, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")


def _slot_counts(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(2, FEATURES) documents per slot and (2,) documents, by class.

    A task counts in one vector per class and hands on compressed blocks of
    them; blocks are added up in bunches of tasks, then over all.
    """
    def run(batches):
        counts, rows = np.zeros((2, FEATURES), dtype=np.int32), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[int(toxic > 0), slots(text.as_py())] += 1
                rows[int(toxic > 0)] += 1
        task = bloom.task_number()
        for block in range(FEATURES // BLOCK if sum(rows) else 0):
            body = counts[:, block * BLOCK:(block + 1) * BLOCK].astype("<i8").tobytes()
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int32()), "task": pa.array([task], pa.int32()),
                "neg": pa.array([rows[0]], pa.int64()), "pos": pa.array([rows[1]], pa.int64()),
                "counts": pa.array([zlib.compress(body, 1)], pa.binary())})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(2 * BLOCK, dtype="<i8")
        for body in frame["counts"]:
            total += np.frombuffer(zlib.decompress(body), dtype="<i8")
        return pd.DataFrame({"block": frame["block"].iloc[:1], "task": frame["task"].iloc[:1],
                             "neg": [frame["neg"].sum()], "pos": [frame["pos"].sum()],
                             "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "block int, task int, neg bigint, pos bigint, counts binary"
    parts = training.select("text", "toxic").mapInArrow(trimmed(run), schema)
    parts = parts.groupBy("block", F.floor(F.col("task") / bloom.MERGE_FAN_IN).alias("bunch")).applyInPandas(add, schema)
    counts, rows = np.zeros((2, FEATURES), dtype=np.float32), np.zeros(2)
    for row in local_rows(parts.groupBy("block").applyInPandas(add, schema)):
        block = np.frombuffer(zlib.decompress(row["counts"]), dtype="<i8").reshape(2, BLOCK)
        counts[:, row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = block
        rows[:] = row["neg"], row["pos"]
    return counts, rows


def log_ratios(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log-count ratio per slot; 0 where the slot does not tell the classes apart.

    A block of slots at a time: the driver, which calls this, holds no other array of all slots.
    """
    ratios = np.empty(counts.shape[1], dtype=counts.dtype)
    for at in range(0, len(ratios), BLOCK):
        own = counts[:, at:at + BLOCK]
        share = ((own + 1) / (rows[:, None] + 2)).astype(counts.dtype)
        ratio = np.log(share[1] / share[0])
        both = (own.sum(axis=0) + 1) / (rows.sum() + 2)
        z = (share[1] - share[0]) / np.sqrt(both * (1 - both) * (1 / (rows[0] + 2) + 1 / (rows[1] + 2)))
        telling = (own.sum(axis=0) >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z) & (np.abs(ratio) >= LEAST_RATIO)
        ratios[at:at + BLOCK] = np.where(telling, ratio, 0.0)
    return ratios


def _fit_sample(training: DataFrame, ratios: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    """Informative slots, as bytes, of at most FIT_ROWS rows of each class.

    A share of the ids' hashes a little over the bound is turned into slots
    where the rows are; only those compact rows meet the exact bound.
    """
    useful = training.sparkSession.sparkContext.broadcast(ratios != 0)

    def run(batches):
        for batch in batches:
            found = [np.unique(telling(characters(t.as_py()), useful.value)[1]) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2),
                 pa.array([s.astype("<i4").tobytes() for s in found], pa.binary())],
                names=["toxic", "h", "slots"])

    toxic = F.col("toxic") > 0
    near = [int(min(1.0, 1.2 * FIT_ROWS / n) * (1 << 32)) for n in rows]
    chosen = (training.select("text", "toxic", F.xxhash64("doc_id").alias("h"))
              .filter(F.pmod("h", F.lit(1 << 32)) < F.when(toxic, near[1]).otherwise(near[0]))
              .mapInArrow(trimmed(run), "toxic int, h bigint, slots binary"))
    chosen = stage(chosen, "toxic-sample")
    order = [F.pmod("h", F.lit(1 << 32)), F.col("h")]
    parts = [chosen.filter(c).orderBy(*order).limit(FIT_ROWS) for c in (~toxic, toxic)]
    return parts[0].unionByName(parts[1]).toPandas()


def _numbered(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct slots, and the place of each of ``held`` among them."""
    seen = np.zeros(FEATURES, dtype=bool)
    seen[held] = True
    columns = np.flatnonzero(seen)
    place = np.zeros(FEATURES, dtype=np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    return columns, place[held]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
        ) -> tuple[np.ndarray, float]:
    """(weight per slot, intercept) of the classifier."""
    small_batches(docs.sparkSession)
    training = stage(_training(docs, labels, id_col, text_col), "toxic-training")
    counts, rows = _slot_counts(training)
    prior = float(np.log((rows[1] + 1) / (rows[0] + 1)))
    if not rows.all():
        return np.zeros(FEATURES, dtype=np.float32), prior
    ratios = log_ratios(counts, rows)
    del counts
    sample = _fit_sample(training, ratios, rows)
    y = (sample["toxic"].to_numpy() > 0).astype(float)
    sizes = sample["slots"].str.len().to_numpy(dtype=np.int64) // 4
    owner = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    columns, where = _numbered(np.frombuffer(b"".join(sample["slots"]), dtype="<i4"))
    del sample
    value = ratios[columns]
    del ratios
    weight = np.where(y > 0, rows[1] / max(1, y.sum()), rows[0] / max(1, (1 - y).sum()))
    weight /= weight.sum()
    theta, bias = np.full(len(columns), 0.1), prior
    moment, square = np.zeros(len(columns) + 1), np.zeros(len(columns) + 1)
    for step in range(1, ROUNDS + 1):   # Adam on the weighted logistic loss
        odds = bias + np.bincount(owner, (theta * value)[where], len(y))
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y)
        slope = np.bincount(where, error[owner], len(columns)) * value + RIDGE / len(y) * theta
        slope = np.append(slope, error.sum())
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope ** 2
        move = 0.02 * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-10)
        theta, bias = theta - move[:-1], bias - move[-1]
    weights = np.zeros(FEATURES, dtype=np.float32)
    weights[columns] = theta * value
    del owner, where, odds, error, slope
    release_memory()
    return weights, float(bias)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            margins = np.array([margin(t.as_py(), weights, bias) for t in batch.column(2)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(1 / (1 + np.exp(-np.clip(margins, -30, 30))), pa.float64())],
                names=["doc_id", "held_out", "score"])

    doc_id = F.col(id_col).cast("bigint")
    return (docs.select(doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"),
                        F.col(text_col).alias("text"))
            .mapInArrow(trimmed(run), "doc_id bigint, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below the threshold.

    Only texts go to Python, and only one boolean each comes back.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    edge = float(np.log(threshold / (1 - threshold)))

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        return pa.array([margin(t.as_py(), weights, bias) < edge for t in texts], pa.bool_())

    return docs.filter(clean(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
