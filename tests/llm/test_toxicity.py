import random
import zlib

import numpy as np
import pytest
from corpus import by_id, frame, sentence, vocabulary
from pyspark.sql import functions as F

from ledgerflow.llm import toxicity as tox

LABELS = "doc_id bigint, quality int, toxic int"
BAD = ("grumblefink", "snorkwat", "vilepox", "drabscum")


def labelled(n=1200, seed=1):
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    rows, labels = [], []
    for i in range(n):
        parts = sentence(rng, vocab, rng.randint(20, 200)).split()
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 5) * toxic):
            parts.insert(rng.randrange(len(parts)), rng.choice(BAD))
        rows.append((i, " ".join(parts)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    return docs, labels, tox.fit(docs, spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    truth = {i: t for i, _, t in labels}
    got = by_id(tox.score(docs, model))
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 200
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98


def test_labels_of_held_out_rows_are_not_learnt(spark, fitted):
    docs, labels, model = fitted
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    again = tox.fit(docs, spark.createDataFrame(flipped, LABELS))
    assert np.allclose(again[0], model[0]) and again[1] == pytest.approx(model[1])


def test_drop_toxic_keeps_columns(fitted):
    docs, labels, model = fitted
    clash = docs.withColumns({"score": F.lit(5), "toxic": F.lit("x"), "held_out": F.lit(1)})
    left = tox.drop_toxic(clash, model)
    assert left.schema == clash.schema
    gone = {i for i, r in by_id(tox.score(docs, model)).items() if r.predicted}
    assert {r.doc_id for r in left.collect()} == {i for i, _, _ in labels} - gone


def test_odd_rows(spark, fitted):
    _, _, model = fitted
    rows = [(1, None), (2, ""), (2, ""), (None, "vilepox"), (4, "z" * 3_000_000 + " vilepox snorkwat grumblefink")]
    got = sorted((r.doc_id or -1, r.held_out, r.predicted) for r in tox.score(frame(spark, rows), model).collect())
    assert [(g[0], g[2]) for g in got] == [(-1, 1), (1, 0), (2, 0), (2, 0), (4, 1)] and got[0][1] is False
    assert tox.score(frame(spark, rows).filter("false"), model).count() == 0


def test_without_usable_labels(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(20)])
    for labels in ([], [(i, 1, 0) for i in range(20)], [(None, 1, 1), (3, 1, None)]):
        got = tox.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 20 and len({round(r.score, 9) for r in got}) == 1


def test_pieces_of_a_long_text_give_all_slots(monkeypatch):
    rng = random.Random(4)
    text = sentence(rng, vocabulary(rng), 900) + " 12 ## É"
    whole, points = tox.slots(text), tox.characters(text)
    grams = {tuple(points[i:i + n]) for n in tox.ORDERS for i in range(len(points) - n + 1)}
    assert 0.99 * len(grams) <= len(whole) <= len(grams)
    table = np.zeros(tox.FEATURES, dtype=np.float32)
    table[whole[::3]] = 1
    places, held = tox.telling(points, table)
    assert set(held) == set(whole[::3]) and (np.diff(places) >= 0).all()
    monkeypatch.setattr(tox, "PIECE", 97)
    assert (tox.slots(text) == whole).all()
    again = tox.telling(points, table)
    assert sorted(zip(places, held)) == sorted(zip(*again))


def test_margin_is_that_of_the_highest_window():
    rng = random.Random(6)
    text = sentence(rng, vocabulary(rng), 2000)
    points, half = tox.characters(text), tox.WINDOW // 2
    weights = np.zeros(tox.FEATURES, dtype=np.float32)
    some = tox.slots(text)[::5]
    weights[some] = np.random.default_rng(1).normal(size=len(some))
    best = -1e9
    for at in range(0, len(points) - half, half):
        held = set()
        # An n-gram belongs to the windows that hold its start.
        own = points[at:at + tox.WINDOW + max(tox.ORDERS) - 1]
        for _, found in tox.grams(own):
            held.update(found[:tox.WINDOW].tolist())
        best = max(best, float(weights[sorted(held)].sum()))
    assert len(points) > 2 * tox.WINDOW and tox.margin(text, weights, 0.5) == pytest.approx(best + 0.5, abs=1e-3)


def test_counts_and_ratios_match_brute_force(spark):
    rows, labels = labelled(60)
    training = spark.createDataFrame([(i, t, k) for (i, t), (_, _, k) in zip(rows, labels)],
                                     "doc_id bigint, text string, toxic int").repartition(3)
    counts, sizes = tox._slot_counts(training)
    expected = np.zeros_like(counts)
    for (_, text), (_, _, toxic) in zip(rows, labels):
        expected[toxic, tox.slots(text)] += 1
    assert (counts == expected).all() and sizes.tolist() == [50, 10]
    share = (expected + 1) / np.array([[52], [12]])
    ratios = tox.log_ratios(counts, sizes)
    held = ratios != 0
    assert held.any() and np.allclose(ratios[held], np.log(share[1] / share[0])[held], atol=1e-5)


def test_toxic_text_between_clean_ones(spark, fitted):
    docs, labels, model = fitted
    rng = random.Random(8)
    truth, texts = {i: t for i, _, t in labels}, {r.doc_id: r.text for r in docs.collect()}
    clean = [texts[i] for i, t in truth.items() if not t]
    mixed = [(i, " ".join([*rng.sample(clean, 15), texts[i], *rng.sample(clean, 15)]))
             for i, t in truth.items() if t][:60]
    plain = [(10_000 + k, " ".join(rng.sample(clean, 31))) for k in range(60)]
    got = by_id(tox.score(frame(spark, mixed + plain), model))
    assert sum(got[i].predicted for i, _ in mixed) >= 57
    assert sum(got[i].predicted for i, _ in plain) <= 3
