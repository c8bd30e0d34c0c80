import random
import re

from corpus import LOWER, by_id, frame, sentence, vocabulary
from pyspark.sql import functions as F

from ledgerflow.llm.license_scan import BASE, STATEMENTS, license_scan, license_spans


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in BASE:
        q = phrase.split()
        for i in range(len(w) - len(q) + 1):
            if w[i:i + len(q)] == q:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def rows():
    rng = random.Random(2)
    vocab = vocabulary(rng) + ["license", "cc", "by", "mit", "gnu", "general", "public", "apache"] * 20
    out = [(i, sentence(rng, vocab, rng.randint(0, 300))) for i in range(80)]
    return out + [(100, None), (101, ""), (102, "!!!"), (103, "MIT License"), (104, "cc-by CC BY, cc\nby cc by"),
                  (105, "GNU GENERAL PUBLIC LICENSE gnu general public license"), (106, "mit"),
                  (107, "mit license " * 4000), (108, "word " * 200_000 + "cc by"), (109, "éMIT License mitélicense")]


def test_base_places_match_brute_force(spark):
    data = rows()
    got = by_id(license_scan(frame(spark, data)))
    assert {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for i, r in got.items()} == {
        i: brute(t) for i, t in data}
    assert all((r.score == 1.0) if r.n_base else 0 <= r.score <= 1 for r in got.values())


def test_statements_with_insertions_and_losses(spark):
    grant = STATEMENTS[0][0].split()
    noisy = grant[:5] + ["really"] + grant[5:9] + grant[10:]
    data = [(1, "Some text. " + " ".join(noisy) + " more."), (2, " ".join(grant[:6])), (3, "All Rights Reserved. " * 2),
            (4, "Licensed under CC BY-NC 4.0.")]
    got = by_id(license_scan(frame(spark, data)))
    assert got[1].labels == "mit" and 0.75 <= got[1].score < 1 and got[1].base_labels == ""
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "all-rights-reserved" and got[4].labels == "cc-by,cc-by-nc"
    spans = license_spans(frame(spark, data)).filter("template >= 0").orderBy("doc_id", "first_word").collect()
    assert [(s.first_word, s.last_word) for s in spans if s.doc_id == 3] == [(0, 2), (3, 5)]


def test_null_ids_repeats_clashes_and_empty(spark):
    df = frame(spark, [(None, "mit license"), (1, "cc by"), (1, "cc by"), (1, "other")]).withColumns(
        {"label": F.lit("x"), "template": F.lit(1), "gram": F.lit(2), "n_words": F.lit(0)})
    got = sorted((r.doc_id or -1, r.n_words, r.base_labels) for r in license_scan(df).collect())
    assert got == [(-1, 2, "mit"), (1, 1, ""), (1, 2, "cc-by"), (1, 2, "cc-by")]
    assert license_scan(df.filter("false")).count() == 0


def test_statement_next_to_a_chain_of_its_bigrams(spark):
    gpl, label = STATEMENTS[4]
    data = [(1, gpl), (2, gpl + " of the" * 40), (3, "of the " * 40 + gpl), (4, "of the " * 4000),
            (5, "of the " * 30 + gpl + " the terms of the gnu" * 30 + " x y z " + gpl)]
    got = by_id(license_scan(frame(spark, data)))
    assert [(got[i].labels, got[i].score) for i in (1, 2, 3, 4, 5)] == [
        (label, 1.0), (label, 1.0), (label, 1.0), ("", 0.0), (label, 1.0)]
    spans = {s.doc_id: (s.first_word, s.last_word) for s in license_spans(frame(spark, data[:3])).filter(
        "template >= 0 AND NOT base").collect()}
    n = len(gpl.split())
    assert spans == {1: (0, n - 1), 2: (0, n - 1), 3: (80, 79 + n)}
