import random

import corpus_pipeline
import numpy as np
import pytest
from corpus import LOWER, by_id, corpus, frame, words
from pyspark.sql import functions as F

from ledgerflow.llm import near_dedup
from ledgerflow.llm.components import components
from ledgerflow.llm.near_dedup import drop_near_duplicates, near_duplicates


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_matches_brute_force(spark):
    rows = corpus(n=240)
    got = by_id(near_duplicates(frame(spark, rows)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute(rows)


def test_chain_of_links(spark):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):                       # neighbours link, the ends do not
        rows.append((i, " ".join(base[:4 * i] + [f"v{k}" for k in range(4 * i, 300)])))
    want = brute(rows)
    got = by_id(near_duplicates(frame(spark, rows)))
    assert {i: r.component_id for i, r in got.items()} == {i: w[1] for i, w in want.items()}
    assert len({w[1] for w in want.values()}) == 1


def test_null_ids_repeated_rows_and_clashes(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "A B C D E F G"), (None, "a b c d e f g"), (8, None), (9, " ")]
    df = frame(spark, rows).withColumn("component_id", F.lit(1)).withColumn("rep", F.lit(2))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [(-1, 3, None, True), (3, 3, 3, True), (5, 3, 3, False), (5, 3, 3, False), (8, 0, 8, True), (9, 0, 9, True)]
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 3, 8, 9]
    again = frame(spark, [(1, "q r s"), (1, "q r s"), (2, "other words here")])
    assert sorted(r.doc_id for r in drop_near_duplicates(again).collect()) == [1, 2]
    assert near_duplicates(df.filter("false")).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_threshold_of_the_pipeline(spark):
    def pair(first, n):                       # n shingles; two words of the copy changed, 10 shingles
        base = [f"p{first}w{i}" for i in range(n + 4)]
        copy = [*base]
        copy[20], copy[60] = "other", "others"
        return [(first, " ".join(base)), (first + 1, " ".join(copy))]

    rows = pair(0, 90) + pair(10, 89) + pair(20, 130)      # 80/100, 79/99, 120/140
    df = frame(spark, rows)
    left = dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, "")
    assert sorted(r.doc_id for r in left.collect()) == [0, 10, 11, 20]
    got = by_id(near_duplicates(df))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute(rows)
    assert [i for i in sorted(got) if got[i].kept] == [0, 1, 10, 11, 20]
    with pytest.raises(ValueError):
        near_duplicates(df, percent=79)


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    # Copies without some words of one text: a few are linked to it, most are similar only.
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 161):
        gone = set(rng.sample(range(150), rng.randint(1, 10)))
        rows.append((i, " ".join(w for k, w in enumerate(base) if k not in gone)))
    tried, verified = [], near_dedup._verified

    def counted(pairs, sets, percent):
        tried.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    got = by_id(near_duplicates(frame(spark, rows)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute(rows)
    # Without the stars, which make up to LISTS pairs a document.
    assert sum(tried[1:]) < len(rows)


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (1, 40, 900):
        a = np.unique(rng.integers(0, 1 << 62, size))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 62, size // 2)]))
        apart = sum(int(x).bit_count() for x in (near_dedup.parity_bits(a) ^ near_dedup.parity_bits(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
        assert not (near_dedup.parity_bits(a) ^ near_dedup.parity_bits(a)).any()


def test_copies_are_compared_once(spark, monkeypatch):
    # 30 rows of one text and 30 of a near copy are one link, not 900.
    text = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(text[i % 2:])) for i in range(60)]
    made, verified = [], near_dedup._verified

    def counted(pairs, sets, percent):
        found = verified(pairs, sets, percent)
        made.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "_verified", counted)
    groups = near_dedup.text_groups(frame(spark, rows)).collect()
    assert len(groups) == 2 and len({r["group"] for r in groups}) == 1
    assert max(made) == 1
