import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerflow.llm import phrases
from tests.llm.corpus import LOWER

DOCS = "doc_id bigint, text string, lang string"


def counts_of(rows):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    return counts


def brute(rows, top=2000):
    out = []
    for lang, f in counts_of(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < 10:
                continue
            inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731,B023
            if any(len(q) > len(p) and c >= 10 and 100 * c >= 50 * a and inside(q) for q, c in f.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, p, a, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), a, left, right, n, -score))
    return sorted(out)


def texts(seed, n, size=40):
    rng = random.Random(seed)
    vocab = ["the", "of", "New", "york", "é", "ß!", "a\x01b", "a", "ñandú", "x\x00", "\x01", "zz-top", " ", "日本"]
    glue = [" "] * 9 + ["\t", "  ", ". ", ", ", "\n", "\r\n", "; ", "? "]
    rows = []
    for i in range(n):
        text = "".join(rng.choices(vocab, range(len(vocab), 0, -1))[0] + rng.choice(glue) for _ in range(rng.randint(0, size)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, ""])))
    return rows


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    return sorted(map(tuple, phrases.collocations(docs, **more).collect()))


@pytest.mark.parametrize("top", [2000, 7])
def test_equals_brute_force(spark, top):
    rows = texts(1, 400)
    expected = brute(rows, top)
    assert len(expected) >= min(20, 2 * top) and found(spark, rows, top=top) == expected


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \t\n.,", "fr"), (None, "a b " * 12, "en"), (None, "a b " * 12, "en"),
            (4, "w" * 100_000 + " end", "en"), (5, "same " * 200_000, "xx")]
    assert found(spark, rows) == brute(rows)
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "lang AS part", "text AS phrase", "doc_id AS k")
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == brute(rows)
    assert phrases.collocations(docs.limit(0)).collect() == []


def merged(rows, monkeypatch, **bounds):
    """Counts of one task through tries, spills and merges at tiny bounds."""
    import pandas as pd

    for name, value in bounds.items():
        monkeypatch.setattr(phrases, name, value)
    counter = phrases.Counter(5)
    batches = []
    for _, text, lang in rows:
        batches += counter.enter("und" if lang is None else lang, (text or "").encode())
    batches += counter.finish()
    runs = pd.concat([b.to_pandas() for b in batches])
    frames = [phrases.merge_runs(g) for _, g in runs.groupby("part")]
    out = defaultdict(Counter)
    for f in frames:
        for r in f.itertuples():
            assert tuple(r.phrase.split(" ")) not in out[r.lang]
            out[r.lang][tuple(r.phrase.split(" ")) if r.k else ()] += r.f
    return out, len(batches)


def test_bursts_spills_and_slices_lose_nothing(monkeypatch):
    rows = texts(2, 200)
    expected = {lang: Counter({p: c for p, c in f.items() if c >= 10} | {(): sum(c for p, c in f.items() if len(p) == 1)})
                for lang, f in counts_of(rows).items()}
    for bounds in ({"BURST": 3, "ENTRIES": 60, "SLICE": 17}, {"WORDS": 6, "PIECE": 40}, {"BURST": 1, "SLICE": 1}):
        with monkeypatch.context() as patch:
            out, n = merged(rows, patch, **bounds)
        assert n > 3 and {k: v for k, v in out.items() if v} == {k: v for k, v in expected.items() if v[()]}


def test_score_is_exact(spark):
    values = [(10**15 - 1, 10**15 - 1, 10**15), (10, 10, 10), (123456789012345, 123456789012346, 999999999999999), (7, 11, 13)]
    rows = spark.createDataFrame(values, "a bigint, l bigint, r bigint").select(
        "a", "l", "r", phrases.floor_score(*map(lambda c: __import__("pyspark.sql.functions", fromlist=["col"]).col(c), "alr")).alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in rows.collect())


def test_a_task_spills_before_it_holds_much():
    # Nearly as many different triples as words: the trie is spilled on the way, and stays small.
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    counter, runs = phrases.Counter(4), 0
    for _ in range(8):
        text = " ".join(rng.choices(words, k=50_000)).encode()
        runs += sum(b.num_rows for b in counter.enter("en", text))
        assert counter.trie.entries <= 1 << 18
    assert runs


def test_rare_phrases_are_dropped_before_they_are_merged(monkeypatch):
    # Nearly all phrases are rare: only few are put together as text, and none of the frequent ones is missed,
    # even where a hash slot holds many phrases.
    rng = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.choices(words, k=60)) + " . so it goes", rng.choice(["en", ""])) for i in range(300)]
    expected = {lang: {p: c for p, c in f.items() if c >= 10} for lang, f in counts_of(rows).items()}
    for bits, most in ((22, 0.2), (10, 1), (3, 1)):
        with monkeypatch.context() as patch:
            merged_rows, slices = [], phrases._slices
            patch.setattr(phrases, "_slices", lambda runs: slices([merged_rows.append(len(r)) or r for r in runs]))
            out, _ = merged(rows, patch, SLOT_BITS=bits, ENTRIES=4000)
        assert {lang: {p: c for p, c in f.items() if p and c} for lang, f in out.items()} == expected
        if bits == 22:
            assert sum(merged_rows) < most * sum(len(f) for f in counts_of(rows).values())
