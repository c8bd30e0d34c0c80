import hashlib
import random

import pytest
from corpus import by_id, corpus, frame, sentence, vocabulary, words
from pyspark.sql import functions as F

from ledgerflow.llm import substring_dedup as sd


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - sd.WINDOW + 1):
            window = tuple(w[k:k + sd.WINDOW])
            if window in seen:
                gone[k:k + sd.WINDOW] = [True] * sd.WINDOW
            seen.add(window)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def result(df):
    return {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in by_id(df).items()}


def repeats(seed):
    """Passages of 15 to 80 words at every offset, within and across texts."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    shared = [sentence(rng, vocab, rng.randint(15, 80)).split() for _ in range(12)]
    rows = []
    for i in range(150):
        parts = sentence(rng, vocab, rng.randint(0, 70)).split()
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            a = rng.randint(0, max(0, len(piece) - 19))
            parts += piece[a:a + rng.randint(10, 80)] + sentence(rng, vocab, rng.randint(1, 30)).split()
        rows.append((i * 3, " ".join(parts)))
    return rows


@pytest.mark.parametrize("chunk", [200, 2 << 20])
def test_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(sd, "CHUNK", chunk)
    rows = corpus() + [(i + 1000, t) for i, t in repeats(4)] + [(5000, "a b c d e " * 300)]
    assert result(sd.substring_dedup(frame(spark, rows))) == brute(rows)


def test_small_flushes_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(sd, "FLUSH", 50)
    monkeypatch.setattr(sd, "LEAST_BUCKETS", 3)
    rows = repeats(9)
    assert result(sd.substring_dedup(frame(spark, rows))) == brute(rows)


def test_ties_null_ids_clashes_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = frame(spark, [(4, text), (4, text), (None, text), (7, None)]).withColumns(
        {"chunk": F.lit(1), "body": F.lit("b"), "bucket": F.lit(2)})
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in sd.substring_dedup(df).collect())
    assert got == [(-1, 25, 25), (4, 25, 0), (4, 25, 0), (7, 0, 0)]
    assert sd.substring_dedup(df.filter("false")).count() == 0
