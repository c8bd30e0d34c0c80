"""Fixtures and brute-force versions for the corpus operators."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def sentence(rng, vocab, n):
    return " ".join(rng.choice(vocab) for _ in range(n))


def corpus(seed=7, n=120):
    """Texts with exact copies, near copies, shared passages and odd rows."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    passage = sentence(rng, vocab, 30)
    base = sentence(rng, vocab, 150)
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            text = sentence(rng, vocab, rng.randint(1, 120))
        elif kind == 1:
            text = sentence(rng, vocab, 40) + "\n" + passage + "\n" + sentence(rng, vocab, rng.randint(5, 60))
        elif kind in (2, 3):                       # near copies, from one word changed to many
            parts = base.split()
            for _ in range(rng.choice((0, 1, 2, 3, 5, 9))):
                parts[rng.randrange(len(parts))] = rng.choice(vocab)
            text = " ".join(parts)
        elif kind == 4:
            text = rng.choice(texts) if texts else ""
        else:
            text = sentence(rng, vocab, 4).upper()
        texts.append(text)
    texts += [None, "", "   \n\t ", "one", "One", "a b c", "x" * 5000, " ".join(["same"] * 3000),
              sentence(rng, vocab, 20_000), "a  b\tc\x0b\x0cd\re", "👍🏽 ünï cödé   end"]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    """The documents table of (doc_id, text[, source]) rows."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
