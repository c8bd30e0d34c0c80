import hashlib
import random
from bisect import bisect_left
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerflow.llm import align
from tests.llm.corpus import corpus, frame

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    return first, second, align.a_bytes(first), align.b_bytes(second)


def plain(rows, tokenizers):
    """Whole texts, offsets in sets, links in a list."""
    first, second, a_raw, b_raw = tokenizers
    docs, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if b"".join(a_raw[i] for i in a) != whole or b"".join(b_raw[i] for i in b) != whole:
            a = b = []
        ends = []
        for ids, raw in ((a, a_raw), (b, b_raw)):
            at, own = 0, []
            for i in ids:
                at += len(raw[i])
                own.append(at)
            ends.append(own)
        shared = sorted(set(ends[0]) & set(ends[1]))
        owners = [bisect_left(shared, e) for own in ends for e in own]
        groups = [[[], []] for _ in shared]
        for (side, i), g in zip([(0, i) for i in a] + [(1, i) for i in b], owners):
            groups[g][side].append(i)
        at_end = [{e: i for i, e in zip(ids, own)} for ids, own in zip((a, b), ends)]
        links = [(at_end[0][e], at_end[1][e]) for e in shared]
        counts.update(links)
        docs.append((doc_id, len(a), len(b), groups, links))
    most = Counter()
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        said = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out


def check(spark, rows, tokenizers):
    found = align.align(frame(spark, rows), A, B).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(plain(rows, tokenizers), key=key)


def test_equals_plain_version(spark, tokenizers):
    check(spark, corpus(seed=3, n=90), tokenizers)


def test_odd_texts(spark, tokenizers):
    texts = ["", None, " ", "  ", "a ", " a", "a  b", "a\n  b", "a \n b", "\n", "\t x", "a  b", "a　b c", "▁", "a▁ b",
             "x ▁▁ y", "<s> </s> <|endoftext|> <0x41> <unk>", "\x00 \x1c \x85 b", "don't I'll  we've", "12345 1 2", "日本語 テスト",
             "👍🏽 ünï", "é é", "A" * 300, "a" + " " * 40 + "b", "\r\n\r\n x", "​ ﻿ x", "  x  y"]
    rng = random.Random(5)
    alphabet = ["a", "the", " ", " ", "  ", "\n", "\t", ".", "'s", "9", "é", "ß", "▁", " ", "漢", "🙂", "\x1d", "Th", "<s>"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(700)]
    rows = list(enumerate(texts)) + [(3, "again"), (3, "again"), (None, "no id here")]
    check(spark, rows, tokenizers)


def test_extra_columns_and_empty_table(spark, tokenizers):
    docs = frame(spark, [(1, "some text")]).selectExpr("*", "doc_id AS n_a", "text AS exact", "text AS pairs")
    assert [tuple(r) for r in align.align(docs, A, B).collect()] == plain([(1, "some text")], tokenizers)
    assert align.align(docs.limit(0), A, B).collect() == []


def test_bounded_memory_and_long_text(spark, tokenizers, monkeypatch):
    with open(A) as a, open(B, "rb") as b:
        aligner = align.Aligner(a.read(), b.read())
    monkeypatch.setattr(align, "UNITS", 50)
    rng = random.Random(1)
    long = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60_000))
    for text in (long, "y" * 20_000, long[:1000]):
        n_a, n_b, n_groups, digest, exact, pairs = aligner.text(text)
        found = plain([(1, text)], tokenizers)[0]
        assert (n_a, n_b, n_groups, digest) == (found[1], found[2], found[3], found[7])
        assert len(exact) // 2 + len(pairs) // 4 == n_groups
    assert len(aligner.units) <= 50 + 60_000     # new units of the last text at most


def test_linked_tokens_end_each_other(tokenizers):
    _, _, a_raw, b_raw = tokenizers
    same = align.identity_map(a_raw, b_raw)
    assert all(same[i] < 0 or a_raw[i] == b_raw[same[i]] for i in range(len(a_raw)))
    assert align.most_pairs(a_raw, b_raw) < 1_000_000


def test_units_are_shared_by_the_tasks_of_a_call(monkeypatch):
    monkeypatch.setattr(align, "_KEPT", {})
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        files = a.read(), b.read()
    first = align.kept_aligner("one", files)
    found = first.text("some words of a task")
    again = align.kept_aligner("one", files)
    assert again is first and again.text("some words of a task") == found
    monkeypatch.setattr(first, "_learn", lambda keys: pytest.fail("met before") if keys else {})
    assert again.text("words of some task a") != found
    other = align.kept_aligner("two", files)
    assert other is not first and not other.units and list(align._KEPT) == ["two"]
