import hashlib

import numpy as np
import public_tokenizers as vocab
import pytest
import tiktoken
from corpus import by_id, corpus, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import bpe

PATH = vocab.path("byte_bpe_multi_50k.tiktoken")
TOKENS = bpe.read_ranks(PATH)
CODEC = bpe.Codec(TOKENS, vocab.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)},
                              special_tokens={})


def ids(text):
    return np.frombuffer(CODEC.encode(text), dtype="<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_and_round_trip_of_any_text(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(np.array(ids(text), dtype="<u4")) == text.encode()


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    for text in ("word  and   more\n\n words " * 40, "x" * 400, "a  b  " * 60, " " * 300 + "end", "it's 12 's" * 30):
        assert ids(text) == REFERENCE.encode_ordinary(text)


def test_bounded_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 8)
    small = bpe.Codec(TOKENS, vocab.PATTERN)
    text = " ".join(f"word{i} again" for i in range(300)) + " " + "y" * 200
    for _ in range(3):
        assert np.frombuffer(small.encode(text), dtype="<u4").tolist() == REFERENCE.encode_ordinary(text)
    assert len(small.cache) <= 8 + 610


def test_operator_on_a_corpus(spark):
    rows = corpus() + [(None, "no id")]
    df = frame(spark, rows)
    encoded = bpe.encode_texts(df, PATH, vocab.PATTERN)
    got = by_id(encoded)
    for i, text in rows:
        assert got[i].ids == REFERENCE.encode_ordinary(text or "")
        assert got[i].n_tokens == len(got[i].ids)
    back = by_id(bpe.decode_ids(encoded, PATH, vocab.PATTERN))
    assert {i: bytes(r.decoded) for i, r in back.items()} == {i: (t or "").encode() for i, t in rows}
    sums = by_id(bpe.digests(encoded, PATH, vocab.PATTERN))
    for i, text in rows:
        want = np.array(REFERENCE.encode_ordinary(text or ""), dtype="<u4").tobytes()
        assert sums[i].ids_sha256 == hashlib.sha256(want).hexdigest()
        assert sums[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_texts(df.filter("false"), PATH, vocab.PATTERN).count() == 0


def test_kept_columns_and_null_ids(spark):
    df = frame(spark, [(1, "a b")]).selectExpr("doc_id", "text", "source AS ids_of", "lang AS tokens")
    row = bpe.encode_texts(df, PATH, vocab.PATTERN, keep=("doc_id", "ids_of", "tokens")).first()
    assert (row.ids_of, row.tokens, row.n_tokens) == ("s0", "en", 2)
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bytes(bpe.decode_ids(none, PATH, vocab.PATTERN).first().decoded) == b""


def test_rank_file_with_a_gap(tmp_path):
    bad = tmp_path / "gap.tiktoken"
    bad.write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(bad))
