"""The corpus pipeline against plain-Python versions of its stages."""
import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from corpus import DOCS, frame, sentence, vocabulary
from pyspark.sql import functions as F
from test_bpe import REFERENCE
from test_line_dedup import brute as line_brute
from test_near_dedup import brute as near_brute

from ledgerflow.llm import toxicity as tox

BAD = ("grumblefink", "snorkwat", "vilepox")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents, labels and benchmark, and the rows in it."""
    rng = random.Random(11)
    vocab = vocabulary(rng, 500)
    items = [(i, sentence(rng, vocab, rng.randint(15, 40))) for i in range(8)]
    docs, labels = [], []
    base = sentence(rng, vocab, 120)
    for i in range(700):
        parts = sentence(rng, vocab, rng.randint(30, 150)).split()
        if i % 9 == 1:                                   # near copies of one text
            parts = base.split()
            parts[rng.randrange(120)] = rng.choice(vocab)
        toxic = i % 7 == 3
        for _ in range(4 * toxic):
            parts.insert(rng.randrange(len(parts)), rng.choice(BAD))
        text = " ".join(parts)
        if i % 13 == 5:
            text += "\n" + items[i % 8][1]
        if i % 3 == 0:
            text = "Read more here\n" + text
        docs.append((i, text, f"s{i % 2}"))
        labels.append((i, 1, int(toxic)))
    docs += [(900, None, "s0"), (901, "", "s1"), (902, " \n ", None), (903, docs[0][1], "s0"), (None, "no id here", "s1")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


def test_stages_one_after_the_other(spark, tables):
    folder, docs, items = tables
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "encode"]
    table = spark.read.parquet(f"{folder}/documents.parquet")
    weights, bias = tox.fit(table, spark.read.parquet(f"{folder}/labels.parquet"))

    got = steps["toxicity"](spark, table, folder)
    margin = lambda t: tox.margin(t, weights, bias)
    want = [d for d in docs if 1 / (1 + np.exp(-margin(d[1]))) < 0.3]
    assert got.columns == table.columns and rows_of(got) == sorted(want, key=str)
    kept = {d[0] for d in want}
    assert sum(d[0] not in kept for d in docs) == pytest.approx(100, abs=3)
    assert all(d[0] in kept for d in docs if not any(b in (d[1] or "") for b in BAD))

    got = steps["line_dedup"](spark, frame(spark, want), folder)
    cleaned = line_brute(want)
    want = [(i, cleaned[i][0], s) for i, _, s in want]
    assert got.columns == table.columns and rows_of(got) == sorted(want, key=str)
    assert not any("Read more here" in (t or "") for _, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None)

    got = steps["near_dedup"](spark, frame(spark, want), folder)
    judged = near_brute([d[:2] for d in want if d[0] is not None])
    want = [d for d in want if d[0] is None or judged[d[0]][2]]
    assert got.columns == table.columns and rows_of(got) == sorted(want, key=str)

    got = steps["decontaminate"](spark, frame(spark, want), folder)
    want = [d for d in want if not any(text in (d[1] or "") for _, text in items)]
    assert got.columns == table.columns and rows_of(got) == sorted(want, key=str)

    got = {r.doc_id: r for r in steps["encode"](spark, frame(spark, want), folder).collect()}
    assert set(got) == {d[0] for d in want}
    for i, text, _ in want:
        assert got[i].ids == REFERENCE.encode_ordinary(text or "") and got[i].n_tokens == len(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()

    final = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert final == {i: r.ids for i, r in got.items()}


def test_empty_documents_and_extra_columns(spark, tables):
    folder, docs, _ = tables
    few = frame(spark, docs[:40]).withColumns({c: F.lit(1) for c in ("score", "kept", "n_dropped", "host", "words", "ids")})
    empty = spark.createDataFrame([], DOCS)
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, few, folder)
        assert name == "encode" or out.columns == few.columns
        assert 0 < out.count() <= 40
        assert step(spark, empty, folder).count() == 0


def test_copies_do_not_make_their_own_lines_boilerplate(spark, tables):
    folder, _, _ = tables
    rng = random.Random(4)
    vocab = vocabulary(rng, 500)
    body = lambda: [sentence(rng, vocab, 12) for _ in range(12)]
    exact, near = body(), body()
    docs = []
    for i in range(90):
        lines = (exact, list(near), body())[i % 3]
        if i % 3 == 1 and i > 1:                          # one word of one line differs
            parts = lines[i % 12].split()
            parts[i % 7] = f"only{i}"
            lines[i % 12] = " ".join(parts)
        docs.append((i, "\n".join([*lines, "Terms and privacy"] if i % 3 == 2 else lines), "s0"))
    docs += [(200, None, "s0"), (201, None, "s0"), (202, "\n".join(exact), "s1")]
    steps = dict(corpus_pipeline.STAGES)
    cleaned = steps["line_dedup"](spark, frame(spark, docs), folder)
    want = [(i, t and t.replace("\nTerms and privacy", ""), s) for i, t, s in docs]
    assert rows_of(cleaned) == sorted(want, key=str)
    left = {r.doc_id: r.text for r in steps["near_dedup"](spark, cleaned, folder).collect()}
    assert set(left) == {0, 1, 200, 201} | set(range(2, 90, 3))
    assert left[0] == "\n".join(exact) and left[1] == "\n".join(near)


def test_no_task_of_the_last_stage_holds_two_python_workers(spark, tables):
    """Python workers stay for later stages, so a task with two Python steps doubles their memory for all."""
    folder, docs, _ = tables
    encoded = corpus_pipeline.encode(spark, frame(spark, docs[:40]), folder)
    plan = encoded._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1 and encoded.count() == 40
