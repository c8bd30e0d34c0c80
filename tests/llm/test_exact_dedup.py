import hashlib
import re

import numpy as np
from corpus import by_id, corpus, frame
from pyspark.sql import functions as F

from ledgerflow.llm import bloom
from ledgerflow.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    out = {}
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_matches_brute_force(spark):
    rows = corpus() + [(900, "a b"), (901, "ab"), (902, "a\tb "), (903, " a b")]
    got = by_id(exact_dedup(frame(spark, rows)))
    assert {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in got.items()} == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "x y"), (1, "x y"), (None, "x y"), (None, "only"), (None, "only")]
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup(frame(spark, rows)).collect())
    assert got == [(-1, -1, 2, False), (-1, -1, 2, True), (-1, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True)]


def test_empty_table_and_clashing_columns(spark):
    df = frame(spark, [(1, "a"), (2, "a")]).withColumn("h", F.lit("x")).withColumn("maybe", F.lit(3)).withColumn(
        "keep_id", F.lit(9))
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup(df).collect()) == [(1, 1), (2, 1)]
    assert exact_dedup(df.filter("false")).count() == 0


def test_bloom_never_misses_a_repeat(spark):
    rng = np.random.default_rng(3)
    single = rng.integers(-2**62, 2**62, 5000)
    twice = rng.integers(-2**62, 2**62, 700)
    values = np.concatenate((single, twice, twice))
    df = spark.createDataFrame([(int(v),) for v in values], "h bigint").repartition(5)
    once_map, twice_map = bloom.build(df, len(values))
    assert bloom.contains(twice_map, twice.view(np.uint64)).all()
    assert bloom.contains(once_map, values.view(np.uint64)).all()
    assert bloom.contains(twice_map, single.view(np.uint64)).mean() < 0.05
