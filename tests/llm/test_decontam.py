import random

from corpus import frame, sentence, vocabulary
from pyspark.sql import functions as F

from ledgerflow.llm.decontam import MIN_AGREE, benchmark_overlaps, contaminated, drop_contaminated

UPPER = str.maketrans("abcdeéñ", "ABCDEÉÑ")
ITEMS = "item_id bigint, text string"


def planted(seed=5):
    """(docs, items, pairs that must be found): whole, part and substituted passages."""
    rng = random.Random(seed)
    vocab = vocabulary(rng, 600)
    items = [(i, sentence(rng, vocab, rng.randint(15, 50))) for i in range(30)]
    items += [(100, "Short item of five"), (101, None), (102, ""), (103, items[0][1]), (104, "one")]
    docs, found = [], set()
    for i in range(200):
        text = sentence(rng, vocab, rng.randint(0, 80))
        if i % 4 == 0:
            item, body = items[rng.randrange(30)]
            parts = body.split()
            how = i % 3
            if how == 1:
                at = rng.randint(0, len(parts) - 14)
                parts = parts[at:at + rng.randint(14, 30)]
            elif how == 2:
                for k in range(rng.randint(0, 5), len(parts), 7):       # every seventh word replaced
                    parts[k] = "zzzz" + parts[k]
            text = text + " -- " + ", ".join(parts).translate(UPPER) + "! " + sentence(rng, vocab, 20)
            found.add((i, item))
            if item == 0:
                found.add((i, 103))
        docs.append((i, text))
    docs += [(900, None), (901, " "), (902, "a SHORT, item of five here"), (903, "one"), (None, items[3][1])]
    found |= {(902, 100), (903, 104), (None, 3)}
    return docs, items, found


def test_finds_all_planted_and_nothing_else(spark):
    docs, items, want = planted()
    df, bench = frame(spark, docs), spark.createDataFrame(items, ITEMS)
    got = contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    for r in got:
        assert r.n_agree >= min(MIN_AGREE, 0.8 * len(dict(items)[r.item_id].split())) and 0 < r.coverage <= 1
    left = drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    from ledgerflow.llm import decontam

    docs, items, want = planted(8)
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_KEYS", 0)
    got = contaminated(frame(spark, docs), spark.createDataFrame(items, ITEMS))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_span_positions(spark):
    item = " ".join(f"i{k}" for k in range(20))
    text = "lead in words " + item.replace("i7", "x7") + " tail"
    row = benchmark_overlaps(frame(spark, [(1, text)]), spark.createDataFrame([(9, item)], ITEMS)).first()
    assert (row.doc_start, row.item_start, row.n_words, row.n_agree, row.item_words) == (3, 0, 20, 19, 20)


def test_empty_tables_and_clashing_columns(spark):
    docs, items, _ = planted()
    df, bench = frame(spark, docs[:8]), spark.createDataFrame(items, ITEMS)
    assert contaminated(df, bench.filter("false")).count() == 0
    assert contaminated(df.filter("false"), bench).count() == 0
    clash = df.withColumns({"item_id": F.lit(1), "seed": F.lit(2), "at": F.lit(3), "words": F.lit(4)})
    found = {(r.doc_id, r.item_id) for r in contaminated(clash, bench.withColumn("doc_id", F.lit(5))).collect()}
    assert found == {(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()}
    assert drop_contaminated(clash, bench).columns == clash.columns


def test_every_accepted_period_of_substitutions_is_seeded(spark):
    docs, want = [], set()
    for period in range(3, 16):
        for shift in range(period):
            words = [f"x{k}" if k % period == shift else f"i{k}" for k in range(60)]
            docs.append((100 * period + shift, "lead in " + " ".join(words) + " tail"))
            want |= {100 * period + shift} if period > 3 else set()
    items = [(9, " ".join(f"i{k}" for k in range(60)))]
    got = contaminated(frame(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    assert {r.doc_id for r in got} == want
