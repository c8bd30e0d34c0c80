"""Generators: seeds, pools, formats, skew, distribution bounds, retries."""
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import generate as G


def gen(spark, n, seed=7, **kw):
    return G.transactions(spark.range(n), seed, **kw)


def test_seed_repeats_and_formats(spark):
    a = gen(spark, 50).drop("transaction_ts").orderBy("id").collect()
    b = gen(spark, 50).drop("transaction_ts").orderBy("id").collect()
    assert a == b
    c = gen(spark, 50, seed=8).drop("transaction_ts").orderBy("id").collect()
    assert a != c
    for r in a:
        assert len(r["card_id"]) == 16 and r["card_id"].isdigit()
        assert r["merchant_id"].startswith("MERCH-") and len(r["merchant_id"]) == 14
        assert r["transaction_id"][14] == "4"


def test_pools(spark):
    rows = gen(spark, 500, card_pool_size=10, merchant_pool_size=5)
    [r] = rows.agg(F.countDistinct("card_id").alias("c"), F.countDistinct("merchant_id").alias("m")).collect()
    assert r["c"] <= 10 and r["m"] <= 5


def test_skew_and_amounts(spark):
    rows = gen(spark, 2000)
    [r] = rows.agg(F.avg((F.col("auth_status") == "APPROVED").cast("int")).alias("approved"),
                   F.min("amount").alias("lo"), F.max("amount").alias("hi"),
                   F.percentile_approx("amount", 0.5).alias("median")).collect()
    assert r["approved"] > 0.85
    assert 0.01 <= r["lo"] and r["hi"] <= 50000
    assert r["median"] < r["hi"] / 5
    assert rows.filter(F.round("amount", 2) != F.col("amount")).count() == 0


def test_weighted_choice(spark):
    with pytest.raises(ValueError):
        G.weighted_choice(["a", "b"], [1.0], F.lit(0.5))
    picks = spark.range(1000).select(
        G.weighted_choice(["a", "b"], [99, 1], G.uniform(1, "w", F.col("id"))).alias("x"))
    assert picks.filter("x = 'a'").count() > 950


def test_long_tail_clamp(spark):
    [r] = spark.range(1).select(
        G.long_tail_amount(F.lit(0.999999999), F.lit(0.0), mu=20.0).alias("hi"),
        G.long_tail_amount(F.lit(0.5), F.lit(0.5), mu=-50.0).alias("lo")).collect()
    assert r["hi"] == 50000.0 and r["lo"] == 0.01


def test_generate_valid_retries(spark):
    ids = spark.range(6)

    def build(pending, attempt):
        # ids 0-1 fail on the first two attempts, pass on the third
        return pending.select("id", F.lit(attempt).alias("attempt"))

    def validate(df):
        ok = (F.col("id") > 1) | (F.col("attempt") >= 2)
        return df.select("*", ok.alias("is_valid"),
                         F.when(ok, F.array()).otherwise(F.array(F.lit("bad"))).alias("reasons"))

    out = G.generate_valid(ids, build, validate, max_attempts=3)
    got = {r["id"]: r["attempt"] for r in out.collect()}
    assert got == {0: 2, 1: 2, 2: 0, 3: 0, 4: 0, 5: 0}
    with pytest.raises(G.GenerationError):
        G.generate_valid(ids, build, validate, max_attempts=2)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            G.generate_valid(ids, build, validate, max_attempts=bad)


def test_generated_rows_validate(spark):
    ids = spark.range(300).select("id", F.current_timestamp().alias("now"))
    out = G.generate_valid(ids, lambda p, a: G.transactions(p, 3, now=F.col("now"), attempt=a),
                           lambda t: G.validate_transactions(t, now=F.col("now")))
    assert out.count() == 300
