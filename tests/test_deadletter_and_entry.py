"""Dead-letter bisection; driver contract of the entry module."""
import pandas as pd
import pytest

from ledgerflow.operators import deadletter
from ledgerflow.operators.deadletter import process_with_bisect


def test_bisect_isolates_failing_rows(spark, tmp_root):
    df = spark.range(1000).repartition(4)
    sink = tmp_root + "/ok"
    import os
    os.makedirs(sink)

    def load(batch):
        if batch["id"].isin([17, 150, 151]).any():
            raise ValueError("poison\nsecond line " + "x" * 3000)
        assert len(batch) <= 100
        batch.to_csv(f"{sink}/{os.getpid()}-{batch['id'].iloc[0]}.csv", index=False)

    dead = process_with_bisect(df, load, max_retries=1, dead_letter_uri=tmp_root + "/dlq").collect()
    assert sorted(r["id"] for r in dead) == [17, 150, 151]
    assert all(r["error_message"].endswith("x" * 3000) for r in dead)       # whole text
    loaded = pd.concat(pd.read_csv(f"{sink}/{f}") for f in os.listdir(sink))
    assert sorted(loaded["id"]) == sorted(set(range(1000)) - {17, 150, 151})


def test_attempts_count_the_calls(monkeypatch):
    calls = []

    def handle(batch):
        calls.append(list(batch["id"]))
        if 2 in list(batch["id"]):
            raise ValueError("no")

    dead = list(deadletter._bisect(pd.DataFrame({"id": [0, 1, 2, 3]}), handle, 2, 0))
    assert len(dead) == 1 and dead[0]["id"].tolist() == [2]
    assert dead[0]["attempts"].iloc[0] == sum(2 in c for c in calls) == 6


def test_retry_succeeds_and_empty_input(spark, tmp_root):
    tried = []

    def flaky(batch):
        tried.append(1)
        if len(tried) == 1:
            raise ValueError("first call fails")

    assert deadletter._tried(pd.DataFrame({"id": [1]}), flaky, 2) == (None, 2)
    assert process_with_bisect(spark.range(0), flaky, dead_letter_uri=tmp_root + "/none").count() == 0
    with pytest.raises(ValueError):
        process_with_bisect(spark.range(1), flaky, dead_letter_uri=tmp_root + "/x", batch_size=0)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert set(df.columns) >= {"run_id", "total", "valid", "quarantined", "run_status"}
    assert sum(r["valid"] for r in rows) == 661 and sum(r["quarantined"] for r in rows) == 339
    assert set(E.oracle_sql()) <= set(E.queries())

