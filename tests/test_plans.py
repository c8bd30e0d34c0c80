"""Plan properties the design relies on, read from the physical plans."""

from conftest import NOW, as_bytes, txn
from ledgerflow import schema as S
from ledgerflow.operators import route
from ledgerflow.plans import queries as Q
from ledgerflow.plans.batch import process_batch, raw_from_payloads
from ledgerflow.operators import sinks
from ledgerflow.sources import shard_log

SF = "/root/testdata/sf0.001"


def plan_of(df):
    """The formatted physical plan as text (the plain form truncates)."""
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_classification_stays_in_the_jvm(spark):
    plan = plan_of(Q.batch_run_summary(spark, SF))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in plan
    # the run counts reuse the batch window's partitioning: one shuffle only
    import re
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(Q.batch_run_summary(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_counts_aggregate_partially(spark):
    c = Q.classified(spark, SF)
    plan = plan_of(route.run_counts(c, keys=("run_id",)))
    assert "partial_count" in plan


def test_day_filter_prunes_partitions(spark, tmp_root):
    lake = S.LakeSettings(root=tmp_root)
    process_batch(spark, raw_from_payloads(spark, [as_bytes(txn())]), "r", lake, now=NOW)
    from ledgerflow.operators.layers import day_range
    plan = plan_of(day_range(sinks.read_bronze(spark, lake.bronze), "2026-01-01", "2026-01-02"))
    assert "PartitionFilters: [(concat_ws(-, year" in plan


def test_shard_read_prunes_and_pushes(spark, tmp_root):
    rows = [("shard-0", 1, None, "k", bytearray(b"{}")), ("shard-1", 2, None, "k", bytearray(b"{}"))]
    df = spark.createDataFrame(rows, "shard_id string, sequence_number long, arrival_ts timestamp, "
                                     "partition_key string, data binary")
    shard_log.land(df, tmp_root + "/log")
    log = shard_log.read(spark, tmp_root + "/log")
    plan = plan_of(shard_log.drain(log, "shard-1", after={"shard-1": 0}))
    assert "PartitionFilters: [isnotnull(shard_id" in plan and "(shard_id" in plan
    assert "PushedFilters: [IsNotNull(sequence_number), GreaterThan(sequence_number,0)]" in plan


def test_filters_stay_above_classification(spark):
    # the observed-metrics node keeps is_valid filters from being pushed into
    # the rule expressions; planning stays fast
    import time
    start = time.time()
    plan = plan_of(Q.quarantine_rows(spark, SF))
    assert "CollectMetrics" in plan
    assert time.time() - start < 60


def test_per_shard_limit_is_limited_before_the_shuffle(spark, tmp_root):
    rows = [(f"shard-{i % 2}", i, None, "k", bytearray(b"{}")) for i in range(20)]
    df = spark.createDataFrame(rows, "shard_id string, sequence_number long, arrival_ts timestamp, "
                                     "partition_key string, data binary")
    shard_log.land(df, tmp_root + "/log")
    plan = plan_of(shard_log.drain(shard_log.read(spark, tmp_root + "/log"), limit=3))
    assert "WindowGroupLimit" in plan and "Partial" in plan
