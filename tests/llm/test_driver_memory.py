"""What the corpus operators leave with the driver and on its disks."""

import glob
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import bloom, common
from ledgerflow.llm import toxicity as tox


def test_ratios_take_little_more_than_their_own_array():
    counts = np.random.default_rng(3).poisson(2, (2, tox.FEATURES)).astype(np.float32)
    tracemalloc.start()
    ratios = tox.log_ratios(counts, np.array([5000.0, 900.0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (ratios != 0).any() and peak < counts.nbytes


def test_slots_are_numbered_as_unique_does():
    held = np.random.default_rng(4).integers(0, tox.FEATURES, 5000, dtype=np.int32)
    for own in (held, np.repeat(held, 3), held[:0]):
        columns, where = tox._numbered(own)
        expected = np.unique(own, return_inverse=True)
        assert (columns == expected[0]).all() and (where == expected[1]).all()


def test_a_filter_takes_few_jobs_whatever_the_shuffle_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    hashes = spark.range(0, 20_000, 1, 3).select(F.xxhash64("id").alias("h"))
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("filter-jobs", "")
        once, _ = bloom.build(hashes, 20_000)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("filter-jobs")
    assert 0 < len(jobs) <= 2 * common.LOCAL_PARTS
    values = np.array([r.h for r in hashes.collect()], dtype=np.int64).view(np.uint64)
    assert bloom.contains(once, values).all()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    folders = list(spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    kept = common.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffle-test")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
