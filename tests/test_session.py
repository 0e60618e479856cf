"""Scratch tables: what a stored job leaves on disk."""

import os
import time

from pyspark.sql import functions as F

from daybrook.session import freeing, materialize, release

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {os.path.join(top, f) for d in dirs for top, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_a_stored_job_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = materialize(spark.range(50_000).repartition(3, "id").groupBy((F.col("id") % 9).alias("k")).count(), "freed")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert rows.count() == 9 and spark.conf.get(FREE) == "false"


def test_the_setting_returns_after_an_error(spark):
    spark.conf.set(FREE, "true")
    try:
        with freeing(spark):
            pass
        assert spark.conf.get(FREE) == "true"
    finally:
        spark.conf.unset(FREE)
    try:
        with freeing(spark):
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(FREE) == "false"


def test_a_released_table_is_gone(spark):
    rows = materialize(spark.range(10), "gone")
    folder = rows.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert os.path.isdir(folder)
    release(rows)
    assert not os.path.exists(folder)
