"""Warehouse queries over an events table in which one user and video have several events in a second."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daybrook.catalog import inputs as I
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """The smallest tables; every tenth event occurs again a few microseconds later, every fiftieth also with equal values."""
    root = tmp_path_factory.mktemp("crowded")
    for name in os.listdir(SF):
        if name != "events.parquet":
            os.symlink(f"{SF}/{name}", root / name)
    e = spark.read.parquet(f"{SF}/events.parquet")
    again = e.where("event_id % 10 = 0").withColumns({
        "event_id": F.col("event_id") + 1_000_000, "event_type": F.lit("view"),
        "ts": F.expr("make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), minute(ts), floor(extract(second from ts)) + 0.999999)")})
    equal = e.where("event_id % 50 = 0").withColumn("event_id", F.col("event_id") + 2_000_000)
    # one file, which Spark and DuckDB read by the same name
    e.unionByName(again).unionByName(equal).coalesce(1).write.parquet(str(root / "written"))
    part = next(f for f in os.listdir(root / "written") if f.endswith(".parquet"))
    os.symlink(root / "written" / part, root / "events.parquet")
    return str(root)


def test_every_event_has_its_own_key(spark, crowded):
    rows = I.events_told_apart(spark, crowded)
    plain = I.daily_events(spark, crowded)
    keys = ["user_id", "pid", "exposed_time"]
    assert plain.select(*keys).distinct().count() < plain.count() == rows.count() == rows.select(*keys).distinct().count()
    seconds = rows.withColumn("exposed_time", F.floor(F.col("exposed_time") / 1_000_000)).select(*plain.columns)
    assert seconds.exceptAll(plain).isEmpty() and plain.exceptAll(seconds).isEmpty()


@pytest.mark.parametrize("name", ["warehouse_load", "upsert_buckets", "load_all_or_nothing"])
def test_loads_take_several_events_of_a_second(spark, crowded, name):
    ok, rows, message = compare(spark, connect(crowded), crowded, entry.queries()[name], entry.oracle_sql()[name])
    assert ok and rows, message
