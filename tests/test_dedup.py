"""Duplicates by fingerprint against counting whole rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybrook.operators import dedup

SCHEMA = "`a b` string, d string, n bigint, x double"


def rows_with_copies(seed, n=300):
    rng = random.Random(seed)
    pool = [(rng.choice([None, "", "x", "xy"]), rng.choice([None, "", "x", "yx"]), rng.choice([None, 0, 1]), rng.choice([None, 0.0, 1.5]))
            for _ in range(60)]
    return [rng.choice(pool) if rng.random() < 0.5 else (f"own{i}", None, i, None) for i in range(n)]


def plain(rows, by):
    groups = {}
    for row, n in Counter(rows).items():
        groups.setdefault(row[1] if by else (), []).append(n)
    return sorted(((*((k,) if by else ()), sum(c), len(c), sum(c) - len(c)) for k, c in groups.items()), key=repr)


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("broadcast", [500_000, 0])
@pytest.mark.parametrize("by", [[], ["d"]])
def test_stats_and_distinct_rows(spark, monkeypatch, weak, broadcast, by):
    """Also with a hash that hardly tells rows apart, and with more fingerprints than may be broadcast."""
    if weak:
        monkeypatch.setattr(dedup, "fingerprint", lambda columns: [
            (F.coalesce(F.col("n"), F.lit(0)) % 2).alias(dedup.PRINT[0]), F.lit(1).cast("bigint").alias(dedup.PRINT[1])])
    monkeypatch.setattr(dedup, "BROADCAST_PRINTS", broadcast)
    rows = rows_with_copies(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = dedup.duplicate_stats(df, by).drop("exact_duplicate_share").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, by)
    assert sorted((tuple(r) for r in dedup.drop_exact_duplicates(df).collect()), key=repr) == sorted(set(rows), key=repr)


def test_places_of_nulls_tell_rows_apart(spark):
    df = spark.createDataFrame([("x", None, None, None), (None, "x", None, None), (None, None, None, None)], SCHEMA)
    assert df.select(*dedup.fingerprint(df.columns)).distinct().count() == 3
    assert dedup.maybe_repeated(df).count() == 0


def test_only_repeated_rows_move(spark):
    """The plan over all rows shuffles two numbers a row; whole rows are shuffled only behind the semi join."""
    df = spark.createDataFrame([(f"r{i}", None, i, None) for i in range(500)] + [("twice", "d", 1, 1.0)] * 2, SCHEMA)
    assert [tuple(r) for r in dedup.maybe_repeated(df).collect()] == [("twice", "d", 1, 1.0)] * 2
    assert dedup.repeated_prints(df).columns == list(dedup.PRINT) and dedup.repeated_prints(df).count() == 1
    plan = dedup.maybe_repeated(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dedup.duplicate_stats(df).first()[:3] == (0, 0, 0) and dedup.duplicate_stats(df, ["d"]).count() == 0
    assert dedup.drop_exact_duplicates(df).count() == 0


TEXT = "a string, `b c` string, d string"


def text_rows(n=200):
    rng = random.Random(5)
    pool = [(rng.choice([None, "", "-", "1:x"]), rng.choice([None, "", "x", "1:x"]), rng.choice(["u", "v"])) for _ in range(40)]
    return [rng.choice(pool) for _ in range(n)] + [(f"own{i}", None, "u") for i in range(n)]


def test_counting_text_rows_moves_digests_only(spark, monkeypatch):
    """Also where very many rows repeat, no exchange below the counts holds a row's cells."""
    monkeypatch.setattr(dedup, "BROADCAST_PRINTS", 0)
    rows = text_rows()
    df = spark.createDataFrame(rows, TEXT).repartition(4).cache()
    try:
        plan = dedup._surplus(df, ["d"])._jdf.queryExecution().executedPlan().toString()
        assert "_print_1" not in plan and "SortMergeJoin" not in plan
        got = {r["d"]: (r["n_rows"], r["distinct_rows"]) for r in dedup.duplicate_stats(df, ["d"]).collect()}
    finally:
        df.unpersist()
    assert got == {d: (sum(r[2] == d for r in rows), len({r for r in rows if r[2] == d})) for d in "uv"}


def test_digests_tell_cells_apart(spark):
    rows = [("ab", "c", "u"), ("a", "bc", "u"), (None, "-", "u"), ("-", None, "u"), ("", None, "u"), ("1:x", "", "u"), ("1", "x", "u")]
    assert spark.createDataFrame(rows, TEXT).select(dedup.digest(["a", "b c", "d"])).distinct().count() == len(rows)


def test_only_types_with_exact_text_are_counted_by_digest(spark):
    assert dedup.has_exact_text(spark.createDataFrame([], "a string, n bigint, d date, b boolean"))
    for kind in ("double", "timestamp", "array<string>", "binary", "decimal(5,2)"):
        assert not dedup.has_exact_text(spark.createDataFrame([], f"a string, x {kind}"))


def test_tasks_that_drop_copies_grow_with_the_rows(spark, monkeypatch):
    """Whole rows move once, not combined by a task that reads very many, to one task for each ``ROWS_PER_TASK``."""
    monkeypatch.setattr(dedup, "BROADCAST_PRINTS", 0)
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 40)
    rows = text_rows()
    out = dedup.drop_exact_duplicates(spark.createDataFrame(rows, TEXT).repartition(4))
    assert "hashpartitioning(_print_1" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", 10), REPARTITION_BY_NUM" in plan
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, set(rows)))


def test_rows_with_very_many_copies_are_combined_where_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST_PRINTS", 0)
    monkeypatch.setattr(dedup, "MANY_COPIES", 50)
    rows = text_rows() + [("hot", None, "u")] * 100
    out = dedup.drop_exact_duplicates(spark.createDataFrame(rows, TEXT).repartition(4))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, set(rows)))


@pytest.mark.parametrize("at_once", [500_000_000, 100])
def test_stored_rows_stay_where_they_are_read(spark, tmp_path, monkeypatch, at_once):
    """Copies within a file, between files and in very many places; also with several rounds of files."""
    monkeypatch.setattr(dedup, "MARKED_AT_ONCE", at_once)
    rows = text_rows() + [("hot", None, "u")] * 300
    folder = f"{tmp_path}/a b=%20,c"
    spark.createDataFrame(rows, TEXT).repartition(4).write.parquet(folder)
    df = spark.read.parquet(folder)
    out = dedup.drop_exact_duplicates(df, stored=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and out.columns == df.columns
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, set(rows)))


def test_stored_rows_beyond_one_bitmap(spark, tmp_path):
    spark.range(0, 60_000, 1, 2).selectExpr("id % 41000 AS _file", "CAST(id % 41000 AS string) AS _at").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = dedup.drop_exact_duplicates(df, stored=True)
    assert out.count() == 41_000 and out.distinct().count() == 41_000
    assert dedup.drop_exact_duplicates(df.where("false"), stored=True).count() == 0
    spark.read.parquet(f"{tmp_path}/t").where("false").write.parquet(f"{tmp_path}/none")
    assert dedup.drop_exact_duplicates(spark.read.parquet(f"{tmp_path}/none"), stored=True).count() == 0
