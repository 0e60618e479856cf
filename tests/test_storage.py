"""CSV edge cases, landing, logs, partition replacement, upsert, layout audit."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from daybrook.functions import columns as C
from daybrook.operators import compare
from daybrook.plans import gates, ingest, layout
from daybrook.schemas import CATEGORY_COLUMNS, RAW_COLUMNS
from daybrook.session import shared_root
from daybrook.sources import readers as R, sinks as W
from tests.conftest import D1, D2, D3, files_df, lookup_df, raw_df, raw_row, two_days
from tests.test_session import shuffle_files

ROWS = ('1,"line one, with comma\nline two ""quoted""",20220916\ntoo,short\n2,,20220917\n3,"",20220917\n'
        '1,2,3,4\n4, x ,20220917\n')


@pytest.mark.parametrize("bom", [True, False])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_quoted_csv_lands_verbatim(spark, tmp_path, bom, fmt):
    src = tmp_path / "in.csv"
    src.write_text("user_id,title,p_date\n" + ROWS, encoding="utf-8-sig" if bom else "utf-8")
    status, detail = ingest.land_interactions(spark, str(src), str(tmp_path / "raw"), fmt)
    assert status == "OK_WITH_WARNINGS"
    assert json.loads(detail) == {"total_rows_read": 6, "malformed_rows_skipped": 2,
                                  "partitions": {"20220916": 1, "20220917": 3}}
    reader = spark.read.schema("user_id string, title string, p_date string, part_date string")
    got = (reader.options(**R.QUOTED_CSV).csv if fmt == "csv" else reader.parquet)(str(tmp_path / "raw")).na.fill("")
    assert {r["user_id"]: r["title"] for r in got.collect()} == {
        "1": 'line one, with comma\nline two "quoted"', "2": "", "3": "", "4": " x "}


def test_good_rows_can_be_counted_straight_from_the_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("user_id,title,p_date\n" + ROWS)
    rows = R.read_quoted_csv(spark, str(tmp_path / "in.csv"), ["user_id", "title", "p_date"])
    assert R.good_rows(rows).count() == 4


def test_broken_sources_become_status_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "nodate.csv").write_text("a,b\n1,2\n")
    out = {n: ingest.land_interactions(spark, str(tmp_path / n), str(tmp_path / "raw"))[0]
           for n in ("empty.csv", "nodate.csv", "absent.csv")}
    assert out == {"empty.csv": "ERROR", "nodate.csv": "ERROR", "absent.csv": "MISSING"}
    assert not (tmp_path / "raw").exists()


def test_ingest_logs_every_source_under_one_batch(spark, tmp_path):
    (tmp_path / "cats.csv").write_text(",".join(CATEGORY_COLUMNS) + "\n1,1,美食,1,1, food\n", encoding="utf-8-sig")
    (tmp_path / "tr").mkdir()
    (tmp_path / "tr" / "1.txt").write_text("two words\nand more")
    (tmp_path / "rules.json").write_text(json.dumps([{"id": 1}, {"id": 2}], indent=2))
    (tmp_path / "one.json").write_text(json.dumps({"id": 5}, indent=2))
    raw = str(tmp_path / "raw")
    batch = ingest.ingest_all(
        spark, {"interactions": str(tmp_path / "none.csv"), "categories": str(tmp_path / "cats.csv"),
                "transcripts": str(tmp_path / "tr"), "payloads": {"rules": str(tmp_path / "rules.json"),
                                                                  "one": str(tmp_path / "one.json")}},
        raw, {"rules": "id bigint", "one": "id bigint"})
    with open(tmp_path / "raw" / "_ingestion_log" / "part-x.json", "w") as f:
        f.write("this is not json\n")
    log = R.read_log(spark, raw + "/_ingestion_log").collect()
    assert {(r["source"], r["status"]) for r in log} == {
        ("interactions", "MISSING"), ("categories", "OK"), ("transcripts", "OK"), ("rules", "OK"), ("one", "OK")}
    assert {r["batch_id"] for r in log} == {batch}
    assert R.last_ok_batch_id(spark, raw + "/_ingestion_log", "categories") == batch
    assert R.last_ok_batch_id(spark, raw + "/_ingestion_log", "interactions") is None
    assert R.last_ok_batch_id(spark, raw + "/nolog", "categories") is None
    assert spark.read.schema("id bigint").json(raw + "/rules").count() == 2
    assert spark.read.parquet(raw + "/categories").first()["category_name_en"] == " food"


def test_partition_reads(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert R.partition_dates(spark, root) == []
    W.fanout_by_date(raw_df(spark, two_days()), root)
    assert R.partition_dates(spark, root) == [D1, D2]
    assert R.read_raw_date(spark, root, D2, ["user_id", "pid"]).count() == 3
    with pytest.raises(FileNotFoundError, match="20230101"):
        R.read_raw_date(spark, root, "20230101")
    W.fanout_by_date(raw_df(spark, [r for r in two_days() if r["p_date"] == D2][:1]), root)  # rerun of one date
    assert {r[0]: r[1] for r in W.rows_per_date(R.read_raw(spark, root)).collect()} == {D1: 6, D2: 1}
    W.land_missing_dates(raw_df(spark, two_days()), root)  # both known: nothing changes
    assert R.read_raw(spark, root).count() == 7
    plan = R.read_raw(spark, root, D1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan
    assert compare.same_rows(R.read_raw(spark, root, D1).select(*RAW_COLUMNS), raw_df(spark, [r for r in two_days() if r["p_date"] == D1]))


@pytest.mark.parametrize("bad", ["2022-09-16", "2022091", "202209166", "2022091a", "20220916\n", "٢٠٢٢٠٩١٦"])
def test_date_argument(bad):
    with pytest.raises(ValueError):
        C.check_p_date(bad)
    assert C.check_p_date(20220916) == "20220916" and C.iso_date("20220916") == "2022-09-16"


def test_replace_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02")], "v int, d string").withColumn(
        "d", F.to_date("d"))
    W.write_partitions(df, root, "d")
    for _ in range(2):
        assert W.replace_partition(df.where("v = 1"), root, "d", "2024-01-01") == 1
    assert sorted(r[0] for r in spark.read.schema(df.schema).parquet(root).collect()) == [1, 3]
    assert W.replace_partition(df.where("v = 99"), root, "d", "2024-01-01") == 0
    assert [r[0] for r in spark.read.schema(df.schema).parquet(root).collect()] == [3]


def test_upsert_keeps_other_columns(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, extra int")
    s = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    got = sorted(tuple(r) for r in W.upsert(t, s, ["k", "v"], ["k"]).collect())
    assert got == [(1, "a", 5), (2, None, 6), (3, "c", None)]
    keys = W.upsert(t.select("k"), s.select("k"), ["k"], ["k"])
    assert sorted(r[0] for r in keys.collect()) == [1, 2, 3]


def test_multiset_difference_counts_repetitions(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    assert tuple(compare.multiset_difference(a, b).first()) == (4, 4, 1, 1)
    assert compare.same_rows(a, a.orderBy(F.desc("x"))) and not compare.same_rows(a, b)


def test_fidelity_statuses(spark):
    a = spark.createDataFrame([(1, 1.0, "x", True), (2, 2.0, "y", None)], "k int, d double, s string, b boolean")
    b = spark.createDataFrame([(1, 1.5, "x"), (2, 2.0, "y")], "k long, d double, s string")
    got = {r["column_name"]: (r["status"], r["max_abs_diff"]) for r in compare.fidelity(a, b, ["k"]).collect()}
    assert got == {"k": ("type_changed", None), "d": ("value_changed", 0.5), "s": ("exact", None), "b": ("missing", None)}


def test_json_array_file_is_one_record_per_element(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}, {"k": 3}], indent=1))
    assert R.read_json_documents(spark, str(tmp_path / "a.json"), "k bigint").count() == 3


def test_strategies_prune_and_agree(spark, tmp_path):
    df = spark.range(4000).selectExpr("id AS v", "date_add(DATE '2024-01-01', CAST(id % 4 AS INT)) AS p_date")
    paths = [str(tmp_path / n) for n in ("part", "single", "clustered")]
    W.write_partitions(df, paths[0])
    df.coalesce(1).write.parquet(paths[1])
    W.write_clustered(df, paths[2])
    s = layout.read_strategies(spark, *paths, df.schema, "2024-01-02")
    rows = layout.compare_strategies(s).collect()
    assert all((r["rows_returned"], r["only_left"], r["only_right"]) == (1000, 0, 0) for r in rows)
    files = {r["strategy"]: r["files"] for r in layout.scanned_files(s).collect()}
    assert files["partition_read"] == 1
    plan = s["single_pushdown"]._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_date" in plan
    assert {r["skew_ratio"] for r in layout.partition_stats(spark, paths[0], df.schema).collect()} == {1.0}


def write_csv(path, columns, rows):
    path.write_text("\n".join([",".join(columns), *[",".join(r[c] for c in columns) for r in rows]]) + "\n")


def delivered(tmp_path, shapes):
    """One file per (columns, row changes); a row carries its own user id."""
    (tmp_path / "src").mkdir()
    for i, (columns, changes) in enumerate(shapes):
        write_csv(tmp_path / "src" / f"{i}.csv", columns, [{**raw_row(user_id=i), "surprise": "x", **changes}])
    return str(tmp_path / "src"), str(tmp_path / "raw")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_each_file_is_read_by_its_own_header(spark, tmp_path, fmt):
    swapped = ["hate", "click"] + [c for c in RAW_COLUMNS if c not in ("hate", "click")]
    src, raw = delivered(tmp_path, [(RAW_COLUMNS, dict(hate="True")), (swapped, dict(hate="True")), (swapped, dict(click="True"))])
    assert ingest.land_interactions(spark, src, raw, fmt)[0] == "OK"
    got = {r["user_id"]: (r["hate"], r["click"]) for r in R.read_raw(spark, raw, fmt=fmt).collect()}
    assert got == {"0": ("True", "False"), "1": ("True", "False"), "2": ("False", "True")}


def test_missing_and_unknown_columns_reach_the_gate(spark, tmp_path):
    less = [c for c in RAW_COLUMNS if c != "hate"]
    src, raw = delivered(tmp_path, [(RAW_COLUMNS, {}), (less, dict(p_date=D2)), (RAW_COLUMNS + ["surprise"], dict(p_date=D3))])
    ingest.land_interactions(spark, src, raw)
    W.replace_partition(raw_df(spark, []).withColumn(R.PART, F.col("p_date")), raw, R.PART, "20220930")
    rep = gates.raw_gate(R.read_raw_as_delivered(spark, raw), lookup_df(spark), files_df(spark), dates=R.partition_dates_df(spark, raw))
    failed = {(r["p_date"], r["name"]): r["detail"] for r in rep.where("NOT passed").collect()}
    assert failed == {(D2, "schema_columns"): "missing [hate], unknown []", (D3, "schema_columns"): "missing [], unknown [surprise]",
                      ("20220930", "partition_not_empty"): "0 rows"}
    per_date = {r["p_date"]: r["count"] for r in rep.groupBy("p_date").count().collect()}
    assert per_date == {D1: 19, D2: 2, D3: 19, "20220930": 2}


def test_rows_without_a_date_are_set_aside(spark, tmp_path):
    src, raw = delivered(tmp_path, [(RAW_COLUMNS, {}), (RAW_COLUMNS, dict(p_date="soon")), (RAW_COLUMNS, dict(p_date=""))])
    status, detail = ingest.land_interactions(spark, src, raw)
    assert status == "OK_WITH_WARNINGS" and json.loads(detail)["undated_rows_set_aside"] == 2
    assert json.loads(detail)["partitions"] == {D1: 1} and R.partition_dates(spark, raw) == [D1]
    assert spark.read.parquet(f"{raw}_undated").count() == 2


def test_a_source_without_dates_is_an_error(spark, tmp_path):
    src, raw = delivered(tmp_path, [(RAW_COLUMNS, {}), (["user_id", "pid"], {})])
    assert ingest.land_interactions(spark, src, raw)[0] == "ERROR"
    (tmp_path / "empty.csv").write_text("")
    assert ingest.land_interactions(spark, str(tmp_path / "empty.csv"), raw)[0] == "ERROR"
    assert ingest.land_interactions(spark, str(tmp_path / "nothing"), raw)[0] == "MISSING"


def test_error_text_is_logged_whole(spark, tmp_path, monkeypatch):
    text = "reason " * 400
    monkeypatch.setattr(ingest, "land_interactions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError(text)))
    ingest.ingest_all(spark, {"interactions": "x", "categories": str(tmp_path / "none"), "transcripts": str(tmp_path / "none")}, str(tmp_path / "raw"))
    log = {r["source"]: (r["status"], r["detail"]) for r in R.read_log(spark, str(tmp_path / "raw" / "_ingestion_log")).collect()}
    assert log["interactions"] == ("ERROR", f"RuntimeError: {text}") and log["categories"][0] == "MISSING"


def test_a_hot_date_is_clustered_in_several_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id AS user_id", "IF(id % 10 = 0, '20220917', '20220916') AS p_date").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        W.write_clustered(df, str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    files = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 6 and max(r["count"] for r in files) < 6000


def test_replacing_one_date_moves_no_row(spark, tmp_path):
    spark.range(4000).selectExpr("id", "date'2024-01-02' AS p_date").repartition(3).write.parquet(f"{tmp_path}/day")
    spark.range(10).selectExpr("id", "date'2024-01-01' AS p_date").write.partitionBy("p_date").parquet(f"{tmp_path}/t")
    plans, write = [], W.write_partitions

    def seen(df, root, column="p_date", fmt="parquet", stored=False, **options):
        plans.append((df if stored else W.by_date(df, column))._jdf.queryExecution().toString())
        write(df, root, column, fmt, stored=stored, **options)

    W.write_partitions = seen
    try:
        assert W.replace_partition(spark.read.parquet(f"{tmp_path}/day"), f"{tmp_path}/t", "p_date", "2024-01-02") == 4000
    finally:
        W.write_partitions = write
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4010
    assert plans and not any("Exchange" in p for p in plans)


def test_few_dates_stay_where_they_are_read(spark, tmp_path, monkeypatch):
    """Rows of few dates are landed without being dealt by date; of many dates they are."""
    raw_df(spark, two_days()).write.options(**R.CSV_WRITE).csv(str(tmp_path / "src"))
    dealt, deal = [], W.by_date
    monkeypatch.setattr(W, "by_date", lambda df, column: dealt.append(column) or deal(df, column))
    found = []
    for few in (ingest.FEW_DATES, 1):
        monkeypatch.setattr(ingest, "FEW_DATES", few)
        status, detail = ingest.land_interactions(spark, str(tmp_path / "src"), str(tmp_path / f"raw{few}"))
        assert status == "OK" and json.loads(detail)["partitions"] == {D1: 6, D2: 3}
        found.append((sorted(map(tuple, R.read_raw(spark, str(tmp_path / f"raw{few}")).collect())), len(dealt)))
    assert found[0][0] == found[1][0] and [n for _, n in found] == [0, 1]


def test_a_date_is_replaced_from_a_plan_that_reads_it(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "n bigint, p_date date"
    rows = spark.createDataFrame([(1, dt.date(2022, 9, 16)), (2, dt.date(2022, 9, 17))], schema)
    W.write_partitions(rows, root)
    stored = spark.read.schema(schema).parquet(root)
    W.replace_date(stored.withColumn("n", F.col("n") + 10), root, "p_date", "2022-09-17")
    W.replace_date(rows.withColumns({"n": F.lit(5).cast("bigint"), "p_date": F.lit(dt.date(2022, 9, 18))}), root, "p_date", "2022-09-18")
    read = lambda: sorted((r["n"], str(r["p_date"])) for r in spark.read.schema(schema).parquet(root).collect())
    assert read() == [(1, "2022-09-16"), (5, "2022-09-18"), (5, "2022-09-18"), (12, "2022-09-17")]
    W.replace_date(rows.where("false"), root, "p_date", "2022-09-16")
    assert read() == [(5, "2022-09-18"), (5, "2022-09-18"), (12, "2022-09-17")]
    assert sorted(n for n in os.listdir(root) if n != "_SUCCESS") == [f"p_date=2022-09-{d}" for d in (16, 17, 18)]
    assert R.partition_dates(spark, root, "p_date") == ["2022-09-16", "2022-09-17", "2022-09-18"]


def landing_copies(spark):
    root = shared_root(spark).removeprefix("file://")
    return [n for n in os.listdir(root) if n.startswith("landing-")] if os.path.isdir(root) else []


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_plan_of_few_dates_is_landed_without_moving_rows_by_date(spark, tmp_path, monkeypatch, fmt):
    """Its copy goes after landing; of many dates the rows are dealt as before, and the same rows arrive."""
    dealt, deal = [], W.by_date
    monkeypatch.setattr(W, "by_date", lambda df, column: dealt.append(column) or deal(df, column))
    rows, before, found = raw_df(spark, two_days()).repartition(3), landing_copies(spark), []
    for few in (W.FEW_DATES, 1):
        monkeypatch.setattr(W, "FEW_DATES", few)
        W.fanout_by_date(rows, str(tmp_path / f"raw{few}"), fmt)
        found.append((sorted(map(tuple, R.read_raw(spark, str(tmp_path / f"raw{few}"), fmt=fmt).collect())), len(dealt)))
    assert found[0][0] == found[1][0] and len(found[0][0]) == 9 and [n for _, n in found] == [0, 1]
    assert landing_copies(spark) == before


def test_landed_csv_is_compressed(spark, tmp_path):
    W.fanout_by_date(raw_df(spark, two_days()), str(tmp_path / "raw"), "csv")
    assert all(n.endswith(".csv.gz") for n in os.listdir(tmp_path / "raw" / f"part_date={D1}") if n.startswith("part-"))


def test_the_parsed_copy_goes_after_landing(spark, tmp_path):
    before = landing_copies(spark)
    raw_df(spark, two_days()).write.options(**R.CSV_WRITE).csv(str(tmp_path / "src"))
    assert ingest.land_interactions(spark, str(tmp_path / "src"), str(tmp_path / "raw"))[0] == "OK"
    assert R.read_raw(spark, str(tmp_path / "raw")).count() == 9 and landing_copies(spark) == before


def test_writers_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(4000).selectExpr("id", "date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS p_date").repartition(3, "id")
    W.write_partitions(rows, f"{tmp_path}/a")
    W.replace_all(rows, f"{tmp_path}/b")
    W.overwrite_table(rows, f"{tmp_path}/c")
    W.replace_date(rows, f"{tmp_path}/d", "p_date", "2024-01-02")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
