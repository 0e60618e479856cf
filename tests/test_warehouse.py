"""Buckets that do not change keep their files; of two loads at once one starts again."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from daybrook.functions import columns as C
from daybrook.plans import warehouse as WH
from daybrook.schemas import CURATED_EVENT_COLUMNS, FEATURE_COLUMNS
from daybrook.sources import sinks as W

D1, D2, D3 = "20220916", "20220917", "20220918"
USERS = 60


def curated(spark, label, users=range(USERS), city="Beijing", watch=10):
    """Curated tables with one event of every user on one date."""
    day = dt.date.fromisoformat(C.iso_date(label))
    n = int(label[-2:])
    ids = spark.createDataFrame([(u,) for u in users], "user_id bigint")
    event = {"pid": F.col("user_id") % 7, "exposed_time": F.col("user_id") + 1000 * n, "p_date": F.lit(day), "p_hour": F.lit(10).cast("bigint"),
             "author_fans_count": F.lit(5).cast("bigint"), "watch_time": F.lit(watch).cast("bigint"), "watch_ratio": F.lit(0.5),
             "is_rewatch_flagged": F.lit(False), "tag_count": F.lit(1).cast("bigint"), "ingest_batch_id": F.lit("b")}
    flags = {c: F.lit(False) for c in ("cvm_like", "click", "comment", "follow", "collect", "forward", "hate")}
    events = ids.withColumns({**event, **flags}).select(*CURATED_EVENT_COLUMNS)
    zero = {c: F.lit(0).cast("bigint") for c in FEATURE_COLUMNS if c not in ("user_id", "feature_date")}
    share = {c: F.lit(0.0) for c in ("late_night_share", "avg_session_seconds", "hate_rate", "rewatch_rate")}
    features = ids.withColumns({**zero, **share, "feature_date": F.lit(day), "n_events": F.lit(1).cast("bigint"),
                                "n_sessions": F.lit(1).cast("bigint")}).select(*FEATURE_COLUMNS)
    known = spark.createDataFrame([(u,) for u in range(USERS)], "user_id bigint").select(
        "user_id", F.lit("M").alias("gender"), F.lit(30).cast("bigint").alias("age"), F.lit(5).cast("bigint").alias("mod_price"),
        F.lit(city).alias("fre_city"), F.lit("城区").alias("fre_community_type"), F.lit("一线城市").alias("fre_city_level"))
    videos = spark.createDataFrame([(p, 1, "t", 2.0, False, None) for p in range(7)],
                                   "pid bigint, author_id bigint, title string, duration double, has_transcript boolean, transcript_word_count bigint")
    categories = spark.createDataFrame([(1, 1, "c", 1, 1, "c", False)], "category_level bigint, category_id bigint, category_name_cn string, "
                                       "parent_id bigint, root_id bigint, category_name_en string, en_label_ambiguous boolean")
    bridge = spark.createDataFrame([(p, 1) for p in range(7)], "pid bigint, category_id bigint")
    return {"interactions_curated": events, "daily_user_features": features, "users": known, "videos": videos,
            "categories": categories, "video_categories": bridge}


def files_read(spark, root, name):
    return {r[0].split("/versions/")[1] for r in WH.tables(spark, root)[name].select(F.input_file_name()).distinct().collect()}


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "wh")
    WH.load_date(spark, curated(spark, D1), root, D1)
    before = {n: files_read(spark, root, n) for n in WH.DIMENSIONS}
    # the next date knows three users: only their totals change
    WH.load_date(spark, curated(spark, D2, users=[3, 4, 5]), root, D2)
    after = {n: files_read(spark, root, n) for n in WH.DIMENSIONS}
    for name in ("videos", "categories", "video_categories"):
        assert after[name] == before[name]
    moved = {f.split("bucket=")[1].split("/")[0] for f in before["users"] - after["users"]}
    buckets = spark.createDataFrame([(3,), (4,), (5,)], "user_id bigint").select(WH._bucket("users").cast("string")).distinct()
    assert moved == {r[0] for r in buckets.collect()} and before["users"] & after["users"]
    users = {r["user_id"]: r["total_events"] for r in WH.tables(spark, root)["users"].collect()}
    assert users == {u: 1 + (u in (3, 4, 5)) for u in range(USERS)}
    # the same date again, then empty: totals follow without a look at other dates
    WH.load_date(spark, curated(spark, D2, users=[4]), root, D2)
    assert sum(r["total_events"] for r in WH.tables(spark, root)["users"].collect()) == USERS + 1
    WH.load_date(spark, curated(spark, D2, users=[]), root, D2)
    assert sum(r["total_events"] for r in WH.tables(spark, root)["users"].collect()) == USERS


def test_buckets_equal_the_plain_upsert(spark, tmp_path):
    root = str(tmp_path / "wh")
    first, second = curated(spark, D1), curated(spark, D2, city="Wuhan")
    second["users"] = second["users"].where("user_id % 5 = 0").unionByName(second["users"].limit(1).withColumn("user_id", F.lit(500).cast("bigint")))
    second["interactions_curated"] = second["interactions_curated"].where("user_id % 5 = 0")
    second["daily_user_features"] = second["daily_user_features"].where("user_id % 5 = 0")
    WH.load_date(spark, first, root, D1)
    old = spark.createDataFrame(WH.tables(spark, root)["users"].collect(), WH.tables(spark, root)["users"].schema)
    WH.load_date(spark, second, root, D2)
    columns = WH.USER_COLUMNS
    want = W.upsert(old.select(*columns), WH.narrow(second["users"], "users"), columns, ["user_id"])
    got = WH.tables(spark, root)["users"].select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    """A second load is published while the first one is being checked: the first starts again and loses nothing."""
    root, real, seen = str(tmp_path / "wh"), WH.constraints.constraint_violations, []

    def meanwhile(new):
        if not seen:
            seen.append(1)
            WH.load_date(spark, curated(spark, D2, city="Wuhan", users=[1, 2]), root, D2)
        return real(new)

    monkeypatch.setattr(WH.constraints, "constraint_violations", meanwhile)
    stats = WH.load_date(spark, curated(spark, D1), root, D1)
    found = WH.tables(spark, root)
    assert stats["interactions_curated"] == USERS and found["interactions_curated"].count() == USERS + 2
    assert {r["user_id"]: r["total_events"] for r in found["users"].collect()} == {u: 1 + (u in (1, 2)) for u in range(USERS)}
    assert [os.path.basename(f) for f in sorted(glob.glob(f"{root}/manifest/*.json"))] == ["000000000001.json", "000000000002.json"]


def test_a_load_that_is_always_overtaken_publishes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    monkeypatch.setattr(W, "publish_once", lambda *a: False)
    monkeypatch.setattr(WH, "ATTEMPTS", 2)
    with pytest.raises(WH.Conflict):
        WH.load_date(spark, curated(spark, D1, users=[1]), root, D1)
    assert WH.tables(spark, root) == {}


def test_publish_once(spark, tmp_path):
    path = str(tmp_path / "m" / "manifest" / "1.json")
    assert W.publish_once(spark, path, "first") and not W.publish_once(spark, path, "second")
    assert open(path).read() == "first" and os.listdir(tmp_path / "m" / "_pending") == []
