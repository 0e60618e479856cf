"""Dimensions by date against a rebuild from all rows."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from daybrook.plans import curate, dimensions as D, stage
from daybrook.schemas import USER_ATTRIBUTES

EVENTS = ("user_id bigint, pid bigint, exposed_time bigint, p_date date, title string, author_id bigint, duration double, "
          "gender string, age bigint, mod_price bigint, fre_city string, fre_community_type string, fre_city_level string")


def day(k):
    return dt.date(2022, 9, 1) + dt.timedelta(days=k)


def day_rows(rng, k, n=40):
    return [(u := rng.randrange(12), rng.randrange(15), 1000 * k + i, day(k), rng.choice(["a", "b", "c", None]), rng.randrange(3),
             float(rng.randrange(4)), "M", 20 + k, rng.randrange(3), f"city{u}", "城区", "一线城市") for i in range(n)]


def pairs_of(rows):
    return sorted({(p, p % 4 + u % 2, d) for u, p, _, d, *_ in rows})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rebuilt(spark, rows):
    events = spark.createDataFrame(rows, EVENTS)
    pairs = spark.createDataFrame(pairs_of(rows), "pid bigint, category_id bigint, p_date date")
    videos = curate.dim_videos(events, stage.no_transcripts(spark)).select("pid", "title", "author_id", "duration")
    return {"users": rows_of(curate.dim_users(events)), "videos": rows_of(videos), "video_categories": rows_of(curate.dim_video_categories(pairs))}


def followed(spark, root, rows, dates):
    """All three dimensions after some dates changed; ``rows`` holds every date's current rows."""
    events = spark.createDataFrame(rows, EVENTS)
    pairs = spark.createDataFrame(pairs_of(rows), "pid bigint, category_id bigint, p_date date")
    return {d.name: rows_of(D.Store(spark, root, d).follow(pairs if d is D.BRIDGE else events, [str(day(k)) for k in dates]))
            for d in D.DIMENSIONS.values()}


@pytest.mark.parametrize("seed", [1, 2])
def test_dates_in_any_order(spark, tmp_path, seed):
    rng, now = random.Random(seed), {}
    # on time, late, replaced, two at once, emptied, and the same date twice
    for changed in ([3], [4], [1], [3], [2, 4], [4], [4], [1, 3]):
        for k in changed:
            now[k] = [] if rng.random() < 0.25 else day_rows(rng, k, rng.randrange(1, 40))
        rows = [r for part in now.values() for r in part]
        assert followed(spark, str(tmp_path), rows, changed) == rebuilt(spark, rows)


def test_rebuild_then_follow(spark, tmp_path):
    rng = random.Random(5)
    now = {k: day_rows(rng, k) for k in range(4)}
    rows = [r for part in now.values() for r in part]
    for dim in (D.USERS, D.VIDEOS):
        D.Store(spark, str(tmp_path), dim).rebuild(spark.createDataFrame(rows, EVENTS))
    D.Store(spark, str(tmp_path), D.BRIDGE).rebuild(spark.createDataFrame(pairs_of(rows), "pid bigint, category_id bigint, p_date date"))
    now[3] = []
    rows = [r for part in now.values() for r in part]
    assert followed(spark, str(tmp_path), rows, [3]) == rebuilt(spark, rows)


def test_other_dates_are_not_read(spark, tmp_path):
    """Events of other dates may be gone, and parts are read only of dates that a key falls back to."""
    rng = random.Random(6)
    now = {k: [(r[0] + 100 * k, r[1] + 100 * k, *r[2:]) for r in day_rows(rng, k)] for k in range(4)}
    now[3] += [(*now[1][0][:2], 9999, day(3), *now[1][0][4:])]  # one key that dates 1 and 3 share
    rows = [r for part in now.values() for r in part]
    want = rebuilt(spark, [r for r in rows if r[3] != day(3)])["users"]
    store = D.Store(spark, str(tmp_path / "dims"), D.USERS)
    spark.createDataFrame(rows, EVENTS).write.partitionBy("p_date").parquet(str(tmp_path / "events"))
    events = lambda: spark.read.schema(EVENTS).parquet(str(tmp_path / "events"))
    store.rebuild(events())
    for k in (0, 2):
        shutil.rmtree(tmp_path / "dims" / "users" / "parts" / f"p_date={day(k)}")
    for k in (0, 1, 2, 3):
        shutil.rmtree(tmp_path / "events" / f"p_date={day(k)}")
    left = spark.createDataFrame([], EVENTS)
    assert rows_of(store.follow(left, [str(day(3))])) == want


def test_state_names_the_dates(spark):
    rows = spark.createDataFrame([(1, 5, 10, day(0)), (1, 5, 11, day(2)), (2, 5, 12, day(2))], "user_id bigint, pid bigint, exposed_time bigint, p_date date")
    rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in USER_ATTRIBUTES])
    state = {r["user_id"]: r["dates"] for r in D.state_of(D.USERS, D.contributions(D.USERS, rows)).collect()}
    assert state == {1: [day(0), day(2)], 2: [day(2)]}


def test_pairs_follow_without_stored_copies(spark, tmp_path, monkeypatch):
    """Without attributes a key falls back by the dates it is known in: nothing is stored but parts and state."""
    monkeypatch.setattr(D, "materialize", lambda df, name: pytest.fail(f"{name} is stored"))
    schema = "pid bigint, category_id bigint, p_date date"
    store = D.Store(spark, str(tmp_path / "dims"), D.BRIDGE)
    store.rebuild(spark.createDataFrame([(1, 1, day(0)), (1, 2, day(0)), (2, 1, day(2))], schema))
    new = spark.createDataFrame([(1, 1, day(3)), (3, 3, day(3))], schema)
    assert rows_of(store.follow(new, [str(day(3))])) == [(1, 1), (1, 2), (2, 1), (3, 3)]
    state = {(r["pid"], r["category_id"]): (r["top"]["p_date"], r["dates"]) for r in store.state(new).collect()}
    assert state[1, 1] == (day(3), [day(0), day(3)])
    assert rows_of(store.follow(new.where("false"), [str(day(3))])) == [(1, 1), (1, 2), (2, 1)]
    state = {(r["pid"], r["category_id"]): (r["top"]["p_date"], r["dates"]) for r in store.state(new).collect()}
    assert state == {(1, 1): (day(0), [day(0)]), (1, 2): (day(0), [day(0)]), (2, 1): (day(2), [day(2)])}
    assert sorted(p.name for p in (tmp_path / "dims" / "video_categories").iterdir() if p.is_dir()) == ["parts", "state"]
