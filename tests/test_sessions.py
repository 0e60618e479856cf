"""Session boundaries and daily features against hand-computed values and a brute-force loop."""

import random
from collections import defaultdict

import pytest

from daybrook.operators import sessions
from daybrook.params import Params
from tests.conftest import DAY1, events_df


def features(spark, rows, params=Params()):
    return {r["user_id"]: r for r in sessions.daily_user_features(events_df(spark, rows), params).collect()}


GAP = Params().session_gap_seconds
START, VIEW = 40_000, 37  # a view from START to START + VIEW


@pytest.mark.parametrize("gap", [GAP, 60])
@pytest.mark.parametrize("pause, joined", [(0, True), (-VIEW, True), (-1, True), (1, True), ("gap", True), ("gap+1", False)])
def test_a_view_joins_up_to_the_gap_after_the_last_end(spark, gap, pause, joined):
    """The second view starts ``pause`` seconds after the first one's end; -VIEW is the same second."""
    pause = {"gap": gap, "gap+1": gap + 1}.get(pause, pause)
    rows = [(5, START, VIEW, 9), (5, START + VIEW + pause, 11, 9)]
    f = features(spark, rows, Params(session_gap_seconds=gap))[5]
    want = (1, VIEW + 11, VIEW + 11.0) if joined else (2, VIEW, (VIEW + 11) / 2)
    assert (f["n_sessions"], f["max_session_seconds"], f["avg_session_seconds"]) == want


def test_the_longest_end_counts_not_the_last(spark):
    """A long view spans a short one; what starts within the gap after the long one's end still joins it."""
    long = 3 * GAP
    base = [(5, START, long, 9), (5, START + 10, 1, 9)]
    assert features(spark, base + [(5, START + long + GAP, 2, 9)])[5]["n_sessions"] == 1
    assert features(spark, base + [(5, START + long + GAP + 1, 2, 9)])[5]["n_sessions"] == 2


def test_other_users_do_not_bridge_a_gap(spark):
    """User 6 watches in the middle of user 5's pause."""
    far = START + VIEW + GAP + 1
    f = features(spark, [(5, START, VIEW, 9), (6, START + GAP // 2, GAP, 9), (5, far, 1, 9)])
    assert {u: r["n_sessions"] for u, r in f.items()} == {5: 2, 6: 1}


def test_late_night_takes_its_two_end_hours(spark):
    p = Params()
    rows = [(100 + h, START, 1, h) for h in range(24)]
    late = {u - 100 for u, r in features(spark, rows).items() if r["late_night_events"]}
    assert late == set(range(p.late_night_start_hour, p.late_night_end_hour + 1))


def test_shares_are_of_seconds_and_rates_of_events(spark):
    first, last = Params().late_night_start_hour, Params().late_night_end_hour
    f = features(spark, [(5, START, 12, first, True, False), (5, START + 1, 4, last, False, True), (5, START + 2, 48, last + 1, True, True)])[5]
    assert (f["late_night_events"], f["late_night_watch_seconds"], f["total_watch_seconds"]) == (2, 16, 64)
    assert (f["late_night_share"], f["hate_rate"], f["rewatch_rate"]) == (0.25, 2 / 3, 2 / 3)


def test_a_day_without_seconds_has_no_share(spark):
    f = features(spark, [(5, START, 0, 2)])[5]
    assert f["late_night_share"] is None and (f["n_sessions"], f["max_session_seconds"], f["late_night_events"]) == (1, 0, 1)


def brute_force(rows, gap=900):
    """Row by row: running maximum of view ends per user, in (time, pid) order."""
    ids, by_user = {}, defaultdict(list)
    for i, (u, t, w, *_rest) in enumerate(rows):
        by_user[u].append((t, 1000 + i, w))
    for u, evs in by_user.items():
        end, sid = None, 0
        for t, pid, w in sorted(evs):
            if end is None or t - end > gap:
                sid += 1
            end = t + w if end is None else max(end, t + w)
            ids[(u, pid, t)] = sid
    return ids


@pytest.mark.parametrize("seed, low", [(1, 0), (2, 0), (3, -3000)])
def test_sessions_equal_brute_force(spark, seed, low):
    """Many events share a second; with a negative lower bound even views that end long before they start."""
    rng = random.Random(seed)
    rows = [(rng.randint(1, 3), 1000 * rng.randint(0, 12) + rng.randint(0, 1), rng.randint(low, 1500), 5)
            for _ in range(300)]
    got = {(r["user_id"], r["pid"], r["exposed_time"]): r["session_id"]
           for r in sessions.assign_sessions(events_df(spark, rows)).collect()}
    want = brute_force(rows)
    assert got == want
    per = defaultdict(int)
    for (u, pid, t), sid in want.items():
        per[(u, sid)] += rows[pid - 1000][2]
    f = {r["user_id"]: r for r in sessions.daily_user_features(events_df(spark, rows)).collect()}
    for u in f:
        lengths = [v for (uu, _), v in per.items() if uu == u]
        assert f[u]["n_sessions"] == len(lengths)
        assert f[u]["max_session_seconds"] == max(lengths)


def test_hot_user_day_reaches_the_window_as_seconds(spark):
    """Two hundred thousand events in one user-day, at most 2,000 distinct seconds."""
    df = spark.range(200_000).selectExpr(
        "CAST(7 AS BIGINT) AS user_id", "id AS pid", "id % 2000 AS exposed_time", "CAST(1 AS BIGINT) AS watch_time",
        "CAST(3 AS BIGINT) AS p_hour", f"DATE '{DAY1}' AS p_date", "id % 10 = 0 AS hate", "false AS is_rewatch_flagged")
    seconds = sessions._per_second(df, Params())
    assert seconds.count() == 2000
    f = sessions.daily_user_features(df).first()
    assert (f["n_events"], f["hate_events"], f["n_sessions"], f["total_watch_seconds"]) == (200_000, 20_000, 1, 200_000)


def test_order_of_input_does_not_matter(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 4), rng.randint(0, 20_000), rng.randint(0, 900), rng.randint(0, 23)) for _ in range(200)]
    df = events_df(spark, rows)
    a = sorted(map(tuple, sessions.daily_user_features(df).collect()))
    b = sorted(map(tuple, sessions.daily_user_features(df.orderBy("pid", ascending=False)).collect()))
    assert a == b and sum(r[2] for r in a) == len(rows)
