"""Quantiles, screening, reports and profiles against plain Python."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybrook.operators.quantiles import quantiles
from daybrook.plans import analytics as A, profile as P, reports as Q
from tests.conftest import D1, D2, T0, files_df, lookup_df, raw_df, raw_row, two_days

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("values", [
    [5], [1, 2], [0, 1, 2, 3], [7] * 50 + [1], list(range(1000)),
    [random.Random(1).randint(0, 30) for _ in range(3000)],
    [random.Random(2).gauss(0, 1e6) for _ in range(3000)], [1e18] + list(range(700)),
])
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = {r["q"]: r["quantile"] for r in quantiles(df, ["x"], QS).collect()}
    want = dict(zip(QS, np.quantile(np.array(values, dtype=float), QS)))
    assert got == pytest.approx(want, rel=1e-12, abs=1e-9)


def feats(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, feature_date string, n_events bigint, total_watch_seconds bigint, "
                                       "late_night_share double, hate_rate double, max_session_seconds bigint, hate_events bigint"
                                 ).withColumn("feature_date", F.to_date("feature_date"))


def sample(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        w = rng.randint(0, 500)
        rows.append((i % 60, f"2024-01-0{1 + i // 60}", rng.randint(1, 6), w, None if w == 0 or i % 7 == 0 else rng.random(),
                     rng.choice([0.0, 0.0, 0.5]), w // 2, rng.randint(0, 1)))
    return rows, feats(spark, rows)


def test_summary_and_flags(spark):
    rows, df = sample(spark)
    s = A.usage_summary(df).first()
    w = [r[3] for r in rows]
    cut = float(np.quantile(w, 0.75))
    flags = [(r[3] > cut) + (r[5] > 0.01) + (r[4] is not None and r[4] > 0.10) for r in rows]
    assert s["watch_cutoff_seconds"] == cut and s["median_daily_watch_seconds"] == statistics.median(w)
    assert s["avg_daily_watch_seconds"] == pytest.approx(statistics.mean(w))
    assert [s["flag_any_1plus"], s["flag_2plus"], s["flag_all_3"]] == [sum(f >= k for f in flags) for k in (1, 2, 3)]
    assert s["no_watch_time_user_days"] == sum(r[4] is None for r in rows)
    heavy = [r for r in rows if r[4] is not None and r[4] > 0.5]
    assert (s["late_night_heavy_user_days"], s["late_night_heavy_distinct_users"]) == (len(heavy), len({r[0] for r in heavy}))
    assert {r[0]: r[1] for r in A.flag_levels(df).collect()} == {k: flags.count(k) for k in range(4)}
    assert A.risk_scores(df).count() == sum(f >= 1 for f in flags)


def test_histogram_puts_the_maximum_into_the_last_bin(spark):
    rows, df = sample(spark)
    pos = [r[3] for r in rows if r[3] > 0]
    counts, edges = np.histogram(pos, bins=60)
    got = {r["bin"]: (r["user_days"], r["bin_start"]) for r in A.watch_histogram(df).collect()}
    assert sum(v[0] for v in got.values()) == len(pos) and got[59][0] >= 1
    assert [got[i][0] for i in range(60)] == list(counts)
    assert [got[i][1] for i in range(60)] == pytest.approx(list(edges[:-1]))


def test_expected_rows(spark):
    _, df = sample(spark)
    assert A.expect_rows(df, 200) == 200
    with pytest.raises(AssertionError, match="expected 5"):
        A.expect_rows(df, 5)


def test_reports(spark):
    rows, df = sample(spark)
    top = Q.late_night_top(spark, df, "2024-01-01").collect()
    want = sorted(((round(r[4], 3), r[2], -r[0]) for r in rows if r[1] == "2024-01-01" and r[2] >= 5 and r[4] is not None), reverse=True)[:10]
    assert [(r["late_night_share"], r["n_events"], -r["user_id"]) for r in top] == want
    cut = np.quantile([r[6] for r in rows], 0.9)
    q2 = Q.long_sessions_with_hate(df).collect()
    assert len(q2) == min(10, sum(r[6] >= cut and r[7] >= 1 for r in rows)) and all(r["max_session_seconds"] >= cut for r in q2)


def test_sql_text_over_views(spark):
    rows, df = sample(spark)
    Q.register_views({"daily_user_features": df})
    got = spark.sql("SELECT count(*) AS n, percentile_cont(0.5) WITHIN GROUP (ORDER BY n_events) AS m FROM daily_user_features").first()
    assert (got["n"], got["m"]) == (200, statistics.median(r[2] for r in rows))


def test_category_hours_count_each_category(spark):
    ev = spark.createDataFrame([(1, 10, 3600), (2, 10, 1800), (1, 11, 360)], "user_id bigint, pid bigint, watch_time bigint")
    bridge = spark.createDataFrame([(10, 1), (10, 2), (10, 3), (11, 2)], "pid bigint, category_id bigint")
    cats = spark.createDataFrame([(1, 1, "a", "A"), (2, 1, "b", "B"), (3, 2, "c", "C")],
                                 "category_id bigint, category_level bigint, category_name_en string, category_name_cn string")
    got = [(r["category_name_en"], r["users"], r["watch_hours"]) for r in Q.top_categories(ev, bridge, cats).collect()]
    assert got == [("b", 2, 1.6), ("a", 2, 1.5)]


def test_sparse_flags(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    ev = spark.createDataFrame([(1,)] * 5 + [(2,)] * 4, "user_id bigint")
    got = {r[0]: (r["total_events"], r["is_sparse_history"]) for r in Q.sparse_flags(users, ev).collect()}
    assert got == {1: (5, False), 2: (4, True), 3: (0, True)}


def test_profile_of_two_days(spark):
    raw = raw_df(spark, two_days() + [raw_row(pid="x1", title="a\nb", p_hour=11, p_date=D2, watch_time="bad")])
    prof = {r["column_name"]: r for r in P.column_profile(raw).collect()}
    assert prof["fre_city_level"]["unknown"] == 1 and prof["pid"]["non_numeric"] == 1 and prof["title"]["non_numeric"] is None
    w = [25, 25, 8, 8, 95, 10, 25, 8, 30]
    assert prof["watch_time"]["mean"] == statistics.mean(w) and prof["watch_time"]["std"] == pytest.approx(statistics.stdev(w))
    assert prof["watch_time"]["p90"] == pytest.approx(float(np.quantile(w, 0.9)))
    d = P.dataset_profile(raw).first()
    assert (d["n_rows"], d["exact_duplicate_rows"], d["p_date_min"], d["p_date_max"]) == (10, 1, D1, D2) and d["schema_matches"]
    assert {r[0] for r in P.hours(raw).where("present").collect()} == {3, 11, 12}
    assert P.row_flags(raw).first()["rows_with_newline_in_title"] == 1
    clean = raw.where("pid <> 'x1'")
    e = P.rows_per_event(clean).first()
    assert (e["unique_events"], e["max"], e["rows_1"], e["rows_2"], e["rows_3"]) == (6, 3, 4, 1, 1)
    assert [tuple(r) for r in P.multi_partition_events(clean).collect()] == [(11, 300, T0 + 7200, 2)]


def test_time_consistency(spark):
    raw = raw_df(spark, [raw_row(exposed_time=T0, p_date=D1, p_hour=10), raw_row(exposed_time=T0, p_date=D1, p_hour=18),
                         raw_row(exposed_time=1663344000, p_date="20220917", p_hour=0)])
    t = P.time_consistency(raw).first()
    assert (t["date_equals_utc"], t["date_equals_offset"], t["hour_equals_utc"], t["hour_equals_offset"]) == (2, 3, 1, 2)


def test_lookup_and_transcript_profiles(spark):
    look = lookup_df(spark, [("1", "7", "a", "1", "1", " x"), ("2", "7", "a", "1", "1", "y"), ("2", "8", "a", "1", "1", " ")])
    r = P.lookup_profile(look).first()
    assert (r["n_rows"], r["distinct_ids"], r["repeated_ids"], r["rows_with_repeated_id"], r["blank_labels"],
            r["labels_with_leading_space"]) == (3, 2, 1, 2, 1, 1)
    pids = spark.createDataFrame([(300,), (300,), (5,)], "pid bigint")
    t = P.transcript_profile(files_df(spark), pids).first()
    assert (t["files"], t["non_numeric_names"], t["matching_a_video"], t["not_matching"], t["video_coverage"]) == (3, 1, 1, 1, 0.5)


def test_watch_hours_of_any_size(spark):
    """Sums of seconds near the limit of a 64-bit integer, and ties of the rounding."""
    from daybrook.plans import reports
    events = spark.createDataFrame([(1, 1, 3_600_000_000_000_000), (2, 2, 180), (3, 3, 179)], "pid bigint, user_id bigint, watch_time bigint")
    bridge = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "pid bigint, category_id bigint")
    cats = spark.createDataFrame([(i, 1, f"c{i}", f"c{i}") for i in (1, 2, 3)], "category_id bigint, category_level bigint, category_name_en string, category_name_cn string")
    got = [(r["category_name_en"], r["watch_hours"]) for r in reports.top_categories(events, bridge, cats).collect()]
    assert got == [("c1", 1e12), ("c2", 0.1), ("c3", 0.0)]
