"""Analysis, screening and the representative queries over the driver's tables."""


from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.functions import columns as C
from daybrook.operators import sessions
from daybrook.operators.quantiles import quantiles
from daybrook.plans import analytics as A, curate, lineage, reports as Q, stage
from daybrook.session import materialize

DAY = "2024-01-15"
USER = 7


def _feat(spark, sf):
    return sessions.daily_user_features(I.daily_events(spark, sf))


def _stored_feat(spark, sf):
    """The feature table as the analysis reads it: stored once, scanned by every aggregate."""
    return materialize(_feat(spark, sf), "features")


_CUT = "(SELECT quantile_cont(total_watch_seconds, 0.75) FROM feat)"
_FLAGS = f"""
SELECT *, CAST(high_watch AS INT) + CAST(high_hate AS INT) + CAST(late_night AS INT) AS n_flags FROM (
  SELECT *, total_watch_seconds > {_CUT} AS high_watch, hate_rate > 0.01 AS high_hate,
         coalesce(late_night_share > 0.10, false) AS late_night FROM feat)"""


@query("usage_summary", f"""
SELECT count(*) AS user_day_records, count(DISTINCT user_id) AS distinct_users,
       max(max_session_seconds) AS max_session_seconds, count(*) FILTER (WHERE late_night_share IS NULL) AS no_watch_time_user_days,
       count(*) FILTER (WHERE late_night_share > 0.5) AS late_night_heavy_user_days,
       count(DISTINCT user_id) FILTER (WHERE late_night_share > 0.5) AS late_night_heavy_distinct_users,
       count(*) FILTER (WHERE n_flags >= 1) AS flag_any_1plus, count(*) FILTER (WHERE n_flags >= 2) AS flag_2plus,
       count(*) FILTER (WHERE n_flags = 3) AS flag_all_3, count(*) FILTER (WHERE high_watch) AS flag_high_watch,
       count(*) FILTER (WHERE high_hate) AS flag_hate_rate, count(*) FILTER (WHERE late_night) AS flag_late_night,
       CAST(sum(total_watch_seconds) AS DOUBLE) / count(*) AS avg_daily_watch_seconds,
       CAST(quantile_cont(total_watch_seconds, 0.5) AS DOUBLE) AS median_daily_watch_seconds,
       CAST(quantile_cont(total_watch_seconds, 0.9) AS DOUBLE) AS p90_daily_watch_seconds,
       CAST(quantile_cont(total_watch_seconds, 0.75) AS DOUBLE) AS watch_cutoff_seconds
FROM ({_FLAGS})""")
def usage_summary(spark, sf):
    return A.usage_summary(_stored_feat(spark, sf))


_QS = [0.0, 0.01, 0.5, 0.75, 0.9, 0.99, 1.0]


@query("exact_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST({q} AS DOUBLE) AS q, CAST(quantile_cont(CAST({c} AS DOUBLE), {q}) AS DOUBLE) AS quantile FROM lineitem"
    for c in ("l_extendedprice", "l_quantity", "l_orderkey") for q in _QS))
def exact_quantiles(spark, sf):
    """Interpolated quantiles of columns with few, many and only distinct values."""
    li = I.table(spark, sf, "lineitem")
    return quantiles(li, ["l_extendedprice", "l_quantity", "l_orderkey"], _QS)


@query("per_date_summary", """
SELECT feature_date, count(*) AS user_days, count(DISTINCT user_id) AS users,
       count(*) FILTER (WHERE late_night_share > 0.5) AS late_night_user_days,
       CAST(sum(total_watch_seconds) AS DOUBLE) / count(*) AS avg_watch FROM feat GROUP BY 1""")
def per_date_summary(spark, sf):
    return A.per_date_summary(_feat(spark, sf))


@query("screening_flags", f"SELECT user_id, feature_date, high_watch, high_hate, late_night, n_flags FROM ({_FLAGS})")
def screening_flags(spark, sf):
    return A.screening_flags(_stored_feat(spark, sf)).select("user_id", "feature_date", *A.FLAGS, "n_flags")


@query("risk_scores", f"""
SELECT user_id, feature_date AS score_date, CAST(n_flags AS DOUBLE) AS risk_score FROM ({_FLAGS}) WHERE n_flags >= 1""")
def risk_scores(spark, sf):
    return A.risk_scores(_stored_feat(spark, sf))


@query("flag_levels", f"""
SELECT l.n_flags, count(f.user_id) AS user_days FROM (SELECT CAST(range AS INT) AS n_flags FROM range(4)) l
LEFT JOIN ({_FLAGS}) f ON l.n_flags = f.n_flags GROUP BY 1""")
def flag_levels(spark, sf):
    return A.flag_levels(_stored_feat(spark, sf))


@query("watch_histogram", """
SELECT b.bin, count(f.v) AS user_days, any_value(b.lo) + (any_value(b.hi) - any_value(b.lo)) * b.bin / 60.0::DOUBLE AS bin_start
FROM (SELECT CAST(range AS INT) AS bin, lo, hi FROM range(60), (SELECT CAST(min(total_watch_seconds) AS DOUBLE) AS lo,
        CAST(max(total_watch_seconds) AS DOUBLE) AS hi FROM feat WHERE total_watch_seconds > 0)) b
LEFT JOIN (SELECT CAST(total_watch_seconds AS DOUBLE) AS v FROM feat WHERE total_watch_seconds > 0) f
  ON b.bin = least(CAST(floor((f.v - b.lo) * 60 / (b.hi - b.lo)) AS INT), 59)
GROUP BY b.bin""")
def watch_histogram(spark, sf):
    return A.watch_histogram(_stored_feat(spark, sf))


@query("daily_trends", """
SELECT feature_date, CAST(sum(total_watch_seconds) AS DOUBLE) / count(*) AS avg_watch_seconds,
       100.0::DOUBLE * count(*) FILTER (WHERE late_night_share > 0.5) / count(*) AS heavy_late_night_pct
FROM feat GROUP BY 1""")
def daily_trends(spark, sf):
    return A.daily_trends(_feat(spark, sf))


@query("coverage_missing_dates", """
SELECT DISTINCT p_date FROM raw WHERE p_date NOT IN (SELECT p_date FROM fanout)""")
def coverage_missing_dates(spark, sf):
    """Dates of the full raw delivery that a curated layer built without the moved copies does not have."""
    raw = I.raw_interactions(spark, sf)
    curated = _curated_dates(spark, sf)
    return A.missing_dates(raw.select("p_date"), curated)


def _curated_dates(spark, sf):
    return stage.stage_events(I.raw_fanout(spark, sf)).select(C.date_to_label("p_date").alias("p_date"))


@query("min_events_filter", """
SELECT user_id, feature_date, n_events, total_watch_seconds > cut AS high_watch
FROM feat, (SELECT quantile_cont(total_watch_seconds, 0.75) AS cut FROM feat WHERE n_events >= 3) WHERE n_events >= 3""")
def min_events_filter(spark, sf):
    kept = A.min_events(_stored_feat(spark, sf), 3)
    return A.screening_flags(kept).select("user_id", "feature_date", "n_events", "high_watch")


def _r(expr, digits):
    return Q.rounded(expr, digits)


@query("q1_late_night_top", f"""
SELECT user_id, feature_date, n_events, {_r('late_night_share', 3)} AS late_night_share FROM feat
WHERE feature_date = DATE '{DAY}' AND n_events >= 5 AND late_night_share IS NOT NULL
ORDER BY {_r('late_night_share', 3)} DESC, n_events DESC, user_id LIMIT 10""")
def q1_late_night_top(spark, sf):
    return Q.late_night_top(spark, _feat(spark, sf), DAY)


@query("q2_long_sessions_hate", """
SELECT user_id, feature_date, max_session_seconds, hate_events, n_events FROM feat
WHERE hate_events >= 1 AND max_session_seconds >= (SELECT quantile_cont(max_session_seconds, 0.9) FROM feat)
ORDER BY max_session_seconds DESC, user_id, feature_date LIMIT 10""")
def q2_long_sessions_hate(spark, sf):
    return Q.long_sessions_with_hate(_stored_feat(spark, sf))


_SPARSE = """SELECT u.*, CAST(coalesce(n, 0) AS INT) AS total_events, coalesce(n, 0) < 5 AS is_sparse_history
FROM users_typed u LEFT JOIN (SELECT user_id, count(*) AS n FROM ev GROUP BY 1) t ON u.user_id = t.user_id"""


@query("q3_late_night_by_tier", f"""
SELECT fre_city_level, gender, count(*) AS user_days, {_r('avg(late_night_share)', 4)} AS avg_late_night_share,
       {_r('avg(rewatch_rate)', 4)} AS avg_rewatch_rate
FROM feat JOIN ({_SPARSE}) USING (user_id) WHERE NOT is_sparse_history GROUP BY 1, 2""")
def q3_late_night_by_tier(spark, sf):
    users = Q.sparse_flags(I.users(spark, sf), I.daily_events(spark, sf))
    return Q.late_night_by_tier(spark, _feat(spark, sf), users)


@query("q4_hate_trend", f"""
SELECT p_date, count(*) AS events, CAST(sum(CAST(hate AS INT)) AS BIGINT) AS hate_events,
       {_r('100.0::DOUBLE * sum(CAST(hate AS INT)) / count(*)', 3)} AS hate_pct FROM ev GROUP BY 1""")
def q4_hate_trend(spark, sf):
    return Q.hate_trend(spark, I.daily_events(spark, sf))


@query("q5_top_categories", f"""
SELECT category_name_en, category_name_cn, count(DISTINCT user_id) AS users, {_r('sum(watch_time) / 3600.0::DOUBLE', 1)} AS watch_hours
FROM staged JOIN dim_bridge USING (pid) JOIN dim_cats USING (category_id) WHERE category_level = 1
GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""")
def q5_top_categories(spark, sf):
    raw = I.landed_raw(spark, sf)
    return Q.top_categories(stage.stage_events(raw), curate.dim_video_categories(stage.stage_category_pairs(raw)),
                            stage.stage_categories(I.raw_categories(spark, sf)))


@query("q6_event_trace", f"""
SELECT user_id, pid, exposed_time, p_date, watch_time, is_rewatch_flagged, ingest_batch_id FROM ev
WHERE user_id = {USER} ORDER BY exposed_time, pid LIMIT 5""")
def q6_event_trace(spark, sf):
    return Q.event_trace(spark, curate.curated_events(I.daily_events(spark, sf)), USER)


@query("rows_per_date", "SELECT p_date, count(*) AS n_rows FROM staged GROUP BY 1")
def rows_per_date(spark, sf):
    return Q.rows_per_date(stage.stage_events(I.raw_interactions(spark, sf)))


@query("sparse_users", _SPARSE)
def sparse_users(spark, sf):
    """Total events per user over every loaded date; customers without events count 0 and are sparse."""
    return Q.sparse_flags(I.users(spark, sf), I.daily_events(spark, sf))


@query("record_trace", """
SELECT r.*, s.p_date AS staged_date, s.tag_count, f.n_events AS feature_events
FROM (SELECT CAST(user_id AS BIGINT) AS user_id, CAST(pid AS BIGINT) AS pid, CAST(exposed_time AS BIGINT) AS exposed_time,
             count(*) AS raw_rows, count(DISTINCT p_date) AS raw_dates FROM raw GROUP BY 1, 2, 3) r
LEFT JOIN staged s ON r.user_id = s.user_id AND r.pid = s.pid AND r.exposed_time = s.exposed_time
LEFT JOIN staged_feat f ON s.user_id = f.user_id AND s.p_date = f.feature_date""")
def record_trace(spark, sf):
    """Every event across the layers: raw rows, owning date, staged row and the feature row it feeds."""
    raw = I.landed_raw(spark, sf)
    staged = materialize(stage.stage_events(raw), "staged")
    return lineage.record_trace(raw, staged, curate.daily_features(staged))
