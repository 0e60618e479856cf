"""Typing, staging, sessions, features and dimensions over the driver's tables."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.catalog.inputs_sql import sessions as session_sql
from daybrook.functions import columns as C
from daybrook.operators import dedup, events as E, sessions
from daybrook.plans import curate, stage
from daybrook.schemas import EVENT_KEY, RAW_COLUMNS


@query("exact_dedup", "SELECT DISTINCT * FROM raw")
def exact_dedup(spark, sf):
    return dedup.drop_exact_duplicates(I.landed_raw(spark, sf), stored=True)


@query("duplicate_share", """
SELECT p_date, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS distinct_rows,
       CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_rows,
       CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS exact_duplicate_share
FROM (SELECT *, count(*) AS n FROM raw GROUP BY ALL) GROUP BY p_date""")
def duplicate_share(spark, sf):
    return dedup.duplicate_stats(I.landed_raw(spark, sf), ["p_date"])


@query("typed_events", """
SELECT * EXCLUDE (owner, category_id, tag_name) FROM typed""")
def typed_events(spark, sf):
    d = dedup.drop_exact_duplicates(I.landed_raw(spark, sf), stored=True)
    return E.type_rows(d, [c for c in RAW_COLUMNS if c not in (
        "category_id", "category_level", "parent_id", "root_id", "tag_name")])


@query("event_collapse", "SELECT * FROM staged")
def event_collapse(spark, sf):
    return stage.stage_events(I.raw_interactions(spark, sf)).drop("ingest_batch_id", "staged_at")


@query("staged_lineage_columns", """
SELECT user_id, pid, exposed_time, p_date, 'batch-7' AS ingest_batch_id, '2024-02-01T00:00:00+00:00' AS staged_at FROM staged""")
def staged_lineage_columns(spark, sf):
    """Every staged event names the batch it came from and when it was staged."""
    staged = stage.stage_events(I.landed_raw(spark, sf), batch_id="batch-7", staged_at="2024-02-01T00:00:00+00:00")
    return staged.select(*EVENT_KEY, "p_date", "ingest_batch_id", "staged_at")


@query("tag_count", """
SELECT user_id, pid, exposed_time, p_date, count(DISTINCT tag_name) AS tag_count FROM typed GROUP BY ALL""")
def tag_count(spark, sf):
    return E.collapse(E.type_rows(I.raw_interactions(spark, sf))).select(*EVENT_KEY, "p_date", "tag_count")


@query("video_category_pairs", "SELECT * FROM pairs")
def video_category_pairs(spark, sf):
    return stage.stage_category_pairs(I.raw_interactions(spark, sf))


@query("stage_stats", """
SELECT r.p_date, raw_rows, exact_duplicate_rows_dropped, events_in_partition,
       events_in_partition - coalesce(staged_events, 0) AS events_owned_by_earlier_partition,
       coalesce(staged_events, 0) AS staged_events, coalesce(video_category_pairs, 0) AS video_category_pairs,
       coalesce(rewatch_flagged_events, 0) AS rewatch_flagged_events, coalesce(hate_events, 0) AS hate_events
FROM (SELECT CAST(strptime(p_date, '%Y%m%d') AS DATE) AS p_date, CAST(sum(n) AS BIGINT) AS raw_rows,
             CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_rows_dropped
      FROM (SELECT *, count(*) AS n FROM raw GROUP BY ALL) GROUP BY 1) r
JOIN (SELECT p_date, count(*) AS events_in_partition FROM
        (SELECT DISTINCT p_date, user_id, pid, exposed_time FROM typed) GROUP BY 1) s ON r.p_date = s.p_date
LEFT JOIN (SELECT p_date, count(*) AS staged_events, count(*) FILTER (WHERE is_rewatch_flagged) AS rewatch_flagged_events,
             count(*) FILTER (WHERE hate) AS hate_events FROM staged GROUP BY 1) o ON r.p_date = o.p_date
LEFT JOIN (SELECT p_date, count(*) AS video_category_pairs FROM pairs GROUP BY 1) c ON r.p_date = c.p_date""")
def stage_stats(spark, sf):
    raw = I.landed_raw(spark, sf)
    return stage.stage_statistics(raw, stage.stage_events(raw), stage.stage_category_pairs(raw))


@query("watch_ratio_rewatch", """
SELECT user_id, pid, exposed_time, watch_time / duration AS watch_ratio, watch_time > duration AS is_rewatch_flagged,
       watch_time > 2 * duration AS is_double_watch, exposed_time + watch_time AS end_time FROM ev""")
def watch_ratio_rewatch(spark, sf):
    from daybrook.params import Params
    return I.daily_events(spark, sf).select(
        *EVENT_KEY, C.watch_ratio().alias("watch_ratio"), C.is_rewatch().alias("is_rewatch_flagged"),
        C.is_rewatch(Params(rewatch_ratio=2.0)).alias("is_double_watch"),
        (F.col("exposed_time") + F.col("watch_time")).alias("end_time"))


@query("late_night_cond", """
SELECT user_id, pid, exposed_time, p_hour BETWEEN 2 AND 4 AS is_late_night,
       CASE WHEN p_hour BETWEEN 2 AND 4 THEN watch_time ELSE 0 END AS late_watch FROM ev""")
def late_night_cond(spark, sf):
    return I.daily_events(spark, sf).select(
        *EVENT_KEY, C.late_night().alias("is_late_night"),
        F.when(C.late_night(), F.col("watch_time")).otherwise(F.lit(0)).alias("late_watch"))


@query("guarded_share", """
SELECT pid, p_hour, CAST(sum(watch_time) AS BIGINT) AS total, CAST(sum(CASE WHEN hate THEN watch_time ELSE 0 END) AS BIGINT) AS part,
       CASE WHEN sum(watch_time) > 0 THEN CAST(sum(CASE WHEN hate THEN watch_time ELSE 0 END) AS DOUBLE) / CAST(sum(watch_time) AS DOUBLE) END AS share
FROM ev GROUP BY pid, p_hour""")
def guarded_share(spark, sf):
    return I.daily_events(spark, sf).groupBy("pid", "p_hour").agg(
        F.sum("watch_time").alias("total"),
        F.sum(F.when(F.col("hate"), F.col("watch_time")).otherwise(F.lit(0))).alias("part"),
    ).withColumn("share", C.share("part", "total"))




@query("session_ids", f"SELECT user_id, pid, exposed_time, p_date, session_id FROM ({session_sql('ev')})")
def session_ids(spark, sf):
    return sessions.assign_sessions(I.daily_events(spark, sf)).select(*EVENT_KEY, "p_date", "session_id")


@query("session_summary", f"""
SELECT user_id, p_date, session_id, count(*) AS n_events, CAST(sum(watch_time) AS BIGINT) AS session_seconds,
       min(exposed_time) AS session_start, max(exposed_time + watch_time) AS session_end
FROM ({session_sql('ev')}) GROUP BY user_id, p_date, session_id""")
def session_summary(spark, sf):
    return sessions.session_summary(I.daily_events(spark, sf))


@query("daily_user_features", "SELECT * FROM feat")
def daily_user_features(spark, sf):
    return sessions.daily_user_features(I.daily_events(spark, sf))


@query("staged_user_features", "SELECT * FROM staged_feat")
def staged_user_features(spark, sf):
    """Raw text to features in one lazy plan."""
    return curate.daily_features(stage.stage_events(I.raw_interactions(spark, sf)))


@query("curated_events", """
SELECT user_id, pid, exposed_time, p_date, p_hour, author_fans_count, watch_time, watch_ratio, is_rewatch_flagged,
       tag_count, cvm_like, click, comment, follow, "collect", forward, hate, ingest_batch_id FROM ev""")
def curated_events(spark, sf):
    return curate.curated_events(I.daily_events(spark, sf))


@query("dim_users_latest", "SELECT * FROM dim_users")
def dim_users_latest(spark, sf):
    return curate.dim_users(stage.stage_events(I.raw_interactions(spark, sf)))


@query("dim_videos_first", "SELECT * FROM dim_videos")
def dim_videos_first(spark, sf):
    raw = stage.stage_events(I.raw_interactions(spark, sf))
    return curate.dim_videos(raw, stage.no_transcripts(spark)).drop("has_transcript", "transcript_word_count")


@query("dim_video_categories", "SELECT * FROM dim_bridge")
def dim_video_categories(spark, sf):
    return curate.dim_video_categories(stage.stage_category_pairs(I.raw_interactions(spark, sf)))


@query("videos_with_transcripts", "SELECT * FROM videos_full")
def videos_with_transcripts(spark, sf):
    raw = stage.stage_events(I.raw_interactions(spark, sf))
    return curate.dim_videos(raw, stage.stage_transcripts(I.transcripts(spark, sf)))


@query("category_rules", "SELECT * FROM dim_part_cats")
def category_rules(spark, sf):
    return stage.stage_categories(I.raw_part_categories(spark, sf))


@query("transcript_word_count", "SELECT * FROM dim_transcripts")
def transcript_word_count(spark, sf):
    return stage.stage_transcripts(I.transcripts(spark, sf))
