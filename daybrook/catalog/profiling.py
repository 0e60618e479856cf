"""Source profiles and lineage counts over the driver's tables."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.functions import columns as C
from daybrook.operators import dedup
from daybrook.operators.events import type_rows
from daybrook.plans import curate, lineage, profile as P, stage
from daybrook.schemas import EVENT_KEY, RAW_COLUMNS
from daybrook.session import materialize

_STD_DIGITS = 2


def _sql_column_profile():
    out = []
    for c in RAW_COLUMNS:
        q = f'"{c}"'
        head = (f"SELECT '{c}' AS column_name, count(DISTINCT {q}) AS n_distinct, count(*) FILTER (WHERE trim({q}) = '') AS missing, "
                f"CAST(count(*) FILTER (WHERE trim({q}) = '') AS DOUBLE) / count(*) AS missing_share, "
                f"count(*) FILTER (WHERE {q} = 'unknown') AS unknown, ")
        if c in P.NUMERIC:
            v = f"CAST({q} AS DOUBLE)"
            out.append(head + f"count(*) FILTER (WHERE try_cast({q} AS DOUBLE) IS NULL) AS non_numeric, min({v}) AS min, max({v}) AS max, "
                       f"CAST(sum(CAST({q} AS DECIMAL(20,1))) AS DOUBLE) / count(*) AS mean, round(stddev_samp({v}), {_STD_DIGITS}) AS std, "
                       f"quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.9) AS p90, quantile_cont({v}, 0.99) AS p99 FROM raw")
        else:
            out.append(head + "CAST(NULL AS BIGINT) AS non_numeric, " + ", ".join(
                f"CAST(NULL AS DOUBLE) AS {n}" for n in ("min", "max", "mean", "std", "median", "p90", "p99")) + " FROM raw")
    return " UNION ALL ".join(out)


@query("profile_columns", _sql_column_profile())
def profile_columns(spark, sf):
    return P.column_profile(I.raw_interactions(spark, sf)).withColumn("std", F.round("std", _STD_DIGITS))


@query("profile_listed_values", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, "{c}" AS value, count(*) AS n FROM raw GROUP BY 2""" for c in P.LISTED))
def profile_listed_values(spark, sf):
    return P.listed_values(I.raw_interactions(spark, sf))


@query("profile_dataset", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, 28 AS n_columns, true AS schema_matches, CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_rows,
       CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS exact_duplicate_share, min(p_date) AS p_date_min, max(p_date) AS p_date_max
FROM (SELECT *, count(*) AS n FROM raw GROUP BY ALL)""")
def profile_dataset(spark, sf):
    return P.dataset_profile(I.landed_raw(spark, sf))


@query("profile_rows_per_partition", "SELECT p_date, count(*) AS n_rows FROM raw GROUP BY 1")
def profile_rows_per_partition(spark, sf):
    return P.rows_per_partition(I.raw_interactions(spark, sf))


@query("hours_absent", """
SELECT CAST(range AS INT) AS p_hour, CAST(range AS BIGINT) IN (SELECT p_hour * 2 % 24 FROM ev) AS present FROM range(24)""")
def hours_absent(spark, sf):
    """All events, their hours doubled: the odd hours are absent."""
    return P.hours(I.daily_events(spark, sf).withColumn("p_hour", F.col("p_hour") * 2 % 24))


def _broken_titles(spark, sf):
    return I.raw_interactions(spark, sf).withColumn(
        "title", F.when(F.col("tag_name").startswith("hot"), F.concat("title", F.lit("\nnext line"))).otherwise(F.col("title")))


@query("title_newline_rewatch", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE starts_with(tag_name, 'hot')) AS rows_with_newline_in_title,
       count(*) FILTER (WHERE CAST(watch_time AS DOUBLE) > CAST(duration AS DOUBLE)) AS rewatch_rows,
       CAST(count(*) FILTER (WHERE CAST(watch_time AS DOUBLE) > CAST(duration AS DOUBLE)) AS DOUBLE) / count(*) AS rewatch_share FROM raw""")
def title_newline_rewatch(spark, sf):
    return P.row_flags(_broken_titles(spark, sf))


_PER_EVENT = "SELECT user_id, pid, exposed_time, count(*) AS n, count(DISTINCT p_date) AS d FROM raw GROUP BY 1, 2, 3"


@query("rows_per_event", f"""
SELECT count(*) AS unique_events, min(n) AS min, max(n) AS max, count(*) FILTER (WHERE n = 1) AS rows_1,
       count(*) FILTER (WHERE n = 2) AS rows_2, count(*) FILTER (WHERE n = 3) AS rows_3, count(*) FILTER (WHERE n = 4) AS rows_4,
       count(*) FILTER (WHERE n >= 5) AS rows_5plus, CAST(sum(n) AS DOUBLE) / count(*) AS mean,
       CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median FROM ({_PER_EVENT})""")
def rows_per_event(spark, sf):
    return P.rows_per_event(I.raw_interactions(spark, sf))


@query("multi_partition_events", f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(pid AS BIGINT) AS pid, CAST(exposed_time AS BIGINT) AS exposed_time, d AS n_dates
FROM ({_PER_EVENT}) WHERE d > 1""")
def multi_partition_events(spark, sf):
    return P.multi_partition_events(I.raw_interactions(spark, sf))


@query("time_consistency", """
SELECT count(*) AS rows_compared, min(exposed_time) AS exposed_min, max(exposed_time) AS exposed_max,
       count(*) FILTER (WHERE p_date = CAST(make_timestamp(exposed_time * 1000000) AS DATE)) AS date_equals_utc,
       count(*) FILTER (WHERE p_date = CAST(make_timestamp((exposed_time + 28800) * 1000000) AS DATE)) AS date_equals_offset,
       count(*) FILTER (WHERE p_hour = hour(make_timestamp(exposed_time * 1000000))) AS hour_equals_utc,
       count(*) FILTER (WHERE p_hour = hour(make_timestamp((exposed_time + 28800) * 1000000))) AS hour_equals_offset FROM ev2""")
def time_consistency(spark, sf):
    e = I.daily_events_in_two_dates(spark, sf)
    return P.time_consistency(e.select(
        F.col("exposed_time").cast("string").alias("exposed_time"), F.date_format("p_date", "yyyyMMdd").alias("p_date"),
        F.col("p_hour").cast("string").alias("p_hour")))


@query("lookup_profile", """
SELECT count(*) AS distinct_ids, count(*) FILTER (WHERE n > 1) AS repeated_ids, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_with_repeated_id,
       CAST(sum(n) AS BIGINT) AS n_rows, (SELECT count(*) FROM part_cats WHERE trim(category_name_en) = '') AS blank_labels,
       (SELECT count(*) FROM part_cats WHERE trim(category_name_en) <> '' AND starts_with(category_name_en, ' ')) AS labels_with_leading_space
FROM (SELECT category_id, count(*) AS n FROM part_cats GROUP BY 1)""")
def lookup_profile(spark, sf):
    return P.lookup_profile(I.raw_part_categories(spark, sf))


@query("lookup_levels", "SELECT category_level, count(*) AS n_rows FROM part_cats GROUP BY 1")
def lookup_levels(spark, sf):
    return P.level_distribution(I.raw_part_categories(spark, sf))


_TR = """
SELECT count(*) AS files, min(strlen(value)) AS bytes_min, max(strlen(value)) AS bytes_max, min(w) AS words_min, max(w) AS words_max,
       count(*) FILTER (WHERE w = 0) AS empty_files, count(*) FILTER (WHERE pid IS NULL) AS non_numeric_names,
       count(DISTINCT pid) FILTER (WHERE pid IN (SELECT pid FROM ev)) AS matching_a_video,
       count(DISTINCT pid) FILTER (WHERE pid NOT IN (SELECT pid FROM ev)) AS not_matching,
       (SELECT count(DISTINCT pid) FROM ev) AS distinct_videos,
       CAST(count(DISTINCT pid) FILTER (WHERE pid IN (SELECT pid FROM ev)) AS DOUBLE) / (SELECT count(DISTINCT pid) FROM ev) AS video_coverage
FROM (SELECT value, CAST(len(regexp_extract_all(value, '[^\\s]+')) AS BIGINT) AS w,
             CASE WHEN regexp_matches(file_name, '^[0-9]+\\.txt$') THEN CAST(regexp_extract(file_name, '^([0-9]+)\\.txt$', 1) AS BIGINT) END AS pid FROM transcripts)"""


@query("transcript_profile", _TR)
def transcript_profile(spark, sf):
    return P.transcript_profile(I.transcripts(spark, sf), I.daily_events(spark, sf))


@query("transcript_coverage", """
SELECT DISTINCT pid, pid IN (SELECT pid FROM ev) AS has_video FROM dim_transcripts""")
def transcript_coverage(spark, sf):
    return P.transcript_coverage(I.transcripts(spark, sf), I.daily_events(spark, sf))


@query("findings", f"""
SELECT issue, CAST(n AS BIGINT) AS n, CASE WHEN shared THEN CAST(n AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM raw) END AS share FROM (
  SELECT 'exact duplicate rows' AS issue, (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS n, true AS shared
  UNION ALL SELECT 'rows beyond one per event', sum(n) - count(*), true FROM ({_PER_EVENT})
  UNION ALL SELECT 'events in more than one date', count(*) FILTER (WHERE d > 1), false FROM ({_PER_EVENT})
  UNION ALL SELECT 'rows with watch_time greater than duration', count(*) FILTER (WHERE CAST(watch_time AS DOUBLE) > CAST(duration AS DOUBLE)), true FROM raw
  UNION ALL SELECT 'titles with a line break', count(*) FILTER (WHERE starts_with(tag_name, 'hot')), false FROM raw
  UNION ALL SELECT 'hours of the day with no rows', 24 - count(DISTINCT p_hour), false FROM raw
  UNION ALL SELECT 'fre_community_type unknown', count(*) FILTER (WHERE fre_community_type = 'unknown'), true FROM raw
  UNION ALL SELECT 'fre_city_level unknown', count(*) FILTER (WHERE fre_city_level = 'unknown'), true FROM raw
  UNION ALL SELECT 'category ids appearing more than once', count(*) FILTER (WHERE n > 1), false FROM (SELECT category_id, count(*) AS n FROM part_cats GROUP BY 1)
  UNION ALL SELECT 'blank category labels', count(*) FILTER (WHERE trim(category_name_en) = ''), false FROM part_cats
  UNION ALL SELECT 'category labels with a leading space', count(*) FILTER (WHERE trim(category_name_en) <> '' AND starts_with(category_name_en, ' ')), false FROM part_cats
  UNION ALL SELECT 'transcripts without a video', not_matching, false FROM ({_TR}))""")
def findings(spark, sf):
    raw = materialize(_broken_titles(spark, sf), "raw")
    return P.findings(raw, I.raw_part_categories(spark, sf), I.transcripts(spark, sf), I.daily_events(spark, sf))


def layer_counts(spark, sf, lost=None):
    """Counts of every layer; the curated events lack the date ``lost``."""
    raw = materialize(I.raw_interactions(spark, sf), "raw")
    staged = materialize(stage.stage_events(raw), "staged")
    feats = materialize(curate.daily_features(staged), "features")
    pairs = materialize(stage.stage_category_pairs(raw), "pairs")
    files, lookup = I.transcripts(spark, sf), I.raw_categories(spark, sf)
    dup = materialize(dedup.duplicate_stats(raw), "duplicates")
    facts = curate.curated_events(staged if lost is None else staged.where(C.date_to_label("p_date") != lost))
    n = F.count(F.lit(1)).alias("n")
    seen = type_rows(raw, EVENT_KEY + ["p_date"]).distinct()
    return lineage.layer_counts({
        ("source", "category_rows"): lookup.agg(n),
        ("source", "transcript_files"): files.agg(n),
        ("raw", "interaction_rows"): raw.agg(n),
        ("staging", "exact_duplicate_rows"): dup.select("exact_duplicate_rows"),
        ("staging", "rows_after_dedup"): dup.select("distinct_rows"),
        ("staging", "events_in_partitions"): seen.agg(n),
        ("staging", "owned_earlier"): seen.agg(F.count(F.lit(1)).alias("s")).select(
            F.col("s") - staged.agg(n).select("n").scalar()),
        ("staging", "events"): staged.agg(n),
        ("staging", "rewatch_flagged_events"): staged.agg(F.count_if("is_rewatch_flagged")),
        ("staging", "video_category_pairs"): pairs.agg(n),
        ("staging", "categories"): stage.stage_categories(lookup).agg(n),
        ("staging", "transcripts"): stage.stage_transcripts(files).agg(n),
        ("curated", "interactions_curated"): facts.agg(n),
        ("curated", "daily_user_features"): feats.agg(n),
        ("curated", "feature_events"): feats.agg(F.sum("n_events")),
        ("curated", "users"): curate.dim_users(staged).agg(n),
        ("curated", "videos"): staged.select("pid").distinct().agg(n),
        ("curated", "video_categories"): curate.dim_video_categories(pairs).agg(n),
    })


_COUNTS = """
SELECT layer, name, CAST(n AS BIGINT) AS n FROM (
  SELECT 'source' AS layer, 'category_rows' AS name, count(*) AS n FROM cats
  UNION ALL SELECT 'source', 'transcript_files', count(*) FROM transcripts
  UNION ALL SELECT 'raw', 'interaction_rows', count(*) FROM raw
  UNION ALL SELECT 'staging', 'exact_duplicate_rows', (SELECT count(*) FROM raw) - count(*) FROM (SELECT DISTINCT * FROM raw)
  UNION ALL SELECT 'staging', 'rows_after_dedup', count(*) FROM (SELECT DISTINCT * FROM raw)
  UNION ALL SELECT 'staging', 'events_in_partitions', count(*) FROM (SELECT DISTINCT user_id, pid, exposed_time, p_date FROM typed)
  UNION ALL SELECT 'staging', 'owned_earlier', count(*) - (SELECT count(*) FROM staged) FROM (SELECT DISTINCT user_id, pid, exposed_time, p_date FROM typed)
  UNION ALL SELECT 'staging', 'events', count(*) FROM staged
  UNION ALL SELECT 'staging', 'rewatch_flagged_events', count(*) FILTER (WHERE is_rewatch_flagged) FROM staged
  UNION ALL SELECT 'staging', 'video_category_pairs', count(*) FROM pairs
  UNION ALL SELECT 'staging', 'categories', count(*) FROM dim_cats
  UNION ALL SELECT 'staging', 'transcripts', count(*) FROM dim_transcripts
  UNION ALL SELECT 'curated', 'interactions_curated', count(*) FROM staged
  UNION ALL SELECT 'curated', 'daily_user_features', count(*) FROM staged_feat
  UNION ALL SELECT 'curated', 'feature_events', sum(n_events) FROM staged_feat
  UNION ALL SELECT 'curated', 'users', count(*) FROM dim_users
  UNION ALL SELECT 'curated', 'videos', count(*) FROM dim_videos
  UNION ALL SELECT 'curated', 'video_categories', count(*) FROM dim_bridge)"""

query("lineage_counts", _COUNTS)(layer_counts)


@query("lineage_problems", """
SELECT rule, difference FROM (SELECT count(*) AS difference FROM staged WHERE p_date = DATE '1997-01-01'),
       (VALUES ('curated equals staged'), ('features cover events')) r(rule)""")
def lineage_problems(spark, sf):
    """The rules that a curated layer breaks which lost a date."""
    return lineage.consistency_problems(materialize(layer_counts(spark, sf, lost="19970101"), "counts"))


@query("lineage_consistency", f"""
SELECT 'rows after dedup' AS rule, CAST(sum(CASE name WHEN 'interaction_rows' THEN n WHEN 'exact_duplicate_rows' THEN -n WHEN 'rows_after_dedup' THEN -n END) AS BIGINT) AS difference FROM ({_COUNTS})
UNION ALL SELECT 'events after ownership', CAST(sum(CASE name WHEN 'events_in_partitions' THEN n WHEN 'owned_earlier' THEN -n WHEN 'events' THEN -n END) AS BIGINT) FROM ({_COUNTS})
UNION ALL SELECT 'curated equals staged', CAST(sum(CASE name WHEN 'events' THEN n WHEN 'interactions_curated' THEN -n END) AS BIGINT) FROM ({_COUNTS})
UNION ALL SELECT 'features cover events', CAST(sum(CASE name WHEN 'feature_events' THEN n WHEN 'interactions_curated' THEN -n END) AS BIGINT) FROM ({_COUNTS})""")
def lineage_consistency(spark, sf):
    return lineage.consistency(materialize(layer_counts(spark, sf), "counts"))
