"""Warehouse constraints as violation counts: keys, references, value rules and mandatory columns."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from daybrook.functions import columns as C
from daybrook.operators import compare, dedup

# fixed values: the declared keys, references, nullable columns and value rules of the published tables
PRIMARY_KEYS = {
    "categories": ["category_id"],
    "users": ["user_id"],
    "videos": ["pid"],
    "video_categories": ["pid", "category_id"],
    "interactions_curated": ["user_id", "pid", "exposed_time"],
    "daily_user_features": ["user_id", "feature_date"],
    "risk_scores": ["user_id", "score_date"],
}
FOREIGN_KEYS = [
    ("video_categories", "pid", "videos"), ("video_categories", "category_id", "categories"),
    ("interactions_curated", "user_id", "users"), ("interactions_curated", "pid", "videos"),
    ("daily_user_features", "user_id", "users"), ("risk_scores", "user_id", "users"),
]
NULLABLE = {"category_name_en", "late_night_share", "transcript_word_count", "ingest_batch_id", "risk_score"}
VALUE_RULES = {
    "categories": {"level_1_to_3": "category_level BETWEEN 1 AND 3"},
    "users": {
        "gender_m_f": "gender IN ('M', 'F')", "age_10_to_100": "age BETWEEN 10 AND 100",
        "mod_price_non_negative": "mod_price >= 0",
    },
    "videos": {
        "duration_positive": "duration > 0", "word_count_non_negative": "transcript_word_count >= 0",
        "word_count_iff_transcript": "has_transcript = (transcript_word_count IS NOT NULL)",
    },
    "interactions_curated": {
        "p_hour_0_23": "p_hour BETWEEN 0 AND 23", "watch_time_non_negative": "watch_time >= 0",
        "watch_ratio_non_negative": "watch_ratio >= 0", "tag_count_positive": "tag_count >= 1",
    },
    "daily_user_features": {
        "n_events_positive": "n_events >= 1", "total_watch_non_negative": "total_watch_seconds >= 0",
        "late_events_non_negative": "late_night_events >= 0",
        "late_watch_non_negative": "late_night_watch_seconds >= 0",
        "late_share_0_1": "late_night_share BETWEEN 0 AND 1", "n_sessions_positive": "n_sessions >= 1",
        "max_session_non_negative": "max_session_seconds >= 0",
        "avg_session_non_negative": "avg_session_seconds >= 0",
        "hate_events_non_negative": "hate_events >= 0", "hate_rate_0_1": "hate_rate BETWEEN 0 AND 1",
        "rewatch_events_non_negative": "rewatch_events >= 0", "rewatch_rate_0_1": "rewatch_rate BETWEEN 0 AND 1",
    },
}


def _row_rules(table: str, df: DataFrame) -> DataFrame:
    """Value rules and mandatory columns of one table in a single aggregate. A null passes a value rule."""
    rules = {("check", n): ~F.expr(e) for n, e in VALUE_RULES.get(table, {}).items()}
    for c in df.columns:
        if c not in NULLABLE:
            rules[("not_null", c)] = F.col(c).isNull()
    keys = list(rules)
    counts = df.agg(*[C.count_if(rules[k]).alias(f"v{i}") for i, k in enumerate(keys)])
    rows = F.array(*[F.struct(F.lit(k[0]).alias("kind"), F.lit(k[1]).alias("name"), F.col(f"v{i}").alias("violations"))
                     for i, k in enumerate(keys)])
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def _row(table, kind, name, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("name"),
                          F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def constraint_violations(tables: dict) -> DataFrame:
    """One row per constraint of the tables given: surplus key rows, distinct orphan ids, failing rows."""
    out = []
    for name, df in tables.items():
        key = PRIMARY_KEYS[name]
        out.append(_row(name, "primary_key", ",".join(key), dedup.duplicate_keys(df, key).agg(
            F.sum("surplus").alias("violations"))))
        out.append(_row_rules(name, df))
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            out.append(_row(child, "foreign_key", f"{column}->{parent}", compare.missing_keys(
                tables[child], tables[parent], column).agg(F.count(F.lit(1)).alias("violations"))))
    return reduce(DataFrame.unionByName, out)
