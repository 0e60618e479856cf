"""Column contracts of every layer. Schemas are fixed; no scan infers types."""

from pyspark.sql import types as T

EVENT_KEY = ["user_id", "pid", "exposed_time"]

# fixed values: the 28 raw columns, in file order, all text
RAW_COLUMNS = [
    "user_id", "pid", "author_id", "category_id", "category_level", "parent_id", "root_id",
    "exposed_time", "author_fans_count", "watch_time", "duration", "cvm_like", "click",
    "comment", "follow", "collect", "forward", "hate", "tag_name", "title", "p_hour", "p_date",
    "gender", "age", "mod_price", "fre_city", "fre_community_type", "fre_city_level",
]
# fixed values: column groups
INT_COLUMNS = [
    "user_id", "pid", "author_id", "category_id", "category_level", "parent_id", "root_id",
    "exposed_time", "author_fans_count", "watch_time", "p_hour", "age", "mod_price",
]
BOOL_COLUMNS = ["cvm_like", "click", "comment", "follow", "collect", "forward", "hate"]
FANOUT_COLUMNS = ["category_id", "category_level", "parent_id", "root_id", "tag_name"]
USER_ATTRIBUTES = ["gender", "age", "mod_price", "fre_city", "fre_community_type", "fre_city_level"]
CATEGORY_COLUMNS = [
    "category_level", "category_id", "category_name_cn", "parent_id", "root_id", "category_name_en",
]
# fixed values: accepted categorical values ('unknown' is a value of its own)
ACCEPTED_VALUES = {
    "gender": ["M", "F"],
    "fre_community_type": ["乡村", "镇区", "城区", "unknown"],
    "fre_city_level": [
        "一线城市", "新一线城市", "二线城市", "三线城市", "四线城市", "五线城市", "unknown",
    ],
}

# raw columns that stay on the event once the fan-out is collapsed
EVENT_ATTRIBUTES = [c for c in RAW_COLUMNS if c not in FANOUT_COLUMNS and c not in EVENT_KEY and c != "p_date"]

# fixed values: curated column order
CURATED_EVENT_COLUMNS = [
    "user_id", "pid", "exposed_time", "p_date", "p_hour", "author_fans_count", "watch_time",
    "watch_ratio", "is_rewatch_flagged", "tag_count", "cvm_like", "click", "comment", "follow",
    "collect", "forward", "hate", "ingest_batch_id",
]
FEATURE_COLUMNS = [
    "user_id", "feature_date", "n_events", "total_watch_seconds", "late_night_events",
    "late_night_watch_seconds", "late_night_share", "n_sessions", "max_session_seconds",
    "avg_session_seconds", "hate_events", "hate_rate", "rewatch_events", "rewatch_rate",
]
# fixed values: dimension columns
USER_COLUMNS = ["user_id"] + USER_ATTRIBUTES
VIDEO_COLUMNS = ["pid", "author_id", "title", "duration", "has_transcript", "transcript_word_count"]


def text_schema(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_SCHEMA = text_schema(RAW_COLUMNS)
CATEGORY_SCHEMA = text_schema(CATEGORY_COLUMNS)
TRANSCRIPT_SCHEMA = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("has_transcript", T.BooleanType()),
    T.StructField("transcript_word_count", T.LongType()),
])
# append-only ingestion log, one JSON object per line
LOG_SCHEMA = text_schema(["batch_id", "source", "status", "detail", "logged_at"])

# narrower types used by the published warehouse tables
WAREHOUSE_TYPES = {
    "categories": {"category_id": "int", "category_level": "smallint", "parent_id": "int", "root_id": "int"},
    "users": {"age": "smallint", "mod_price": "int", "total_events": "int"},
    "videos": {"transcript_word_count": "int"},
    "video_categories": {"category_id": "int"},
    "interactions_curated": {"p_hour": "smallint", "watch_time": "int", "tag_count": "int"},
    "daily_user_features": {
        "n_events": "int", "late_night_events": "int", "n_sessions": "int", "hate_events": "int",
        "rewatch_events": "int",
    },
}
