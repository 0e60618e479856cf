"""Staging to curated: the event fact, daily features and the dimensions."""

from pyspark.sql import DataFrame, functions as F

from daybrook.operators import sessions
from daybrook.params import DEFAULTS, Params
from daybrook.schemas import CURATED_EVENT_COLUMNS, USER_ATTRIBUTES, VIDEO_COLUMNS


def curated_events(staged: DataFrame) -> DataFrame:
    return staged.select(*CURATED_EVENT_COLUMNS)


def daily_features(staged: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return sessions.daily_user_features(staged, params)


def dim_users(staged: DataFrame) -> DataFrame:
    """Attributes of the latest event win; (p_date, exposed_time, pid) is a total order per user."""
    latest = F.max_by(F.struct(*USER_ATTRIBUTES), F.struct("p_date", "exposed_time", "pid"))
    return staged.groupBy("user_id").agg(latest.alias("row")).select("user_id", "row.*")


def dim_videos(staged: DataFrame, transcripts: DataFrame) -> DataFrame:
    """The smallest title per video with author and duration of that row, plus the transcript feature."""
    first = F.min(F.struct("title", "author_id", "duration"))
    videos = staged.groupBy("pid").agg(first.alias("row")).select("pid", "row.author_id", "row.title", "row.duration")
    return with_transcripts(videos, transcripts)


def with_transcripts(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    # no broadcast hint: the transcript table grows with the videos, Spark checks its size
    return (
        videos.join(transcripts, "pid", "left")
        .withColumn("has_transcript", F.coalesce("has_transcript", F.lit(False)))
        .select(*VIDEO_COLUMNS)
    )


def dim_video_categories(pairs: DataFrame) -> DataFrame:
    return pairs.select("pid", "category_id").distinct()
