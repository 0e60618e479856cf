"""Sessions and daily per-user features.

A session groups consecutive events of one user inside one date. A new one starts when the exposure is
more than ``gap`` seconds after the running maximum of all earlier view ends.

The plan pre-aggregates to one row per (user, date, second) before anything is clustered by user. A hot
user or bot therefore reaches the window as at most one row per second of the day, whatever its share of the
input, and the per-second aggregation itself combines map-side. This loses nothing: within one second every
event after the first that ended no more than ``gap`` seconds ago finds a recent enough end and joins the
same session. Events whose view ends earlier than that (negative watch times, which the raw gate rejects) keep a
row of their own, so the rule stays exact for any input.
"""

from pyspark.sql import DataFrame, Window, functions as F

from daybrook.functions import columns as C
from daybrook.params import DEFAULTS, Params
from daybrook.schemas import FEATURE_COLUMNS

_SECOND = ["user_id", "p_date", "exposed_time", "lone_pid"]


def _lone_pid(gap):
    return F.when(F.col("watch_time") < -gap, F.col("pid"))


def _per_second(events: DataFrame, params: Params, *measures) -> DataFrame:
    return (
        events.withColumn("lone_pid", _lone_pid(params.session_gap_seconds))
        .groupBy(*_SECOND)
        .agg(
            F.min("pid").alias("first_pid"),
            F.max(F.col("exposed_time") + F.col("watch_time")).alias("end_time"),
            F.count(F.lit(1)).alias("n_events"),
            F.sum("watch_time").alias("watch_seconds"),
            *measures,
        )
    )


def _number_sessions(seconds: DataFrame, params: Params) -> DataFrame:
    order = Window.partitionBy("user_id", "p_date").orderBy("exposed_time", "first_pid")
    prev_end = F.max("end_time").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = prev_end.isNull() | (F.col("exposed_time") - prev_end > params.session_gap_seconds)
    return (
        seconds.withColumn("is_new_session", starts.cast("bigint"))
        .withColumn("session_id", F.sum("is_new_session").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )


def assign_sessions(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Every event with its ``session_id``, numbered from 1 per user and date."""
    numbered = _number_sessions(_per_second(events, params), params).select(*_SECOND, "session_id")
    e = events.withColumn("lone_pid", _lone_pid(params.session_gap_seconds)).alias("e")
    s = numbered.alias("s")
    cond = F.col("e.lone_pid").eqNullSafe(F.col("s.lone_pid"))
    for c in _SECOND[:3]:
        cond = cond & (F.col(f"e.{c}") == F.col(f"s.{c}"))
    return e.join(s, cond).select(*[F.col(f"e.{c}") for c in events.columns], F.col("s.session_id"))


def session_summary(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row per session: events, watched seconds, first exposure and last view end."""
    return (
        _number_sessions(_per_second(events, params), params)
        .groupBy("user_id", "p_date", "session_id")
        .agg(
            F.sum("n_events").alias("n_events"),
            F.sum("watch_seconds").alias("session_seconds"),
            F.min("exposed_time").alias("session_start"),
            F.max("end_time").alias("session_end"),
        )
    )


def daily_user_features(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The 14-column feature table, one row per user and date.

    Two exchanges: the per-second partial aggregate, then one by (user, date) that serves the window and
    both aggregation levels.
    """
    late = C.late_night("p_hour", params)
    seconds = _per_second(
        events, params,
        F.count_if(late).alias("late_night_events"),
        F.sum(F.when(late, F.col("watch_time")).otherwise(F.lit(0))).alias("late_night_watch_seconds"),
        F.count_if(F.col("hate")).alias("hate_events"),
        F.count_if(F.col("is_rewatch_flagged")).alias("rewatch_events"),
    )
    sums = ["n_events", "watch_seconds", "late_night_events", "late_night_watch_seconds", "hate_events",
            "rewatch_events"]
    per_session = (
        _number_sessions(seconds, params)
        .groupBy("user_id", "p_date", "session_id")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    per_day = (
        per_session.groupBy("user_id", F.col("p_date").alias("feature_date"))
        .agg(
            *[F.sum(c).alias(c) for c in sums if c != "watch_seconds"],
            F.sum("watch_seconds").alias("total_watch_seconds"),
            F.count(F.lit(1)).alias("n_sessions"),
            F.max("watch_seconds").alias("max_session_seconds"),
        )
    )
    return (
        per_day
        .withColumn("late_night_share", F.when(
            F.col("total_watch_seconds") > 0, C.share("late_night_watch_seconds", "total_watch_seconds")))
        .withColumn("avg_session_seconds", C.share("total_watch_seconds", "n_sessions"))
        .withColumn("hate_rate", C.share("hate_events", "n_events"))
        .withColumn("rewatch_rate", C.share("rewatch_events", "n_events"))
        .select(*FEATURE_COLUMNS)
    )
