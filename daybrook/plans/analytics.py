"""Usage summary, screening flags and the report tables over daily user features.

``features`` is scanned several times (cut-off, flags, counts): pass the stored table, not a plan that recomputes it.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybrook.functions import columns as C
from daybrook.operators import compare
from daybrook.operators.quantiles import quantile, quantiles
from daybrook.params import DEFAULTS, Params

FLAGS = ["high_watch", "high_hate", "late_night"]


def min_events(features: DataFrame, k: int) -> DataFrame:
    """User-days with at least ``k`` events. Applied before any quantile, so it moves the cut-off."""
    return features.where(F.col("n_events") >= k)


def heavy_late_night(params: Params = DEFAULTS):
    return F.coalesce(F.col("late_night_share") > params.heavy_late_night, F.lit(False))


def screening_flags(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Three rule flags per user-day and their sum. A null share never counts as late night."""
    cut = quantile(features, "total_watch_seconds", params.watch_quantile)
    return (
        features.withColumn("high_watch", F.coalesce(F.col("total_watch_seconds") > cut, F.lit(False)))
        .withColumn("high_hate", F.coalesce(F.col("hate_rate") > params.hate_rate_min, F.lit(False)))
        .withColumn("late_night", F.coalesce(F.col("late_night_share") > params.late_night_min, F.lit(False)))
        .withColumn("n_flags", sum((F.col(c).cast("int") for c in FLAGS), F.lit(0)))
    )


def risk_scores(features: DataFrame, params: Params = DEFAULTS, min_score=1) -> DataFrame:
    """User-days at risk, shaped as the score table."""
    return (
        screening_flags(features, params).where(F.col("n_flags") >= min_score)
        .select("user_id", F.col("feature_date").alias("score_date"), F.col("n_flags").cast("double").alias("risk_score"))
    )


def usage_summary(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row of descriptive statistics and flag counts."""
    q = quantiles(features, ["total_watch_seconds"], [0.5, params.watch_quantile, 0.9])

    def at(level):
        return q.where(F.col("q") == float(level)).select("quantile").scalar()

    heavy = heavy_late_night(params)
    # per user first: distinct users become a plain count and no row is expanded
    per_user = screening_flags(features, params).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days"), F.sum("total_watch_seconds").alias("watch"),
        F.max("max_session_seconds").alias("max_session"),
        F.count_if(F.col("late_night_share").isNull()).alias("no_watch"),
        F.count_if(heavy).alias("heavy"),
        *[F.count_if(F.col("n_flags") >= k).alias(f"flags_{k}") for k in (1, 2, 3)],
        *[F.count_if(F.col(c)).alias(c) for c in FLAGS])
    total = per_user.agg(
        F.sum("days").alias("user_day_records"), F.count(F.lit(1)).alias("distinct_users"),
        F.sum("watch").alias("watch"), F.max("max_session").alias("max_session_seconds"),
        F.sum("no_watch").alias("no_watch_time_user_days"), F.sum("heavy").alias("late_night_heavy_user_days"),
        F.count_if(F.col("heavy") > 0).alias("late_night_heavy_distinct_users"),
        F.sum("flags_1").alias("flag_any_1plus"), F.sum("flags_2").alias("flag_2plus"),
        F.sum("flags_3").alias("flag_all_3"), F.sum("high_watch").alias("flag_high_watch"),
        F.sum("high_hate").alias("flag_hate_rate"), F.sum("late_night").alias("flag_late_night"))
    return (
        total.withColumn("avg_daily_watch_seconds", C.share("watch", "user_day_records"))
        .withColumn("median_daily_watch_seconds", at(0.5))
        .withColumn("p90_daily_watch_seconds", at(0.9))
        .withColumn("watch_cutoff_seconds", at(params.watch_quantile))
        .drop("watch")
    )


def per_date_summary(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    per_user = features.groupBy("feature_date", "user_id").agg(
        F.count(F.lit(1)).alias("days"), F.sum("total_watch_seconds").alias("watch"),
        F.count_if(heavy_late_night(params)).alias("heavy"))
    return per_user.groupBy("feature_date").agg(
        F.sum("days").alias("user_days"), F.count(F.lit(1)).alias("users"), F.sum("watch").alias("watch"),
        F.sum("heavy").alias("late_night_user_days"),
    ).withColumn("avg_watch", C.share("watch", "user_days")).drop("watch")


def flag_levels(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """User-days per number of flags, levels 0 to 3 always present."""
    found = screening_flags(features, params).groupBy("n_flags").agg(F.count(F.lit(1)).alias("user_days"))
    levels = features.sparkSession.range(len(FLAGS) + 1).select(F.col("id").cast("int").alias("n_flags"))
    return levels.join(found, "n_flags", "left").fillna(0, ["user_days"])


def watch_histogram(features: DataFrame, bins=60) -> DataFrame:
    """Equal-width histogram of positive daily watch time; the maximum falls into the last bin."""
    spark: SparkSession = features.sparkSession
    pos = features.where("total_watch_seconds > 0").select(F.col("total_watch_seconds").cast("double").alias("v"))
    ends = pos.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    counted = (
        pos.withColumn("bin", F.least(
            F.coalesce(F.floor(F.try_divide((F.col("v") - lo) * bins, hi - lo)), F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("user_days"))
    )
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        edges.join(counted, "bin", "left").fillna(0, ["user_days"])
        .withColumn("bin_start", lo + (hi - lo) * F.col("bin") / F.lit(float(bins)))
    )


def daily_trends(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Mean watch time and share of heavy late-night user-days per date, in percent."""
    return (
        features.groupBy("feature_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("total_watch_seconds").alias("watch"),
            F.count_if(heavy_late_night(params)).alias("heavy"))
        .select("feature_date", C.share("watch", "n").alias("avg_watch_seconds"),
                (F.lit(100.0) * F.col("heavy") / F.col("n")).alias("heavy_late_night_pct"))
    )


def missing_dates(raw_dates: DataFrame, curated_dates: DataFrame) -> DataFrame:
    """Landed dates without curated output."""
    return compare.missing_keys(raw_dates, curated_dates, "p_date")


def expect_rows(features: DataFrame, expected: int):
    n = features.count()
    if n != expected:
        raise AssertionError(f"expected {expected} user-days but analysed {n}")
    return n


