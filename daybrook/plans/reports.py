"""The six representative queries and the operator check query over the curated tables.

Ties that the ordering leaves open are broken by the key. Shares are rounded as decimals, like the source dialect.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybrook.operators.quantiles import quantile
from daybrook.params import DEFAULTS, Params


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding of a share or percentage: the decimal holds values below 1e9."""
    return f"CAST(round(CAST({expr} AS DECIMAL(24, 15)), {digits}) AS DOUBLE)"


def register_views(tables: dict):
    """Temporary views, so the warehouse can be queried as SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def late_night_top(spark: SparkSession, features: DataFrame, day: str, k=10) -> DataFrame:
    """Q1. Users with the highest late-night share on a day, at least five events."""
    return spark.sql(f"""
        SELECT user_id, feature_date, n_events, {rounded('late_night_share', 3)} AS late_night_share
        FROM {{features}}
        WHERE feature_date = CAST(:day AS DATE) AND n_events >= 5 AND late_night_share IS NOT NULL
        ORDER BY late_night_share DESC, n_events DESC, user_id
        LIMIT {int(k)}""", args={"day": day}, features=features)


def long_sessions_with_hate(features: DataFrame, q=0.9, k=10) -> DataFrame:
    """Q2. User-days with a top-decile session and at least one hate reaction."""
    return (
        features.where((F.col("hate_events") >= 1) & (F.col("max_session_seconds") >= quantile(
            features, "max_session_seconds", q)))
        .select("user_id", "feature_date", "max_session_seconds", "hate_events", "n_events")
        .orderBy(F.desc("max_session_seconds"), "user_id", "feature_date").limit(k)
    )


def late_night_by_tier(spark: SparkSession, features: DataFrame, users: DataFrame) -> DataFrame:
    """Q3. Late-night share and rewatch rate by city tier and gender, sparse users left out."""
    return spark.sql(f"""
        SELECT u.fre_city_level, u.gender, count(*) AS user_days,
               {rounded('avg(f.late_night_share)', 4)} AS avg_late_night_share,
               {rounded('avg(f.rewatch_rate)', 4)} AS avg_rewatch_rate
        FROM {{features}} f JOIN {{users}} u USING (user_id)
        WHERE NOT u.is_sparse_history
        GROUP BY u.fre_city_level, u.gender
        ORDER BY user_days DESC, u.fre_city_level, u.gender""", features=features, users=users)


def hate_trend(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Q4. Hate rate per date."""
    return spark.sql(f"""
        SELECT p_date, count(*) AS events, sum(CAST(hate AS INT)) AS hate_events,
               {rounded('100.0D * sum(CAST(hate AS INT)) / count(*)', 3)} AS hate_pct
        FROM {{events}} GROUP BY p_date ORDER BY p_date""", events=events)


def hours(seconds: str) -> str:
    """Hours with one decimal, rounded half away from zero in whole numbers: exact for every sum of seconds."""
    return f"CAST(sign({seconds}) AS BIGINT) * ((abs({seconds}) + 180) DIV 360) / 10.0D"


def top_categories(events: DataFrame, bridge: DataFrame, categories: DataFrame, level=1, k=10) -> DataFrame:
    """Q5. Categories of one level by watch time; a video with several of them counts in each.

    The fact is reduced to (video, user) before it meets the bridge, and users are counted by a second
    aggregate instead of an expanded distinct.
    """
    watched = events.groupBy("pid", "user_id").agg(F.sum("watch_time").alias("w"))
    wanted = bridge.join(
        categories.where(F.col("category_level") == level)
        .select("category_id", "category_name_en", "category_name_cn"), "category_id")
    labels = ["category_name_en", "category_name_cn"]
    per_user = watched.join(wanted, "pid").groupBy(*labels, "user_id").agg(F.sum("w").alias("w"))
    return (
        per_user.groupBy(*labels).agg(F.count(F.lit(1)).alias("users"), F.sum("w").alias("w"))
        .select(*labels, "users", F.expr(hours("w")).alias("watch_hours"))
        .orderBy(F.desc("watch_hours"), *labels).limit(k)
    )


def event_trace(spark: SparkSession, events: DataFrame, user_id: int, k=5) -> DataFrame:
    """Q6. First events of a user with the batch they came from."""
    return spark.sql(f"""
        SELECT user_id, pid, exposed_time, p_date, watch_time, is_rewatch_flagged, ingest_batch_id
        FROM {{events}} WHERE user_id = :user
        ORDER BY exposed_time, pid LIMIT {int(k)}""", args={"user": user_id}, events=events)


def rows_per_date(events: DataFrame) -> DataFrame:
    return events.groupBy("p_date").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("p_date")


def sparse_flags(users: DataFrame, events, params: Params = DEFAULTS, totals=None) -> DataFrame:
    """Total events of every user over all dates, 0 when there are none, and the sparse-history flag.

    ``totals`` (user_id, total_events) stands for ``events`` where they are known.
    """
    if totals is None:
        totals = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_events"))
    return (
        users.drop("total_events", "is_sparse_history").join(totals, "user_id", "left")
        .withColumn("total_events", F.coalesce("total_events", F.lit(0)).cast("int"))
        .withColumn("is_sparse_history", F.col("total_events") < params.min_user_events)
    )
