"""Warehouse loads, ownership, late dates and backfill over the driver's tables."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.catalog.quality import curated_tables
from daybrook.functions import columns as C
from daybrook.operators import events as E
from daybrook.plans import curate, daily, stage, warehouse as WH
from daybrook.schemas import EVENT_KEY, RAW_COLUMNS
from daybrook.session import materialize, release, work_path
from daybrook.sources import readers as R, sinks as W
from daybrook.streaming import late_data

_DAYS = ["20240114", "20240115"]


@query("warehouse_upsert", """
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(s.gender, t.gender) AS gender, coalesce(s.age, t.age) AS age,
       coalesce(s.fre_city, t.fre_city) AS fre_city, t.mod_price AS mod_price
FROM (SELECT * FROM users_typed WHERE fre_community_type <> '镇区') t
FULL JOIN (SELECT user_id, gender, age + 1 AS age, 'moved' AS fre_city FROM users_typed WHERE gender = 'M') s
ON t.user_id = s.user_id""")
def warehouse_upsert(spark, sf):
    """Update, insert, keep; ``mod_price`` is outside the column list, so matched rows keep theirs."""
    u = I.users(spark, sf)
    target = u.where("fre_community_type <> '镇区'").select("user_id", "gender", "age", "fre_city", "mod_price")
    source = u.where("gender = 'M'").select(
        "user_id", "gender", (F.col("age") + 1).alias("age"), F.lit("moved").alias("fre_city"))
    return W.upsert(target, source, ["user_id", "gender", "age", "fre_city"], ["user_id"])


@query("upsert_key_only", "SELECT DISTINCT pid, category_id FROM pairs")
def upsert_key_only(spark, sf):
    """Key-only table: existing pairs stay, new ones arrive, nothing is updated."""
    pairs = stage.stage_category_pairs(I.raw_interactions(spark, sf))
    target = pairs.where("p_date < date'1998-01-01'").select("pid", "category_id").distinct()
    source = pairs.select("pid", "category_id").distinct()
    return W.upsert(target, source, ["pid", "category_id"], ["pid", "category_id"])


def _fact(spark, sf):
    root = work_path(spark, "fact")
    e = curate.curated_events(I.daily_events(spark, sf))
    W.write_partitions(e, root)
    return root, e


@query("replace_partition", """
SELECT p_date, count(*) AS n_rows, CAST(sum(watch_time) AS BIGINT) AS watch_seconds FROM (
  SELECT p_date, watch_time FROM ev WHERE p_date <> DATE '2024-01-15'
  UNION ALL SELECT p_date, watch_time + 1 FROM ev WHERE p_date = DATE '2024-01-15' AND NOT hate) GROUP BY 1""")
def replace_partition(spark, sf):
    root, e = _fact(spark, sf)
    new = e.where(~F.col("hate")).withColumn("watch_time", F.col("watch_time") + 1)
    for _ in range(2):  # the rerun changes nothing
        W.replace_partition(new, root, "p_date", "2024-01-15")
    return spark.read.schema(e.schema).parquet(root).groupBy("p_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("watch_time").alias("watch_seconds"))


@query("replace_partition_empty", "SELECT p_date, count(*) AS n_rows FROM ev WHERE p_date <> DATE '2024-01-15' GROUP BY 1")
def replace_partition_empty(spark, sf):
    root, e = _fact(spark, sf)
    W.replace_partition(e.where("watch_time < 0"), root, "p_date", "2024-01-15")
    return spark.read.schema(e.schema).parquet(root).groupBy("p_date").agg(F.count(F.lit(1)).alias("n_rows"))


_PUB = "ev"


@query("warehouse_load", f"""
SELECT 'users' AS table_name, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total_events, count(*) FILTER (WHERE n < 5) AS sparse
FROM (SELECT u.user_id, count(e.pid) AS n FROM users_typed u LEFT JOIN {_PUB} e ON u.user_id = e.user_id GROUP BY 1)
UNION ALL SELECT 'interactions_curated', count(*), NULL, NULL FROM {_PUB}
UNION ALL SELECT 'daily_user_features', count(*), NULL, NULL FROM (SELECT DISTINCT user_id, p_date FROM {_PUB})
UNION ALL SELECT 'videos', count(DISTINCT pid), NULL, NULL FROM ev
UNION ALL SELECT 'categories', count(*), NULL, NULL FROM nation
UNION ALL SELECT 'video_categories', count(*), NULL, NULL FROM bridge""")
def warehouse_load(spark, sf):
    """Every date published in one load, one of them again in another: the same contents."""
    curated = curated_tables(spark, sf, I.events_told_apart(spark, sf))
    root = work_path(spark, "warehouse")
    dates = curated["interactions_curated"].select(C.date_to_label("p_date")).distinct().collect()
    WH.load_dates(spark, curated, root, [d[0] for d in dates])
    WH.load_date(spark, curated, root, _DAYS[0])
    out = None
    none = F.lit(None).cast("bigint")
    for name, df in WH.tables(spark, root).items():
        users = name == "users"
        row = df.agg(F.count(F.lit(1)).alias("n_rows"),
                     (F.sum("total_events") if users else F.max(none)).alias("total_events"),
                     (F.count_if("is_sparse_history") if users else F.max(none)).alias("sparse"),
                     ).select(F.lit(name).alias("table_name"), "n_rows", "total_events", "sparse")
        out = row if out is None else out.unionByName(row)
    return out


@query("load_all_or_nothing", """
SELECT p_date, count(*) AS n_rows, false AS second_load_published FROM ev WHERE p_date < DATE '2024-01-15' GROUP BY 1""")
def load_all_or_nothing(spark, sf):
    """The later dates break a rule: their load raises and the warehouse still holds only the earlier ones."""
    curated = curated_tables(spark, sf, I.events_told_apart(spark, sf))
    root = work_path(spark, "warehouse")
    labels = sorted(d[0] for d in curated["interactions_curated"].select(C.date_to_label("p_date")).distinct().collect())
    WH.load_dates(spark, curated, root, [d for d in labels if d < _DAYS[1]])
    bad = curated["interactions_curated"].withColumn("tag_count", F.when(F.col("hate"), 0).otherwise(F.col("tag_count")))
    try:
        WH.load_dates(spark, {**curated, "interactions_curated": bad}, root, [d for d in labels if d >= _DAYS[1]])
        published = True
    except WH.LoadError:
        published = False
    return WH.tables(spark, root)["interactions_curated"].groupBy("p_date").agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("second_load_published", F.lit(published))


@query("load_reconcile", """
SELECT p_date, count(*) AS written, count(*) AS expected, true AS reconciled FROM staged GROUP BY 1""")
def load_reconcile(spark, sf):
    staged = materialize(stage.stage_events(I.raw_interactions(spark, sf)), "staged")
    root = work_path(spark, "fact")
    W.write_partitions(curate.curated_events(staged), root)
    written = W.rows_per_date(spark.read.parquet(root), "p_date").withColumnRenamed("n_rows", "written")
    expected = W.rows_per_date(staged, "p_date").withColumnRenamed("n_rows", "expected")
    return written.join(expected, "p_date", "full_outer").withColumn(
        "reconciled", F.col("written").eqNullSafe(F.col("expected")))


# ---- ownership ------------------------------------------------------------------------------

_OWNED = "SELECT user_id, pid, exposed_time, min(p_date) AS p_date FROM ev2 GROUP BY 1, 2, 3"


@query("ownership_full_range", _OWNED)
def ownership_full_range(spark, sf):
    return E.keep_earliest_date(I.daily_events_in_two_dates(spark, sf).select(*EVENT_KEY, "p_date"))


@query("ownership_incremental", """
SELECT user_id, pid, exposed_time FROM ev2 WHERE p_date = DATE '2024-01-16'
EXCEPT SELECT user_id, pid, exposed_time FROM ev2 WHERE p_date < DATE '2024-01-16'""")
def ownership_incremental(spark, sf):
    rows = I.daily_events_in_two_dates(spark, sf).select(*EVENT_KEY, "p_date")
    day = F.lit("2024-01-16").cast("date")
    return E.not_owned_earlier(rows.where(F.col("p_date") == day), rows.where(F.col("p_date") < day)).select(*EVENT_KEY)


@query("events_before_after_ownership", """
SELECT a.p_date, a.n AS events_in_partition, coalesce(b.n, 0) AS events_owned
FROM (SELECT p_date, count(*) AS n FROM ev2 GROUP BY 1) a
LEFT JOIN (SELECT p_date, count(*) AS n FROM (SELECT user_id, pid, exposed_time, min(p_date) AS p_date FROM ev2 GROUP BY 1, 2, 3) GROUP BY 1) b
ON a.p_date = b.p_date""")
def events_before_after_ownership(spark, sf):
    rows = I.daily_events_in_two_dates(spark, sf).select(*EVENT_KEY, "p_date")
    before = rows.distinct().groupBy("p_date").agg(F.count(F.lit(1)).alias("events_in_partition"))
    after = E.keep_earliest_date(rows.distinct()).groupBy("p_date").agg(F.count(F.lit(1)).alias("events_owned"))
    return before.join(after, "p_date", "left").fillna(0, ["events_owned"])


@query("late_partition_dates", """
SELECT o.p_date, count(*) AS events_lost
FROM (SELECT user_id, pid, exposed_time, min(p_date) AS p_date FROM ev2 WHERE p_date <> DATE '2024-01-15' GROUP BY 1, 2, 3) o
JOIN (SELECT user_id, pid, exposed_time FROM ev2 WHERE p_date = DATE '2024-01-15') n
  ON o.user_id = n.user_id AND o.pid = n.pid AND o.exposed_time = n.exposed_time
WHERE o.p_date > DATE '2024-01-15' GROUP BY 1""")
def late_partition_dates(spark, sf):
    """15 January arrives last: which later dates lose events to it."""
    rows = I.daily_events_in_two_dates(spark, sf).select(*EVENT_KEY, "p_date")
    late = F.col("p_date") == F.lit("2024-01-15").cast("date")
    return late_data.affected_dates(rows.where(late), E.keep_earliest_date(rows.where(~late)))


def _layers(spark, name):
    root = work_path(spark, name)
    return daily.Layers(f"{root}/raw", f"{root}/staging", f"{root}/curated", f"{root}/reports")


_STAGED_SHORT = "SELECT user_id, pid, exposed_time, p_date, title, author_id, watch_time, tag_count FROM staged"
_SHORT = [*EVENT_KEY, "p_date", "title", "author_id", "watch_time", "tag_count"]


def _land(spark, sf, layers, rows, stored):
    W.fanout_by_date(rows, f"{layers.raw}/interactions", stored=stored)
    W.overwrite_table(I.raw_categories(spark, sf), f"{layers.raw}/categories")
    W.overwrite_table(I.transcripts(spark, sf), f"{layers.raw}/transcripts")


def _late_1997(spark, sf):
    """Every date but 1997 goes through every layer, then 1997 lands."""
    layers = _layers(spark, "late")
    raw = I.landed_raw(spark, sf)
    _land(spark, sf, layers, raw.where("p_date <> '19970101'"), W.few_dates(raw))
    daily.run_range(spark, layers)
    W.fanout_by_date(raw.where("p_date = '19970101'"), f"{layers.raw}/interactions", stored=True)
    release(raw)
    late_data.repair(spark, layers, "19970101")
    return layers


@query("late_partition_repair", _STAGED_SHORT)
def late_partition_repair(spark, sf):
    """The staged rows after a late date equal the range job's."""
    return spark.read.parquet(_late_1997(spark, sf).staged("events")).select(*_SHORT)


@query("late_date_end_to_end", "SELECT * FROM staged_feat")
def late_date_end_to_end(spark, sf):
    """The features after a late date equal those of the range job over all dates."""
    return daily.curated_tables(spark, _late_1997(spark, sf))["daily_user_features"]


@query("emptied_date", """
SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id, CAST(pid AS BIGINT) AS pid, CAST(exposed_time AS BIGINT) AS exposed_time,
       DATE '1997-01-01' AS p_date FROM raw WHERE p_date = '19980101'""")
def emptied_date(spark, sf):
    """All events of 1998 turn out to belong to the late 1997: the facts of 1998 become empty, nothing stays behind."""
    layers = _layers(spark, "emptied")
    day = materialize(I.raw_interactions(spark, sf).where("p_date = '19980101'"), "day")
    _land(spark, sf, layers, day, stored=True)
    daily.run_date(spark, layers, "19980101")
    W.fanout_by_date(day.withColumn("p_date", F.lit("19970101")), f"{layers.raw}/interactions", stored=True)
    daily.run_date(spark, layers, "19970101")
    return daily.curated_tables(spark, layers)["interactions_curated"].select(*EVENT_KEY, "p_date")


@query("backfill_equals_loop", _STAGED_SHORT)
def backfill_equals_loop(spark, sf):
    """Dates staged one by one against the owner table give the rows of the range job."""
    layers = _layers(spark, "loop")
    W.fanout_by_date(I.raw_interactions(spark, sf), f"{layers.raw}/interactions")
    for d in R.partition_dates(spark, f"{layers.raw}/interactions"):
        daily.stage_date(spark, layers, d)
    return spark.read.parquet(layers.staged("events")).select(*_SHORT)


@query("daily_flow_features", "SELECT * FROM staged_feat")
def daily_flow_features(spark, sf):
    """Landed raw to gated, stored features for the whole range."""
    layers = _layers(spark, "flow")
    W.fanout_by_date(I.raw_interactions(spark, sf), f"{layers.raw}/interactions")
    W.overwrite_table(I.raw_categories(spark, sf), f"{layers.raw}/categories")
    W.overwrite_table(I.transcripts(spark, sf), f"{layers.raw}/transcripts")
    daily.run_range(spark, layers)
    return daily.curated_tables(spark, layers)["daily_user_features"]
