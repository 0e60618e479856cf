"""Dimensions followed date by date, bucketed upserts and overtaken loads over the driver's tables."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.catalog.quality import curated_tables
from daybrook.functions import columns as C
from daybrook.plans import dimensions as D, stage, warehouse as WH
from daybrook.schemas import EVENT_KEY
from daybrook.session import materialize, work_path


def _followed(spark, sf, dim):
    """One dimension through a rebuild, a late date, a replaced date, a date that comes and is emptied again."""
    raw = I.raw_interactions(spark, sf)
    if dim is D.BRIDGE:  # pairs are made from two scans, of these columns only
        staged = stage.stage_category_pairs(materialize(raw.select(*EVENT_KEY, "category_id", "p_date"), "raw"))
    else:
        staged = stage.stage_attributes(raw, dim.row)
    rows = materialize(staged, "rows")
    days = [str(r[0]) for r in rows.select("p_date").distinct().orderBy("p_date").collect()]  # one per year
    late, replaced, extra = days[1], days[-1], "2010-01-01"
    store = D.Store(spark, work_path(spark, "dimensions"), dim)
    half = F.col("pid") % 2 == 0
    last = F.col("p_date") == F.lit(replaced).cast("date")
    before = rows.where(F.col("p_date") != F.lit(late).cast("date"))
    store.rebuild(before.where(~last | half))
    store.follow(rows, [late])
    store.follow(rows, [replaced])
    store.follow(rows.withColumn("p_date", F.lit(extra).cast("date")), [extra])
    return store.follow(rows, [extra])


@query("dims_incremental_users", "SELECT * FROM dim_users")
def dims_incremental_users(spark, sf):
    """Retraction gives back the attributes of the last real date."""
    return _followed(spark, sf, D.USERS)


@query("dims_incremental_videos", "SELECT * FROM dim_videos")
def dims_incremental_videos(spark, sf):
    return _followed(spark, sf, D.VIDEOS)


@query("dims_incremental_bridge", "SELECT * FROM dim_bridge")
def dims_incremental_bridge(spark, sf):
    return _followed(spark, sf, D.BRIDGE)


@query("upsert_buckets", """
SELECT u.user_id, u.gender, CAST(CASE WHEN u.user_id % 9 = 0 THEN u.age + 1 ELSE u.age END AS SMALLINT) AS age,
       CASE WHEN u.user_id % 9 = 0 THEN 'moved' ELSE u.fre_city END AS fre_city, CAST(count(e.pid) AS INTEGER) AS total_events
FROM users_typed u LEFT JOIN ev e ON u.user_id = e.user_id GROUP BY ALL""")
def upsert_buckets(spark, sf):
    """Two loads: all users, then a ninth of them changed together with the later dates; totals cover all dates."""
    curated = curated_tables(spark, sf, I.events_told_apart(spark, sf))
    root = work_path(spark, "warehouse")
    labels = sorted(r[0] for r in curated["interactions_curated"].select(C.date_to_label("p_date")).distinct().collect())
    WH.load_dates(spark, curated, root, labels[:len(labels) // 2])
    users = curated["users"].where("user_id % 9 = 0")
    moved = users.withColumns({"age": F.col("age") + 1, "fre_city": F.lit("moved")})
    WH.load_dates(spark, {**curated, "users": moved}, root, labels[len(labels) // 2:])
    return WH.tables(spark, root)["users"].select("user_id", "gender", "age", "fre_city", "total_events")
