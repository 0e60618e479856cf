"""The model's input tables, derived by Spark from the driver's parquet tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daybrook.functions import columns as C
from daybrook.schemas import CATEGORY_COLUMNS, EVENT_KEY, RAW_COLUMNS
from daybrook.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _txt(c):
    return c.cast("string")


def _flag(cond):
    return F.when(cond, F.lit("True")).otherwise(F.lit("False"))


def user_attributes(spark, sf_dir) -> DataFrame:
    """Customer rows as user attributes, text typed."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    seg = F.col("c_mktsegment")
    region = F.col("n_regionkey")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        _txt(F.col("c_custkey")).alias("user_id"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "M").otherwise("F").alias("gender"),
        _txt(F.col("c_nationkey") + 18).alias("age"),
        _txt(F.floor(F.abs("c_acctbal"))).alias("mod_price"),
        F.col("n_name").alias("fre_city"),
        F.when(seg == "AUTOMOBILE", "乡村").when(seg == "FURNITURE", "镇区").when(seg == "HOUSEHOLD", "unknown")
        .otherwise("城区").alias("fre_community_type"),
        F.when(region == 0, "一线城市").when(region == 1, "新一线城市").when(region == 2, "二线城市")
        .when(region == 3, "三线城市").otherwise("unknown").alias("fre_city_level"),
    )


# bits of ``_line_bits``: what an order line's flags and copies depend on
_LIKE, _CLICK, _COMMENT, _FOLLOW, _COLLECT, _HATE, _SAME_DATE, _NEXT_DATE = (1 << i for i in range(8))


def _line_bits():
    """The conditions of an order line in one number: a row that is shuffled carries eight bytes for all of them."""
    returned = F.col("l_returnflag")
    conditions = {
        _LIKE: returned == "A", _CLICK: F.col("l_linestatus") == "O", _COMMENT: F.col("l_discount") > 0.055,
        _FOLLOW: F.col("l_tax") > 0.055, _COLLECT: F.col("l_tax") < 0.015, _HATE: F.col("l_discount") < 0.005,
        _SAME_DATE: returned == "A", _NEXT_DATE: (returned == "R") & (F.col("l_linestatus") == "F"),
    }
    return reduce(lambda x, y: x + y, [F.when(cond, F.lit(bit)).otherwise(F.lit(0)) for bit, cond in conditions.items()])


def _bit(bit):
    return F.col("bits").bitwiseAND(F.lit(bit)) != 0


def _fanout(spark, sf_dir, copies=None) -> DataFrame:
    """Order lines as text rows; ``copies`` is an array column with one element per row to emit.

    Users join the orders, parts the lines: the wide user attributes never move with a line, and a line moves twice.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", (F.col("o_orderstatus") == "P").alias("forward"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
        _line_bits().alias("bits"))
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", (F.regexp_extract("p_brand", "[0-9]+", 0).cast("int") - 1).alias("cat"))
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("cat"), F.col("n_regionkey").alias("root"))
    u = user_attributes(spark, sf_dir)
    j = (
        li.join(p.join(n, "cat"), F.col("l_partkey") == F.col("p_partkey"))
        .join(o.join(u, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    j = j.withColumn("copy", F.explode(copies) if copies is not None else F.lit(0))
    return j.select(
        "user_id",
        _txt(F.col("o_orderkey")).alias("pid"),
        _txt(F.col("l_suppkey")).alias("author_id"),
        _txt(F.col("cat")).alias("category_id"),
        _txt(1 + F.col("cat") % 3).alias("category_level"),
        _txt(F.col("root")).alias("parent_id"),
        _txt(F.col("root")).alias("root_id"),
        _txt(C.epoch_seconds("o_orderdate") + F.col("o_orderkey") % 86400).alias("exposed_time"),
        _txt(F.col("l_suppkey") * 10 + 5).alias("author_fans_count"),
        _txt(F.col("quantity")).alias("watch_time"),
        F.concat(_txt(F.lit(8) + F.col("l_linenumber") * 4), F.lit(".0")).alias("duration"),
        _flag(_bit(_LIKE)).alias("cvm_like"),
        _flag(_bit(_CLICK)).alias("click"),
        _flag(_bit(_COMMENT)).alias("comment"),
        _flag(_bit(_FOLLOW)).alias("follow"),
        _flag(_bit(_COLLECT)).alias("collect"),
        _flag(F.col("forward")).alias("forward"),
        _flag(_bit(_HATE)).alias("hate"),
        F.col("p_name").alias("tag_name"),
        F.col("p_type").alias("title"),
        _txt((F.col("o_orderkey") + F.col("l_linenumber") % 2) % 24).alias("p_hour"),
        F.concat(_txt(F.year("o_orderdate") + F.when(F.col("copy") == 2, 1).otherwise(0)), F.lit("0101")).alias("p_date"),
        "gender", "age", "mod_price", "fre_city", "fre_community_type", "fre_city_level",
    )


def raw_fanout(spark, sf_dir) -> DataFrame:
    """One text row per event, category and tag, no injected copies."""
    return _fanout(spark, sf_dir).select(*RAW_COLUMNS)


def raw_interactions(spark, sf_dir) -> DataFrame:
    """The fan-out plus exact copies (returned lines) and copies under the next date partition."""
    copies = F.array_compact(F.array(F.lit(0), F.when(_bit(_SAME_DATE), 1), F.when(_bit(_NEXT_DATE), 2)))
    return _fanout(spark, sf_dir, copies).select(*RAW_COLUMNS)


def landed_raw(spark, sf_dir) -> DataFrame:
    """``raw_interactions`` stored once, as the raw layer is, for plans that scan it several times."""
    return materialize(raw_interactions(spark, sf_dir), "raw")


def raw_with_defects(spark, sf_dir) -> DataFrame:
    """``raw_interactions`` with one kind of bad value per tag or title, for the failing gate branches."""
    r = raw_interactions(spark, sf_dir).withColumn("part_date", F.col("p_date"))
    tag, year = F.col("tag_name"), F.col("part_date")

    def spoil(column, cond, value):
        return F.when(cond, F.lit(value)).otherwise(F.col(column)).alias(column)

    red, blue = tag.startswith("red"), tag.startswith("blue")
    spoiled = {
        "p_hour": spoil("p_hour", red & (year == "19960101"), "24"),
        "age": spoil("age", blue & (year == "19960101"), "201"),
        "watch_time": F.when(red & (year == "19970101"), "-1").when(red & (year == "19990101"), "ten")
        .otherwise(F.col("watch_time")).alias("watch_time"),
        "duration": F.when(blue & (year == "19970101"), "0").when(blue & (year == "19990101"), "1.0d")
        .otherwise(F.col("duration")).alias("duration"),
        "mod_price": spoil("mod_price", red & (year == "19960101"), "-5"),
        "exposed_time": spoil("exposed_time", blue & (year == "19970101"), "0"),
        "hate": spoil("hate", blue & (year == "19990101"), "maybe"),
        "gender": F.when(red & (year == "19960101"), "X").when(red & (year == "20000101"), " ")
        .otherwise(F.col("gender")).alias("gender"),
        "fre_community_type": spoil("fre_community_type", red & (year == "19970101"), "suburb"),
        "fre_city_level": spoil("fre_city_level", red & (year == "19970101"), "六线城市"),
        "category_id": spoil("category_id", red & (year == "19980101"), "999"),
        "p_date": spoil("p_date", blue & (year == "19980101"), "19980102"),
    }
    return r.select(*[spoiled.get(c, F.col(c)) for c in RAW_COLUMNS], "part_date")


def raw_categories(spark, sf_dir) -> DataFrame:
    """Lookup of the 25 category ids with a second, conflicting label for some, in file order."""
    n = table(spark, sf_dir, "nation")
    base = n.select(
        _txt(1 + F.col("n_nationkey") % 3).alias("category_level"),
        _txt(F.col("n_nationkey")).alias("category_id"),
        F.col("n_name").alias("category_name_cn"),
        _txt(F.col("n_regionkey")).alias("parent_id"),
        _txt(F.col("n_regionkey")).alias("root_id"),
        F.concat(F.lit(" "), F.col("n_name")).alias("category_name_en"),
        F.col("n_nationkey").cast("bigint").alias("_file_seq"),
    )
    second = base.where(F.col("root_id") == "0").select(
        "category_level", "category_id", "category_name_cn", "parent_id", "root_id",
        F.concat("category_name_en", F.lit("_alt")).alias("category_name_en"),
        (F.col("_file_seq") + 100).alias("_file_seq"))
    return base.unionByName(second)


def raw_part_categories(spark, sf_dir) -> DataFrame:
    """A lookup that grows with the data: every part is a category; LARGE parts carry a second label."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    base = p.select(
        _txt(1 + key % 3).alias("category_level"),
        _txt(key).alias("category_id"),
        F.concat(F.lit("　"), F.col("p_name"), F.lit(" ")).alias("category_name_cn"),
        _txt(F.col("p_size")).alias("parent_id"),
        _txt(F.col("p_size")).alias("root_id"),
        F.when(F.col("p_type") == "PROMO", F.lit("  ")).otherwise(
            F.concat(F.lit(" "), F.col("p_name"))).alias("category_name_en"),
        (key * 2).alias("_file_seq"),
        "p_type",
    )
    second = base.where(F.col("p_type") == "LARGE").withColumn(
        "category_name_en", F.col("p_type")).withColumn("_file_seq", F.col("_file_seq") + 1)
    return base.unionByName(second).select(*CATEGORY_COLUMNS, "_file_seq")


def transcripts(spark, sf_dir) -> DataFrame:
    """Documents as transcript files: ``<doc_id>.txt``; one source carries non-numeric names."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.when(F.col("source") == "src7", F.concat(F.lit("note-"), _txt(F.col("doc_id")), F.lit(".txt")))
        .otherwise(F.concat(_txt(F.col("doc_id")), F.lit(".txt"))).alias("file_name"),
        F.col("text").alias("value"))


def daily_events(spark, sf_dir) -> DataFrame:
    """The ``events`` table as typed events, one row per event, 30 dates."""
    e = table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("pid"),
        C.epoch_seconds("ts").alias("exposed_time"),
        F.floor("value").cast("bigint").alias("watch_time"),
        F.to_date("ts").alias("p_date"),
        F.hour("ts").cast("bigint").alias("p_hour"),
        "event_type",
    )
    kind = F.col("event_type")
    return e.select(
        "user_id", "pid", (F.col("pid") * 7 + 11).alias("author_id"), "exposed_time",
        (F.col("user_id") * 10 + F.col("pid")).alias("author_fans_count"),
        "watch_time", (F.lit(20.0) + (F.col("pid") % 60).cast("double")).alias("duration"),
        (kind == "purchase").alias("cvm_like"), (kind == "click").alias("click"),
        (kind == "view").alias("comment"), (kind == "signup").alias("follow"),
        ((kind == "purchase") & (F.col("watch_time") > 20)).alias("collect"),
        (F.col("watch_time") > 50).alias("forward"), (kind == "error").alias("hate"),
        F.concat(kind, F.lit("-"), _txt(F.col("pid"))).alias("title"),
        "p_hour", "p_date",
        (1 + F.col("pid") % 4).alias("tag_count"),
        C.try_ratio("watch_time", F.lit(20.0) + (F.col("pid") % 60).cast("double")).alias("watch_ratio"),
        (F.col("watch_time") > F.lit(20.0) + (F.col("pid") % 60).cast("double")).alias("is_rewatch_flagged"),
        F.concat(F.lit("batch-"), C.date_to_label("p_date")).alias("ingest_batch_id"),
    )


def events_told_apart(spark, sf_dir) -> DataFrame:
    """``daily_events`` with a key of its own for every row, as the warehouse asks for.

    The table's events are finer than seconds, so one user and video may have several in a second; every one of them is an
    event. ``exposed_time`` counts microseconds here, and the events of one second are numbered from its start.
    """
    same_second = Window.partitionBy(*EVENT_KEY).orderBy("title", "watch_time")
    return daily_events(spark, sf_dir).withColumn(
        "exposed_time", F.col("exposed_time") * 1_000_000 + F.row_number().over(same_second) - 1)


def daily_events_in_two_dates(spark, sf_dir) -> DataFrame:
    """``daily_events`` plus a copy of every sign-up under the following date."""
    e = daily_events(spark, sf_dir)
    return e.unionByName(e.where("follow").withColumn("p_date", F.date_add("p_date", 1)))


def video_categories(spark, sf_dir) -> DataFrame:
    """Bridge of the 100 daily-event videos: two categories each, from the pairs seen in ``events``."""
    pids = daily_events(spark, sf_dir).select("pid").distinct()
    return pids.select("pid", (F.col("pid") % 25).alias("category_id")).unionByName(
        pids.select("pid", ((F.col("pid") * 3 + 1) % 25).alias("category_id"))).distinct()


def users(spark, sf_dir) -> DataFrame:
    """Typed users dimension of every customer."""
    u = user_attributes(spark, sf_dir)
    return u.select(
        F.col("user_id").cast("bigint").alias("user_id"), "gender", F.col("age").cast("bigint").alias("age"),
        F.col("mod_price").cast("bigint").alias("mod_price"), "fre_city", "fre_community_type", "fre_city_level")


def ingest_log(spark, sf_dir) -> DataFrame:
    """Orders as status rows of an ingestion log: batch per order, source per priority."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("batch-"), _txt(F.col("o_orderkey"))).alias("batch_id"),
        F.col("o_orderpriority").alias("source"),
        F.when(F.col("o_orderstatus") == "O", "OK").when(F.col("o_orderstatus") == "P", "OK_WITH_WARNINGS")
        .otherwise("ERROR").alias("status"),
        _txt(F.col("o_totalprice")).alias("detail"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00+00:00")).alias("logged_at"))
