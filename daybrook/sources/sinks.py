"""Writers: partitioned landing, partition replacement, upsert, reports and bulk copy."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from daybrook.schemas import LOG_SCHEMA
from daybrook.session import STORED, freeing, materialize, release
from daybrook.sources.readers import CSV_WRITE, FORMATS, PART, partition_dates_df, path_missing


CSV_ROWS_PER_FILE = 1_000_000
# dates up to which landed rows are not dealt by date: a task that reads one block of a stored copy writes at most so many files
FEW_DATES = 16


def by_date(df: DataFrame, column: str) -> DataFrame:
    """Rows of one date together, sized by the adaptive planner: hot dates are split, small ones merged.

    Without it every task writes a file for every date it holds; with a plain hash by date the
    hottest date would be one task.
    """
    return df.hint("rebalance", column)


def write_partitions(df: DataFrame, root: str, column="p_date", fmt="parquet", stored=False, **options):
    """Replace exactly the date partitions present in ``df``; other dates stay.

    ``stored``: the tasks that read ``df`` hold few dates each, as those of a table of one or few dates do. Rows stay where they
    are read.
    """
    if fmt == "parquet":
        options = {**STORED, **options}
    with freeing(df.sparkSession):
        ((df if stored else by_date(df, column)).write.mode("overwrite").partitionBy(column)
         .option("partitionOverwriteMode", "dynamic").options(**options).format(fmt).save(root))


def replace_all(df: DataFrame, root: str, column="p_date", stored=False):
    """Replace the whole partitioned table: dates without rows disappear. ``root`` must not be an input of ``df``.

    ``stored``: ``df`` is read from a table stored by the same column, whose tasks hold few dates each. Its rows stay where
    they are read.
    """
    with freeing(df.sparkSession):
        ((df if stored else by_date(df, column)).write.mode("overwrite").partitionBy(column)
         .option("partitionOverwriteMode", "static").options(**STORED).parquet(root))


def replace_partition(df: DataFrame, root: str, column: str, date):
    """Delete one date and insert the given rows, also when there are none. Returns rows inserted.

    ``df`` is read more than once: pass a stored table, not a long plan.

    A dynamic overwrite with no rows would leave the old partition; an empty replacement writes an empty
    file into the partition directory instead.
    """
    spark = df.sparkSession
    day = df.where(F.col(column) == F.lit(date))
    if day.isEmpty():
        day.drop(column).write.mode("overwrite").parquet(f"{root}/{column}={date}")
        return 0
    write_partitions(day, root, column, stored=True)  # one date: a file a task, no row has to move
    return spark.read.schema(df.schema).parquet(root).where(F.col(column) == F.lit(date)).count()


def few_dates(stored: DataFrame, column="p_date") -> bool:
    """At most ``FEW_DATES`` dates: rows may stay where they are read. Scans one column of a stored table."""
    return stored.select(column).distinct().limit(FEW_DATES + 1).count() <= FEW_DATES


def fanout_by_date(raw: DataFrame, root: str, fmt="parquet", stored=None):
    """Land raw text by date. The data keeps its own ``p_date``; the directory column is ``part_date``.

    ``stored``: as for ``write_partitions``. Unless given, rows are stored once, columns compressed, to see how many dates they
    have: whole text rows that move by date take several times that room.
    """
    # a landed CSV file is one task to read, compressed or not, so it holds a bounded number of rows
    options = {} if fmt == "parquet" else {**CSV_WRITE, "maxRecordsPerFile": CSV_ROWS_PER_FILE, "compression": "gzip"}
    copy = materialize(raw, "landing") if stored is None else None
    rows = raw if copy is None else copy
    write_partitions(rows.withColumn(PART, F.col("p_date")), root, PART, fmt, few_dates(rows) if stored is None else stored, **options)
    if copy is not None:
        release(copy)


def land_missing_dates(raw: DataFrame, root: str, fmt="parquet", stored=None):
    """Skip-if-exists landing: dates already under the root are immutable and left alone. ``stored``: as for ``fanout_by_date``."""
    spark = raw.sparkSession
    known = partition_dates_df(spark, root, PART)
    new = raw.join(known, raw["p_date"] == known[PART], "left_anti")
    fanout_by_date(new, root, fmt, stored)


def rows_per_date(df: DataFrame, column=PART) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def append_log(spark, path: str, events):
    """Append status rows of one batch; ``events`` are (batch_id, source, status, detail, logged_at) tuples."""
    spark.createDataFrame(events, LOG_SCHEMA).coalesce(1).write.mode("append").json(path)


def write_report(df: DataFrame, path: str, partition_by=()):
    """JSON report, readable without escapes; replaces the partitions it holds."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    with freeing(df.sparkSession):
        writer.json(path)


def publish_once(spark, path: str, text: str) -> bool:
    """Create a small file if nothing has its name yet. False if something has: of several writers one succeeds.

    The file is written under another name and renamed without overwriting, so it appears whole or not at all.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    files = target.getFileSystem(conf)
    waiting = hadoop.Path(target.getParent().getParent(), f"_pending/{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    stream = files.create(waiting, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(files.getUri(), conf).rename(
            files.makeQualified(waiting), files.makeQualified(target), no_overwrite)
    except Py4JJavaError as exc:
        files.delete(waiting, False)
        if "AlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def overwrite_table(df: DataFrame, path: str):
    """Whole-table rebuild. ``path`` must not be an input of ``df``."""
    with freeing(df.sparkSession):
        df.write.mode("overwrite").options(**STORED).parquet(path)


def put_in_place(df: DataFrame, path: str):
    """Whole-table rebuild from a plan that may read ``path`` itself: written once, beside it, and renamed into its place."""
    spark = df.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    waiting = hadoop.Path(target.getParent(), f"_next-{uuid.uuid4().hex}")
    with freeing(spark):
        df.write.options(**STORED).parquet(waiting.toString())
    files = target.getFileSystem(conf)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(waiting, target):
        raise OSError(f"{waiting} could not be renamed to {path}")


def replace_date(df: DataFrame, root: str, column: str, date):
    """``replace_partition`` for a plan that is not stored: it runs once and is written once, also when it has no rows."""
    put_in_place(df.where(F.col(column) == F.lit(date).cast(df.schema[column].dataType)).drop(column), f"{root}/{column}={date}")


def write_format(df: DataFrame, fmt: str, path: str):
    """Any of the audited formats. JSON arrays are written one record array per line."""
    source, _, options = FORMATS[fmt]
    if fmt == "json_array":
        df.select(F.to_json(F.array(F.struct(*df.columns)), {"ignoreNullFields": "false"})).write.text(path)
    else:
        df.write.options(**options).format(source).save(path)


def write_clustered(df: DataFrame, path: str, column="p_date", spread=None):
    """Range-clustered copy without directories: footer statistics of each row group cover few dates.

    Ranges run over the date and then ``spread`` (by default the first other column), so a date with most of the rows
    is several tasks.
    """
    spread = spread or next((c for c in df.columns if c != column), column)
    df.repartitionByRange(column, spread).sortWithinPartitions(column, spread).write.parquet(path)


def upsert(target: DataFrame, source: DataFrame, columns, key) -> DataFrame:
    """Update by key, insert new keys, keep the rest. Target columns outside ``columns`` keep their values.

    With only key columns nothing is updated. Keys are unique on both sides.
    """
    key = list(key)
    extra = [c for c in target.columns if c not in columns]
    s = source.select(*columns).withColumn("_new", F.lit(True)).alias("s")
    t = target.alias("t")
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in extra:
            out.append(F.col(f"t.{c}").alias(c))
        else:
            out.append(F.when(F.col("s._new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    on = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in key]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return t.join(s, cond, "full_outer").select(*out)


def read_or_empty(spark, path: str, schema) -> DataFrame:
    """A table that may not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if path_missing(exc):
            return spark.createDataFrame([], schema)
        raise


def copy_to_jdbc(df: DataFrame, url: str, table: str, columns, properties=None, batch_rows=10000):
    """Bulk append of named columns into a relational table; nulls travel as SQL nulls."""
    (df.select(*columns).write.mode("append").option("batchsize", batch_rows)
     .jdbc(url, table, properties=properties or {}))
