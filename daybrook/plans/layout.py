"""Storage layout: format fidelity and size, partition statistics, read strategies."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daybrook.operators import compare
from daybrook.schemas import EVENT_KEY
from daybrook.sources import readers as R, sinks as W

SUBSET_COLUMNS = ["user_id", "p_date", "watch_time"]


def write_all_formats(df: DataFrame, root: str):
    """The same rows in every audited format; returns format -> path."""
    paths = {fmt: f"{root}/{fmt}" for fmt in R.FORMATS}
    for fmt, path in paths.items():
        W.write_format(df, fmt, path)
    return paths


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under a path; files are listed, not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def format_fidelity(df: DataFrame, paths: dict, key=EVENT_KEY, infer=False) -> DataFrame:
    """Column status per format. With ``infer`` every reader guesses its own types, as the audit measures."""
    spark = df.sparkSession
    out = []
    for fmt, path in paths.items():
        loaded = R.read_inferred(spark, fmt, path) if infer else R.read_format(spark, fmt, path, df.schema)
        out.append(compare.fidelity(df, loaded, key).select(F.lit(fmt).alias("format"), "*"))
    return reduce(DataFrame.unionByName, out)


def format_sizes(spark: SparkSession, paths: dict) -> DataFrame:
    out = [stored_bytes(spark, path).select(F.lit(fmt).alias("format"), "files", "bytes")
           for fmt, path in paths.items()]
    return reduce(DataFrame.unionByName, out)


def partition_stats(spark: SparkSession, root: str, schema, column="p_date") -> DataFrame:
    """Rows, files, bytes and share of rows per partition, and the largest / smallest ratio."""
    files = (
        spark.read.schema(schema).parquet(root)
        .select(column, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
        .groupBy(column, "f", "b").agg(F.count(F.lit(1)).alias("n"))
    )
    per = files.groupBy(column).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("files"), F.sum("b").alias("bytes"))
    # one row per date partition from here on
    w = Window.partitionBy(F.lit(0))
    return per.select(
        column, "n_rows", "files", "bytes",
        (F.col("n_rows").cast("double") / F.sum("n_rows").over(w)).alias("share_of_rows"),
        (F.max("n_rows").over(w).cast("double") / F.min("n_rows").over(w)).alias("skew_ratio"))


STRATEGIES = ["partition_read", "full_scan", "single_pushdown", "clustered_pushdown"]


def read_one_date(spark: SparkSession, strategy: str, path: str, schema, date, column="p_date") -> DataFrame:
    """One date of a table, read in one of four ways. They differ in what the scan can skip, never in the rows."""
    rows = spark.read.schema(schema).parquet(path)
    if strategy == "full_scan":
        # the filter hides the column behind an expression, so nothing is pruned: the baseline
        rows = rows.where(F.concat(F.col(column).cast("string"), F.lit("")) == F.lit(str(date)))
    else:
        rows = rows.where(F.col(column) == F.lit(date))
    return rows.select(*[f.name for f in schema.fields])


def read_strategies(spark: SparkSession, partitioned: str, single: str, clustered: str, schema, date, column="p_date"):
    """Every strategy on the stored copy it needs."""
    paths = dict(zip(STRATEGIES, (partitioned, partitioned, single, clustered)))
    return {s: read_one_date(spark, s, path, schema, date, column) for s, path in paths.items()}


def compare_strategies(strategies: dict, baseline="full_scan") -> DataFrame:
    """Rows returned per strategy and rows that differ from the baseline."""
    out = [compare.multiset_difference(df, strategies[baseline]).select(
        F.lit(name).alias("strategy"), F.col("left_rows").alias("rows_returned"), "only_left", "only_right")
        for name, df in strategies.items()]
    return reduce(DataFrame.unionByName, out)


def scanned_files(strategies: dict) -> DataFrame:
    """Files and bytes each strategy's rows come from."""
    out = [df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")).select(
        F.lit(name).alias("strategy"), "files", "bytes") for name, df in strategies.items()]
    return reduce(DataFrame.unionByName, out)
