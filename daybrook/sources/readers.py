"""Scans. Every reader takes an explicit schema or fixed column list; nothing infers types."""

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybrook.functions import columns as C
from daybrook.schemas import CATEGORY_COLUMNS, LOG_SCHEMA, RAW_COLUMNS, text_schema
from daybrook.sources import parallel_csv

CORRUPT = "_corrupt_record"
PART = "part_date"
QUOTED_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": '""',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# source, read options and write options per storage format; the key is the name used by the layout audit
FORMATS = {
    "csv": ("csv", QUOTED_CSV, CSV_WRITE),
    "csv_gzip": ("csv", QUOTED_CSV, {**CSV_WRITE, "compression": "gzip"}),
    "json_array": ("json", {}, {}),
    "json_lines": ("json", {}, {"ignoreNullFields": "false"}),
    "parquet_snappy": ("parquet", {}, {"compression": "snappy"}),
    "parquet_zstd": ("parquet", {}, {"compression": "zstd"}),
}


def path_missing(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "").startswith("PATH_NOT_FOUND")


HEAD_BYTES = 1 << 16


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a file, from its first bytes alone: twice as many are read until a line end is among them."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(spark._jvm.java.net.URI(file))
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    size = HEAD_BYTES
    while True:
        stream = place.getFileSystem(conf).open(place)
        try:
            head = bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(size))
        finally:
            stream.close()
        if b"\n" in head or len(head) < size:
            return head.split(b"\n", 1)[0].decode("utf-8", "replace").removesuffix("\r").removeprefix("\ufeff")
        size *= 2


def csv_headers(spark: SparkSession, path):
    """The files under ``path`` by header: (column names, files) pairs; [] if all are empty, None if nothing is there.

    A file's header is its first line, byte order mark removed. Files are listed by Spark, of each only the first bytes are
    read, however large it is.
    """
    try:
        listed = spark.read.format("binaryFile").load(path).where("length > 0").select("_metadata.file_path")
        files = sorted(r[0] for r in listed.collect())  # one short row per delivered file
    except AnalysisException as exc:
        if path_missing(exc):
            return None
        raise
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda file: first_line(spark, file), files))
    found = {}
    for line, file in zip(lines, files):
        found.setdefault(line, []).append(file)
    parsed = [(next(csv.reader([line]), []), names) for line, names in sorted(found.items())]
    return [(columns, names) for columns, names in parsed if columns]


def read_quoted_csv(spark: SparkSession, path, columns, header=True, extra=(), base=None) -> DataFrame:
    """Quoted CSV, every value verbatim text, plus ``_corrupt_record`` for rows with another field count.

    ``path`` is a path or a list of files that share these columns in this order; ``extra`` names directory columns
    below ``base``. Quoted line breaks make a file unsplittable here: one file is one task, in file order. Large sources
    are read by ``read_split_csv``.
    """
    schema = T.StructType(text_schema([*columns, *extra]).fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(schema).options(**QUOTED_CSV).option("header", str(header).lower())
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false"))
    return (reader.option("basePath", base) if base else reader).csv(path)


def read_split_csv(spark: SparkSession, path, columns, header=True) -> DataFrame:
    """The rows of ``read_quoted_csv``, with every file read by as many tasks as it has blocks; in no particular order."""
    return parallel_csv.parse(parallel_csv.records(spark, path, header), columns, CORRUPT, QUOTED_CSV)


def read_delivered_csv(spark: SparkSession, path, headers, extra=(), split=False) -> DataFrame:
    """All files of a source, each read by its own header (``csv_headers``), as one table.

    With ``split`` a file is read by many tasks; its quotes have to be those of the format (``parallel_csv``).

    Known columns come in contract order, then unknown ones by name. Empty cells are ``''``; a column that a row's file
    does not have is null, which is how the raw gate tells a missing column from an empty cell. Malformed rows keep
    their ``_corrupt_record``.
    """
    found = {c for columns, _ in headers for c in columns}
    order = [c for c in RAW_COLUMNS if c in found] + sorted(found.difference(RAW_COLUMNS))
    parts = []
    for columns, files in headers:
        where, base = (path, None) if len(headers) == 1 else ([unquote(f) for f in files], path)
        if split and not extra:
            rows = read_split_csv(spark, where, columns).na.fill("", columns)
        else:
            rows = read_quoted_csv(spark, where, columns, extra=extra, base=base if extra else None).na.fill("", columns)
        parts.append(rows.select(*[F.col(c) if c in columns else F.lit(None).cast("string").alias(c) for c in order], *extra, CORRUPT))
    return reduce(DataFrame.unionByName, parts)


def good_rows(df: DataFrame, fill=True) -> DataFrame:
    """Rows with the right field count; with ``fill`` empty cells are ``''``, never null."""
    # a plan that reads nothing but the quarantine column is refused, so the filter touches a data column too
    touched = F.coalesce(F.length(df.columns[0]), F.lit(0)) >= 0
    kept = df.where(F.col(CORRUPT).isNull() & touched).drop(CORRUPT)
    return kept.na.fill("", [f.name for f in kept.schema.fields if isinstance(f.dataType, T.StringType)]) if fill else kept


def malformed_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull())


def read_raw(spark: SparkSession, root: str, p_date=None, columns=None, fmt="parquet") -> DataFrame:
    """Landed raw rows as text plus the directory date; one date when ``p_date`` is given."""
    if fmt == "csv":
        rows = good_rows(read_delivered_csv(spark, root, csv_headers(spark, root), [PART]))
        df = rows.select(*RAW_COLUMNS, PART)
    else:
        schema = T.StructType(text_schema(RAW_COLUMNS).fields + [T.StructField(PART, T.StringType())])
        df = spark.read.schema(schema).parquet(root).na.fill("", RAW_COLUMNS)
    if p_date is not None:
        df = df.where(F.col(PART) == C.check_p_date(p_date))
    return df.select(*columns) if columns else df


def read_raw_as_delivered(spark: SparkSession, root: str, p_date=None) -> DataFrame:
    """Landed Parquet with the columns it really has, for the raw gate: extra columns stay, a missing one is null or absent."""
    df = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(root).withColumn(PART, F.col(PART).cast("string"))
    return df if p_date is None else df.where(F.col(PART) == C.check_p_date(p_date))


def read_raw_date(spark: SparkSession, root: str, p_date: str, columns=None, fmt="parquet") -> DataFrame:
    """Like ``read_raw`` for one date, but a date that was never landed is an error naming it."""
    p_date = C.check_p_date(p_date)
    if p_date not in partition_dates(spark, root):
        raise FileNotFoundError(f"raw partition not found: {root}/{PART}={p_date}")
    return read_raw(spark, root, p_date, columns, fmt)


def partition_dates_df(spark: SparkSession, root: str, column=PART) -> DataFrame:
    """Distinct partition values under a root, ascending, empty partitions included: one listed row per file, no file is opened."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    listing = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()), *schema.fields])
    try:
        df = spark.read.format("binaryFile").schema(listing).load(root)
        return df.select(column).distinct().orderBy(column)
    except AnalysisException as exc:
        if path_missing(exc):
            return spark.createDataFrame([], schema)
        raise


def partition_dates(spark: SparkSession, root: str, column=PART):
    """The catalogue as a list on the driver: one short string per date partition."""
    return [r[0] for r in partition_dates_df(spark, root, column).collect()]


def read_partition(spark: SparkSession, root: str, schema, date, column="p_date") -> DataFrame:
    """One date of a partitioned Parquet table; the filter becomes a partition filter."""
    return spark.read.schema(schema).parquet(root).where(F.col(column) == F.lit(date))


def read_table(spark: SparkSession, root: str, schema=None, columns=None) -> DataFrame:
    """All partitions of a table, only the wanted columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(root)
    return df.select(*columns) if columns else df


def read_categories_csv(spark: SparkSession, path: str) -> DataFrame:
    """The lookup as text with its file order: file name, then position in the file.

    A quoted CSV file is never split, so ids rise along each file whatever files share a task.
    """
    rows = read_quoted_csv(spark, path, CATEGORY_COLUMNS).withColumn(
        "_file_seq", F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row")))
    return good_rows(rows)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``*.txt`` file: name and whole text."""
    df = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.txt").text(path)
    return df.select(F.col("_metadata.file_name").alias("file_name"), "value")


def read_json_documents(spark: SparkSession, path: str, schema, multi_line=True) -> DataFrame:
    """Landed payloads: one record per object, or per element of a top-level array."""
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The append-only log; lines that are not JSON objects are skipped."""
    return spark.read.schema(LOG_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def last_ok_batch(log: DataFrame, by="source") -> DataFrame:
    """Latest successful batch per source: highest ``logged_at``, then batch id."""
    return (
        log.where(F.col("status").startswith("OK"))
        .groupBy(by).agg(F.max_by("batch_id", F.struct("logged_at", "batch_id")).alias("batch_id"))
    )


def last_ok_batch_id(spark: SparkSession, path: str, source: str):
    """Batch id to stamp on staged events; None without a log or a successful run."""
    try:
        row = last_ok_batch(read_log(spark, path).where(F.col("source") == source)).first()
    except AnalysisException as exc:
        if path_missing(exc):
            return None
        raise
    return row["batch_id"] if row else None


def read_format(spark: SparkSession, fmt: str, path: str, schema, columns=None) -> DataFrame:
    """Any of the audited formats with an explicit schema, optionally only some columns."""
    source, options, _ = FORMATS[fmt]
    df = spark.read.schema(schema).options(**options).format(source).load(path)
    return df.select(*columns) if columns else df


def read_inferred(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """The format with its own type inference: what the layout audit measures, used nowhere else."""
    source, options, _ = FORMATS[fmt]
    return spark.read.options(**options).option("inferSchema", "true").format(source).load(path)


def preview(df: DataFrame, n=1000) -> DataFrame:
    """Sample preview of the first rows."""
    return df.limit(n)
