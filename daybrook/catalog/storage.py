"""Scans, sinks and layout over the driver's tables. Each query writes to a fresh path and reads it back."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import query
from daybrook.functions import columns as C
from daybrook.plans import curate, ingest, layout, stage
from daybrook.schemas import CURATED_EVENT_COLUMNS
from daybrook.session import materialize, release, work_path
from daybrook.sources import readers as R, sinks as W

DAY = "2024-01-15"


def _curated_root(spark, sf):
    """The curated fact written by date; returns (path, schema)."""
    df = curate.curated_events(I.daily_events(spark, sf))
    root = work_path(spark, "curated")
    W.write_partitions(df, root, "p_date")
    return root, df.schema


@query("csv_quoted_roundtrip", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS title, lang, source FROM documents""")
def csv_quoted_roundtrip(spark, sf):
    d = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("title"), "lang", "source")
    path = work_path(spark, "csv")
    d.write.options(**R.CSV_WRITE).csv(path)
    return R.good_rows(R.read_quoted_csv(spark, path, d.columns))


@query("csv_parallel_quoted", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS title, lang, source FROM documents""")
def csv_parallel_quoted(spark, sf):
    """The same cells, with line breaks inside, when every file is read by as many tasks as it has blocks."""
    d = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("title"), "lang", "source")
    path = work_path(spark, "csv")
    d.write.options(**R.CSV_WRITE).csv(path)
    return R.good_rows(R.read_split_csv(spark, path, d.columns))


@query("csv_malformed_counts", """
SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS source, o_orderstatus <> 'O' AS malformed,
       count(*) AS n_rows FROM orders GROUP BY ALL""")
def csv_malformed_counts(spark, sf):
    """Lines with too few fields (status F) and too many (status P) are counted, the others kept."""
    key = F.col("o_orderkey").cast("string")
    line = (F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", key, F.lit("short")))
            .when(F.col("o_orderstatus") == "P", F.concat_ws(",", key, F.lit("a"), F.lit("b"), F.lit("c")))
            .otherwise(F.concat_ws(",", key, "o_orderpriority", F.lit('"x, ""y"""'))))
    path = work_path(spark, "csv")
    I.table(spark, sf, "orders").select(line).write.text(path)
    rows = R.read_quoted_csv(spark, path, ["batch", "source", "note"], header=False)
    bad = F.col(R.CORRUPT).isNotNull()
    return rows.groupBy(F.when(~bad, F.col("source")).alias("source"), bad.alias("malformed")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("raw_text_scan", """
SELECT user_id, pid, exposed_time, tag_name, title, duration, p_date, p_date AS part_date FROM raw""")
def raw_text_scan(spark, sf):
    root = work_path(spark, "raw")
    W.fanout_by_date(I.raw_interactions(spark, sf), root)
    return R.read_raw(spark, root, columns=[
        "user_id", "pid", "exposed_time", "tag_name", "title", "duration", "p_date", R.PART])


@query("raw_partition_scan", "SELECT * FROM raw WHERE p_date = '19980101'")
def raw_partition_scan(spark, sf):
    root = work_path(spark, "raw")
    W.fanout_by_date(I.raw_interactions(spark, sf), root)
    return R.read_raw_date(spark, root, "19980101").drop(R.PART)


@query("missing_partition", "SELECT p_date, count(*) AS n_rows, true AS landed FROM raw GROUP BY 1 UNION ALL SELECT '20300101', 0, false")
def missing_partition(spark, sf):
    """Each date read on its own; a date that was never landed is an error, not an empty table."""
    root = work_path(spark, "raw")
    W.fanout_by_date(I.raw_interactions(spark, sf), root)
    out = None
    for label in [*R.partition_dates(spark, root), "20300101"]:
        try:
            rows, landed = R.read_raw_date(spark, root, label), True
        except FileNotFoundError:
            rows, landed = R.read_raw(spark, root, label), False
        row = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("p_date"), "n_rows", F.lit(landed).alias("landed"))
        out = row if out is None else out.unionByName(row)
    return out


@query("fanout_by_date", "SELECT p_date AS part_date, count(*) AS n_rows FROM raw GROUP BY 1")
def fanout_by_date(spark, sf):
    """Fan-out to one CSV directory per date, counted from the landed copy."""
    root = work_path(spark, "rawcsv")
    W.fanout_by_date(I.raw_interactions(spark, sf), root, "csv")
    return W.rows_per_date(R.read_raw(spark, root, fmt="csv"))


@query("skip_existing_dates", """
SELECT p_date AS part_date, count(*) AS n_rows FROM fanout WHERE p_date < '19980101' GROUP BY 1
UNION ALL SELECT p_date, count(*) FROM raw WHERE p_date >= '19980101' GROUP BY 1""")
def skip_existing_dates(spark, sf):
    """Dates landed before stay as they are; only the new dates of the second delivery arrive."""
    root = work_path(spark, "raw")
    W.fanout_by_date(I.raw_fanout(spark, sf).where("p_date < '19980101'"), root)
    W.land_missing_dates(I.raw_interactions(spark, sf), root)
    return W.rows_per_date(R.read_raw(spark, root))


def _deliver_lookup(lookup, path):
    """CSV files whose names and rows follow the file order."""
    lookup.repartitionByRange("_file_seq").sortWithinPartitions("_file_seq").drop("_file_seq").write.options(
        **R.CSV_WRITE).csv(path)


@query("category_lookup_staged", "SELECT * FROM dim_part_cats")
def category_lookup_staged(spark, sf):
    """Lookup CSV with its file order, landed and staged."""
    src, root = work_path(spark, "lookup"), work_path(spark, "categories")
    lookup = I.raw_part_categories(spark, sf)
    _deliver_lookup(lookup, src)
    W.overwrite_table(R.read_categories_csv(spark, src), root)
    return stage.stage_categories(spark.read.parquet(root))


@query("transcripts_landed", "SELECT * FROM dim_transcripts")
def transcripts_landed(spark, sf):
    root = work_path(spark, "transcripts")
    W.overwrite_table(I.transcripts(spark, sf), root)
    return stage.stage_transcripts(spark.read.parquet(root))


@query("json_payload_scan", """
SELECT pid, kind, CAST(count(*) AS BIGINT) AS records, CAST(sum(seconds) AS BIGINT) AS seconds FROM (
  SELECT pid, 'object' AS kind, watch_time AS seconds FROM ev WHERE NOT click
  UNION ALL SELECT pid, 'array', watch_time FROM ev WHERE click
  UNION ALL SELECT pid, 'array', exposed_time FROM ev WHERE click) GROUP BY pid, kind""")
def json_payload_scan(spark, sf):
    """Object and array payloads in the same landing folder; an array yields one record per element."""
    e = I.daily_events(spark, sf)

    def rec(kind, seconds):
        return F.struct("pid", F.lit(kind).alias("kind"), F.col(seconds).alias("seconds"))

    doc = F.when(F.col("click"), F.to_json(F.array(rec("array", "watch_time"), rec("array", "exposed_time")))).otherwise(
        F.to_json(rec("object", "watch_time")))
    path = work_path(spark, "payload")
    e.select(doc).write.text(path)
    got = R.read_json_documents(spark, path, "pid bigint, kind string, seconds bigint", multi_line=False)
    return got.groupBy("pid", "kind").agg(F.count(F.lit(1)).alias("records"), F.sum("seconds").alias("seconds"))


@query("lineage_last_ok_batch", """
SELECT source, arg_max(batch_id, logged_at || batch_id) AS batch_id FROM log WHERE starts_with(status, 'OK') GROUP BY source""")
def lineage_last_ok_batch(spark, sf):
    """Append-only log with broken lines; the latest successful batch per source."""
    path = work_path(spark, "log")
    log = I.ingest_log(spark, sf)
    log.write.json(path)
    log.where("status = 'ERROR'").select(F.concat(F.lit("not json "), "batch_id")).write.mode("append").text(path)
    return R.last_ok_batch(R.read_log(spark, path))


@query("partition_read", f"SELECT * FROM ({{}}) WHERE p_date = DATE '{DAY}'".format(
    "SELECT user_id, pid, exposed_time, p_date, p_hour, author_fans_count, watch_time, watch_ratio, is_rewatch_flagged, "
    'tag_count, cvm_like, click, comment, follow, "collect", forward, hate, ingest_batch_id FROM ev'))
def partition_read(spark, sf):
    root, schema = _curated_root(spark, sf)
    return R.read_partition(spark, root, schema, F.lit(DAY).cast("date")).select(*CURATED_EVENT_COLUMNS)


@query("partition_catalog", "SELECT DISTINCT strftime(p_date, '%Y-%m-%d') AS p_date FROM ev")
def partition_catalog(spark, sf):
    root, _ = _curated_root(spark, sf)
    return R.partition_dates_df(spark, root, "p_date")


@query("column_pruned_read", "SELECT user_id, p_date, watch_time FROM ev")
def column_pruned_read(spark, sf):
    root, schema = _curated_root(spark, sf)
    return R.read_table(spark, root, schema, layout.SUBSET_COLUMNS)


@query("pushdown_equals_fullscan", f"""
SELECT s.strategy, n AS rows_returned, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
FROM (SELECT count(*) AS n FROM ev WHERE p_date = DATE '{DAY}'),
     (VALUES ('partition_read'), ('full_scan'), ('single_pushdown'), ('clustered_pushdown')) s(strategy)""")
def pushdown_equals_fullscan(spark, sf):
    """Four read strategies for one date return the same multiset of rows."""
    root, schema = _curated_root(spark, sf)
    df = R.read_table(spark, root, schema)
    single, clustered = work_path(spark, "single"), work_path(spark, "clustered")
    df.write.parquet(single)
    W.write_clustered(df, clustered)
    strategies = layout.read_strategies(spark, root, single, clustered, schema, DAY)
    return layout.compare_strategies(strategies)


@query("sample_preview_count", "SELECT least(1000, count(*)) AS n_rows FROM raw")
def sample_preview_count(spark, sf):
    return R.preview(I.raw_interactions(spark, sf)).agg(F.count(F.lit(1)).alias("n_rows"))


_ALL = ["csv", "csv_gzip", "json_array", "json_lines", "parquet_snappy", "parquet_zstd"]


@query("format_roundtrip_fidelity", f"""
SELECT f.format, c.column_name, 'exact' AS status, CAST(NULL AS DOUBLE) AS max_abs_diff
FROM (VALUES {', '.join(f"('{f}')" for f in _ALL)}) f(format),
     (VALUES {', '.join(f"('{c}')" for c in CURATED_EVENT_COLUMNS)}) c(column_name)
WHERE (SELECT count(*) FROM ev) > 0""")
def format_roundtrip_fidelity(spark, sf):
    """Every column survives every format when the schema is given."""
    df = curate.curated_events(I.daily_events(spark, sf))
    return layout.format_fidelity(df, layout.write_all_formats(df, work_path(spark, "formats")))


@query("format_inferred_fidelity", f"""
SELECT f.format, c.column_name, CASE
    WHEN f.format IN ('csv', 'csv_gzip') AND c.column_name IN ('user_id', 'pid', 'exposed_time', 'p_hour', 'author_fans_count', 'watch_time', 'tag_count')
      OR f.format IN ('json_array', 'json_lines') AND c.column_name = 'p_date' THEN 'type_changed' ELSE 'exact' END AS status,
    CAST(NULL AS DOUBLE) AS max_abs_diff
FROM (VALUES {', '.join(f"('{f}')" for f in _ALL)}) f(format),
     (VALUES {', '.join(f"('{c}')" for c in CURATED_EVENT_COLUMNS)}) c(column_name)
WHERE (SELECT max(exposed_time) FROM ev) < 2147483648""")
def format_inferred_fidelity(spark, sf):
    """The same audit when each reader infers types: text formats change some of them."""
    df = curate.curated_events(I.daily_events(spark, sf))
    return layout.format_fidelity(df, layout.write_all_formats(df, work_path(spark, "formats")), infer=True)


@query("format_sizes", f"""
SELECT f.format, true AS has_files, f.format <> 'json_array' AS below_json_array
FROM (VALUES {', '.join(f"('{f}')" for f in _ALL)}) f(format) WHERE (SELECT count(*) FROM ev) > 0""")
def format_sizes(spark, sf):
    """What holds of the sizes whatever the writer's version: every format has files, none is larger than JSON arrays."""
    df = curate.curated_events(I.daily_events(spark, sf))
    sizes = materialize(layout.format_sizes(spark, layout.write_all_formats(df, work_path(spark, "formats"))), "sizes")
    array = sizes.where("format = 'json_array'").select("bytes").scalar()
    return sizes.select("format", (F.col("files") > 0).alias("has_files"), (F.col("bytes") < array).alias("below_json_array"))


@query("partition_stats_skew", """
SELECT p_date, n AS n_rows, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share_of_rows,
       CAST(max(n) OVER () AS DOUBLE) / CAST(min(n) OVER () AS DOUBLE) AS skew_ratio
FROM (SELECT p_date, count(*) AS n FROM ev GROUP BY 1)""")
def partition_stats_skew(spark, sf):
    root, schema = _curated_root(spark, sf)
    return layout.partition_stats(spark, root, schema).drop("files", "bytes")


@query("partition_stats_bytes", "SELECT p_date, count(*) AS n_rows, true AS has_files, true AS adds_up FROM ev GROUP BY 1")
def partition_stats_bytes(spark, sf):
    """Rows per partition; every partition has files, and their bytes add up to the table's."""
    root, schema = _curated_root(spark, sf)
    total = layout.stored_bytes(spark, root).select("bytes").scalar()
    stats = layout.partition_stats(spark, root, schema)
    whole = stats.agg(F.sum("bytes").alias("b")).select("b").scalar()
    return stats.select("p_date", "n_rows", (F.col("files") > 0).alias("has_files"), (whole == total).alias("adds_up"))


@query("dims_overwrite", "SELECT * FROM dim_users")
def dims_overwrite(spark, sf):
    """A rebuild replaces the whole table: the second write is what is read back."""
    path = work_path(spark, "users")
    W.overwrite_table(I.users(spark, sf), path)
    W.overwrite_table(curate.dim_users(stage.stage_events(I.raw_interactions(spark, sf))), path)
    return spark.read.parquet(path)


@query("report_sink", """
SELECT strftime(p_date, '%Y%m%d') AS p_date, count(*) AS n_events, CAST(sum(watch_time) AS BIGINT) AS watch_seconds
FROM ev GROUP BY 1""")
def report_sink(spark, sf):
    """Statistics as a JSON report per date, written twice: the rerun replaces, it does not append."""
    stats = I.daily_events(spark, sf).groupBy(C.date_to_label("p_date").alias("p_date")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("watch_time").alias("watch_seconds"))
    path = work_path(spark, "report")
    W.write_report(stats, path, ["p_date"])
    W.write_report(stats, path, ["p_date"])
    return spark.read.schema("n_events bigint, watch_seconds bigint, p_date string").json(path)


@query("p_date_labels", """
SELECT o_orderkey, label, regexp_full_match(label, '[0-9]{8}') AS is_valid,
       CASE WHEN regexp_full_match(label, '[0-9]{8}') THEN CAST(strptime(label, '%Y%m%d') AS DATE) END AS p_date,
       CASE WHEN regexp_full_match(label, '[0-9]{8}') THEN strftime(strptime(label, '%Y%m%d'), '%Y-%m-%d') END AS iso
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') || chr(10) ELSE strftime(o_orderdate, '%Y%m%d') END AS label FROM orders)""")
def p_date_labels(spark, sf):
    """Date labels: eight digits and nothing else, not even a line break; then date and ISO text."""
    o = I.table(spark, sf, "orders")
    plain = F.date_format("o_orderdate", "yyyyMMdd")
    label = (F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
             .when(F.col("o_orderstatus") == "F", F.concat(plain, F.lit("\n"))).otherwise(plain))
    ok = C.is_p_date_text("label")
    d = F.when(ok, C.label_to_date(F.when(ok, F.col("label"))))
    return o.select("o_orderkey", label.alias("label")).select(
        "o_orderkey", "label", ok.alias("is_valid"), d.alias("p_date"), F.date_format(d, "yyyy-MM-dd").alias("iso"))


@query("ingest_all_sources", """
SELECT 'interactions' AS source, 'OK' AS status, (SELECT count(*) FROM raw) AS n_rows
UNION ALL SELECT 'categories', 'OK', (SELECT count(*) FROM part_cats)
UNION ALL SELECT 'transcripts', 'MISSING', NULL
UNION ALL SELECT 'rules', 'OK', (SELECT count(*) FROM orders)
UNION ALL SELECT 'holidays', 'ERROR', NULL""")
def ingest_all_sources(spark, sf):
    """One batch over every source kind; two sources are missing and stop nothing."""
    src, raw = work_path(spark, "sources"), work_path(spark, "raw")
    rows = I.landed_raw(spark, sf)
    rows.write.options(**R.CSV_WRITE).csv(f"{src}/interactions")  # what building the rows moved is gone by now
    release(rows)
    lookup = I.raw_part_categories(spark, sf)
    _deliver_lookup(lookup, f"{src}/categories")
    I.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").write.json(f"{src}/rules")
    payload = "o_orderkey bigint, o_orderpriority string"
    ingest.ingest_all(
        spark,
        {"interactions": f"{src}/interactions", "categories": f"{src}/categories", "transcripts": f"{src}/none",
         "payloads": {"rules": f"{src}/rules", "holidays": f"{src}/nothing"}},
        raw, {"rules": payload, "holidays": payload}, multi_line_payloads=False)
    log = R.read_log(spark, f"{raw}/_ingestion_log")
    n = F.coalesce(*[F.get_json_object("detail", f"$.{k}") for k in ("total_rows_read", "rows", "records_retrieved")])
    return log.select("source", "status", n.try_cast("bigint").alias("n_rows"))
