"""Source profiles. Counts per (column, value) are built once, distributed, and everything else reads them."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from daybrook.functions import columns as C
from daybrook.operators import compare, dedup, events as E
from daybrook.operators.quantiles import quantiles, quantiles_of_counts
from daybrook.schemas import EVENT_KEY, INT_COLUMNS, RAW_COLUMNS
from daybrook.session import materialize

NUMERIC = INT_COLUMNS + ["duration"]
# low-cardinality columns whose values are listed
LISTED = ["category_level", "cvm_like", "click", "comment", "follow", "collect", "forward", "hate", "gender",
          "fre_community_type", "fre_city_level"]


def _n():
    return F.count(F.lit(1))


def _sum(c):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def text_value_counts(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """``(column_name, value, n)`` of every text column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(_n().alias("n"))


def column_profile(df: DataFrame, columns=RAW_COLUMNS, numeric=NUMERIC) -> DataFrame:
    """Per column: distinct values, missing cells and share, 'unknown' cells; for numeric ones also unparseable
    cells, min, max, mean, median, p90, p99 and the sample standard deviation."""
    counts = materialize(text_value_counts(df, columns), "column-values")
    is_num = F.col("column_name").isin([c for c in numeric if c in columns])
    number = F.when(is_num & C.is_number_text("value"), F.col("value").try_cast("double"))
    base = counts.groupBy("column_name").agg(
        _n().alias("n_distinct"),
        _sum(F.when(C.is_blank("value"), F.col("n"))).alias("missing"),
        F.sum("n").alias("cells"),
        _sum(F.when(F.col("value") == "unknown", F.col("n"))).alias("unknown"),
        F.when(F.first(is_num), _sum(F.when(is_num & ~C.is_number_text("value"), F.col("n")))).alias("non_numeric"))
    hist = counts.select(F.col("column_name").alias("name"), number.alias("value"), "n").where(
        F.col("value").isNotNull()).groupBy("name", "value").agg(F.sum("n").alias("n"))
    hist = materialize(hist, "number-values")
    moments = hist.groupBy("name").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.sum("n").alias("k"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    # one row per column: bounded, whatever the data size
    spread = hist.join(F.broadcast(moments.select("name", "mean", "k")), "name").groupBy("name").agg(
        F.sqrt(F.try_divide(F.sum((F.col("value") - F.col("mean")) ** 2 * F.col("n")), F.max("k") - 1)).alias("std"))
    q = quantiles_of_counts(hist, [0.5, 0.9, 0.99])
    wide = q.groupBy("name").agg(*[
        F.max(F.when(F.col("q") == v, F.col("quantile"))).alias(n) for v, n in ((0.5, "median"), (0.9, "p90"), (0.99, "p99"))])
    numbers = moments.drop("k").join(spread, "name", "left").join(wide, "name", "left")
    return (
        base.join(numbers, base["column_name"] == numbers["name"], "left").drop("name")
        .withColumn("missing_share", C.share("missing", "cells")).drop("cells")
    )


def listed_values(df: DataFrame, columns=LISTED) -> DataFrame:
    """Value counts of the low-cardinality columns."""
    return text_value_counts(df, columns)


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, schema match, exact duplicates, first and last date."""
    cols = [c for c in RAW_COLUMNS if c in df.columns]
    match = sorted(df.columns) == sorted(RAW_COLUMNS)
    dup = dedup.duplicate_stats(df)
    ends = df.agg(F.min("p_date").alias("p_date_min"), F.max("p_date").alias("p_date_max"))
    return dup.select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(match and len(cols) == len(RAW_COLUMNS)).alias("schema_matches"),
        "exact_duplicate_rows", "exact_duplicate_share",
        ends.select("p_date_min").scalar().alias("p_date_min"), ends.select("p_date_max").scalar().alias("p_date_max"))


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy("p_date").agg(_n().alias("n_rows"))


def hours(df: DataFrame) -> DataFrame:
    """Every hour of the day with a flag whether any row has it."""
    seen = df.select(F.col("p_hour").try_cast("int").alias("p_hour")).distinct().withColumn("present", F.lit(True))
    day = df.sparkSession.range(24).select(F.col("id").cast("int").alias("p_hour"))
    return day.join(seen, "p_hour", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def row_flags(df: DataFrame) -> DataFrame:
    """Rows with a line break in the title and rows watched longer than the clip."""
    rewatch = F.col("watch_time").try_cast("double") > F.col("duration").try_cast("double")
    return df.agg(
        _n().alias("n_rows"), C.count_if(F.col("title").contains("\n")).alias("rows_with_newline_in_title"),
        C.count_if(rewatch).alias("rewatch_rows"),
    ).withColumn("rewatch_share", C.share("rewatch_rows", "n_rows"))


def _per_event(df: DataFrame) -> DataFrame:
    keys = E.type_rows(df, EVENT_KEY + ["p_date"])
    return keys.groupBy(*EVENT_KEY, "p_date").agg(_n().alias("n")).groupBy(*EVENT_KEY).agg(
        F.sum("n").alias("n"), _n().alias("dates"))


def rows_per_event(df: DataFrame) -> DataFrame:
    """One row: events, min, median, mean and max rows per event, and how many have 1, 2, 3, 4, 5+ rows."""
    per = _per_event(df)
    buckets = [C.count_if(F.col("n") == k).alias(f"rows_{k}") for k in (1, 2, 3, 4)]
    stats = per.agg(
        _n().alias("unique_events"), F.min("n").alias("min"), F.max("n").alias("max"), F.sum("n").alias("total"),
        *buckets, C.count_if(F.col("n") >= 5).alias("rows_5plus"))
    median = quantiles(per, ["n"], [0.5]).select("quantile").scalar()
    return stats.withColumn("mean", C.share("total", "unique_events")).withColumn("median", median).drop("total")


def multi_partition_events(df: DataFrame) -> DataFrame:
    """Event keys that appear under more than one date."""
    return _per_event(df).where("dates > 1").select(*EVENT_KEY, F.col("dates").alias("n_dates"))


def time_consistency(df: DataFrame, offset_hours=8) -> DataFrame:
    """Agreement of the date label and the hour with UTC and with the given offset."""
    t = F.col("exposed_time").try_cast("bigint")
    d, h = F.to_date("p_date", "yyyyMMdd"), F.col("p_hour").try_cast("int")
    out = df.select(t.alias("t"), d.alias("d"), h.alias("h"))
    return out.agg(
        _n().alias("rows_compared"), F.min("t").alias("exposed_min"), F.max("t").alias("exposed_max"),
        C.count_if(F.col("d") == C.epoch_date("t")).alias("date_equals_utc"),
        C.count_if(F.col("d") == C.epoch_date("t", offset_hours)).alias("date_equals_offset"),
        C.count_if(F.col("h") == C.epoch_hour("t")).alias("hour_equals_utc"),
        C.count_if(F.col("h") == C.epoch_hour("t", offset_hours)).alias("hour_equals_offset"))


def lookup_profile(lookup: DataFrame) -> DataFrame:
    """One row: rows, distinct ids, repeated ids and their rows, blank labels, labels with a leading space."""
    per = lookup.groupBy("category_id").agg(_n().alias("n"))
    ids = per.agg(_n().alias("distinct_ids"), C.count_if(F.col("n") > 1).alias("repeated_ids"),
                  _sum(F.when(F.col("n") > 1, F.col("n"))).alias("rows_with_repeated_id"), F.sum("n").alias("n_rows"))
    blank = C.is_blank("category_name_en")
    labels = lookup.agg(
        C.count_if(blank).alias("blank_labels"),
        C.count_if(~blank & F.col("category_name_en").startswith(" ")).alias("labels_with_leading_space"))
    return ids.select("*", *[labels.select(c).scalar().alias(c) for c in labels.columns])


def level_distribution(lookup: DataFrame) -> DataFrame:
    return lookup.groupBy("category_level").agg(_n().alias("n_rows"))


def transcript_profile(files: DataFrame, pids: DataFrame) -> DataFrame:
    """Transcript files against the videos that occur: sizes, words, empty files, matches and coverage."""
    pid = F.regexp_extract("file_name", r"\A([0-9]+)\.txt\z", 1)
    f = files.select(pid.try_cast("bigint").alias("pid"), F.octet_length("value").cast("bigint").alias("bytes"),
                     C.word_count("value").alias("words"))
    videos = pids.select("pid").distinct()
    stats = f.agg(
        _n().alias("files"), F.min("bytes").alias("bytes_min"), F.max("bytes").alias("bytes_max"),
        F.min("words").alias("words_min"), F.max("words").alias("words_max"),
        C.count_if(F.col("words") == 0).alias("empty_files"),
        C.count_if(F.col("pid").isNull()).alias("non_numeric_names"))
    ids = f.where("pid IS NOT NULL").select("pid").distinct()
    match = ids.join(videos, "pid", "left_semi").agg(_n().alias("n")).select("n").scalar()
    miss = compare.missing_keys(ids, videos, "pid").agg(_n().alias("n")).select("n").scalar()
    total = videos.agg(_n().alias("n")).select("n").scalar()
    return stats.withColumn("matching_a_video", match).withColumn("not_matching", miss).withColumn(
        "distinct_videos", total).withColumn("video_coverage", C.share("matching_a_video", "distinct_videos"))


def transcript_coverage(files: DataFrame, pids: DataFrame) -> DataFrame:
    """Each transcript id with a flag whether a video of that id occurs."""
    pid = F.regexp_extract("file_name", r"\A([0-9]+)\.txt\z", 1)
    ids = files.select(pid.try_cast("bigint").alias("pid")).where("pid IS NOT NULL").distinct()
    return ids.join(pids.select("pid").distinct().withColumn("has_video", F.lit(True)), "pid", "left").withColumn(
        "has_video", F.coalesce("has_video", F.lit(False)))


def findings(raw: DataFrame, lookup: DataFrame, files: DataFrame, pids: DataFrame) -> DataFrame:
    """Issue, count and share of rows. Shares are null where a share of rows makes no sense."""
    flags = row_flags(raw)
    data = dataset_profile(raw)
    per = rows_per_event(raw)
    unknown = raw.agg(*[C.count_if(F.col(c) == "unknown").alias(c) for c in ("fre_community_type", "fre_city_level")])
    look = lookup_profile(lookup)
    n_rows = data.select("n_rows").scalar()

    def issue(name, df, value, share=True):
        v = df.select(value.cast("bigint").alias("n"))
        return v.select(F.lit(name).alias("issue"), "n", (
            F.try_divide(F.col("n").cast("double"), n_rows.cast("double")) if share else F.lit(None).cast("double")).alias("share"))

    rows = [
        issue("exact duplicate rows", data, F.col("exact_duplicate_rows")),
        issue("rows beyond one per event", per, n_rows - F.col("unique_events")),
        issue("events in more than one date", multi_partition_events(raw).agg(_n().alias("n")), F.col("n"), False),
        issue("rows with watch_time greater than duration", flags, F.col("rewatch_rows")),
        issue("titles with a line break", flags, F.col("rows_with_newline_in_title"), False),
        issue("hours of the day with no rows", hours(raw).agg(C.count_if(~F.col("present")).alias("n")), F.col("n"), False),
        issue("fre_community_type unknown", unknown, F.col("fre_community_type")),
        issue("fre_city_level unknown", unknown, F.col("fre_city_level")),
        issue("category ids appearing more than once", look, F.col("repeated_ids"), False),
        issue("blank category labels", look, F.col("blank_labels"), False),
        issue("category labels with a leading space", look, F.col("labels_with_leading_space"), False),
        issue("transcripts without a video", transcript_profile(files, pids), F.col("not_matching"), False),
    ]
    return reduce(DataFrame.unionByName, rows)
