"""Raw to staging: events, category pairs, lookup and transcripts."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from daybrook.functions import columns as C
from daybrook.operators import dedup, events as E
from daybrook.params import DEFAULTS, Params
from daybrook.schemas import EVENT_KEY, TRANSCRIPT_SCHEMA


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def stage_events(raw: DataFrame, params: Params = DEFAULTS, batch_id=None, staged_at=None) -> DataFrame:
    """All dates at once: typed, collapsed, owned by the earliest date, with derived columns."""
    return E.derive(E.collapse_owned(E.type_rows(raw)), params, batch_id, staged_at or utc_now())


def stage_events_after(raw_day: DataFrame, owners: DataFrame, params: Params = DEFAULTS, batch_id=None,
                       staged_at=None) -> DataFrame:
    """One new date against the events owned by earlier dates."""
    collapsed = E.collapse(E.type_rows(raw_day))
    return E.derive(E.not_owned_earlier(collapsed, owners, seen_in=raw_day), params, batch_id, staged_at or utc_now())


def stage_attributes(raw: DataFrame, wanted) -> DataFrame:
    """Key, date and the wanted raw attributes of ``stage_events(raw)``."""
    return E.owned_attributes(E.type_rows(raw, EVENT_KEY + ["p_date"] + E.needed_for(wanted)), wanted)


def stage_category_pairs(raw: DataFrame) -> DataFrame:
    return E.owned_category_pairs(E.type_rows(raw, EVENT_KEY + ["category_id", "p_date"]))


def category_pairs_of(raw_day: DataFrame, owned: DataFrame) -> DataFrame:
    """Pairs of one date, given the events that date owns."""
    seen = E.type_rows(raw_day, EVENT_KEY + ["category_id", "p_date"]).distinct()
    return seen.join(owned.select(*EVENT_KEY), EVENT_KEY, "left_semi").select("pid", "category_id", "p_date").distinct()


def stage_statistics(raw: DataFrame, staged: DataFrame, pairs: DataFrame) -> DataFrame:
    """The nine counters of a staging run, per date, from the raw rows and what was staged from them."""
    rows = dedup.duplicate_stats(raw, ["p_date"]).select(
        C.label_to_date("p_date").alias("p_date"), F.col("n_rows").alias("raw_rows"),
        F.col("exact_duplicate_rows").alias("exact_duplicate_rows_dropped"))
    seen = E.type_rows(raw, EVENT_KEY + ["p_date"]).distinct().groupBy("p_date").agg(
        F.count(F.lit(1)).alias("events_in_partition"))
    events = staged.groupBy("p_date").agg(
        F.count(F.lit(1)).alias("staged_events"),
        C.count_if(F.col("is_rewatch_flagged")).alias("rewatch_flagged_events"),
        C.count_if(F.col("hate")).alias("hate_events"))
    pair_counts = pairs.groupBy("p_date").agg(F.count(F.lit(1)).alias("video_category_pairs"))
    zero = ["staged_events", "rewatch_flagged_events", "hate_events", "video_category_pairs"]
    return (
        rows.join(seen, "p_date", "left").join(events, "p_date", "left").join(pair_counts, "p_date", "left")
        .fillna(0, zero)
        .withColumn("events_owned_by_earlier_partition", F.col("events_in_partition") - F.col("staged_events"))
        .select("p_date", "raw_rows", "exact_duplicate_rows_dropped", "events_in_partition",
                "events_owned_by_earlier_partition", "staged_events", "video_category_pairs",
                "rewatch_flagged_events", "hate_events")
    )


def stage_categories(lookup: DataFrame) -> DataFrame:
    """Trim labels, type ids, flag ids with several rows, keep the first row in file order."""
    typed = lookup.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("category_level", "category_id", "parent_id", "root_id")],
        C.strip("category_name_cn").alias("category_name_cn"),
        C.strip("category_name_en").alias("category_name_en"), "_file_seq")
    row = F.struct("category_level", "category_name_cn", "parent_id", "root_id", "category_name_en")
    return (
        typed.groupBy("category_id")
        .agg(F.min_by(row, "_file_seq").alias("row"), (F.count(F.lit(1)) > 1).alias("en_label_ambiguous"))
        .select("row.category_level", "category_id", "row.category_name_cn", "row.parent_id", "row.root_id",
                "row.category_name_en", "en_label_ambiguous")
    )


def stage_transcripts(files: DataFrame) -> DataFrame:
    """``(file_name, value)`` rows to word counts; names other than digits + ``.txt`` are skipped."""
    # try_cast: the planner may evaluate a join's not-null test before the name filter
    pid = F.regexp_extract("file_name", r"\A([0-9]+)\.txt\z", 1).try_cast("bigint")
    return files.where(pid.isNotNull()).select(
        pid.alias("pid"), F.lit(True).alias("has_transcript"), C.word_count("value").alias("transcript_word_count"))


def no_transcripts(spark) -> DataFrame:
    return spark.createDataFrame([], TRANSCRIPT_SCHEMA)
