"""From typed tag-level rows to one owned row per event.

Ownership: an event belongs to the earliest date partition it appears in. Collapse: the whole first row by
(p_hour, title, remaining columns) survives, together with the number of distinct tags.

Exact copies never change the result of the collapse (minimum row, distinct tags, distinct pairs), so staging
does not pay for a 28-column distinct; only the duplicate statistics do.

A single event may own a large share of the rows. The collapse is a plain aggregate and combines map-side; after
it an event has at most one row per date partition, and only those rows meet in the ownership window.
"""

from pyspark.sql import DataFrame, Window, functions as F

from daybrook.functions import columns as C
from daybrook.params import DEFAULTS, Params
from daybrook.schemas import BOOL_COLUMNS, EVENT_ATTRIBUTES, EVENT_KEY, INT_COLUMNS, RAW_COLUMNS

# (p_hour, title) decide which row survives; the rest makes ties deterministic
COLLAPSE_ORDER = ["p_hour", "title"] + [c for c in EVENT_ATTRIBUTES if c not in ("p_hour", "title")]


def type_rows(raw: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """Text rows to typed rows. Runs after the raw gate, so every cast is expected to succeed."""
    out = []
    for c in columns:
        if c in INT_COLUMNS:
            out.append(F.col(c).cast("bigint").alias(c))
        elif c == "duration":
            out.append(F.col(c).cast("double").alias(c))
        elif c in BOOL_COLUMNS:
            out.append(C.bool_from_text(c).alias(c))
        elif c == "p_date":
            out.append(C.label_to_date(c).alias(c))
        else:
            out.append(F.col(c))
    return raw.select(*out)


def collapse(typed: DataFrame) -> DataFrame:
    """One row per (event key, p_date): the first whole row and ``tag_count``.

    The wide row and the tag count are two aggregates over the same keys. Wide rows are shuffled once, already
    reduced map-side to one per event; only (key, date, tag) is shuffled for the distinct count. Both sides end up
    hashed and sorted by the same keys, so joining them needs no further exchange.
    """
    keys = EVENT_KEY + ["p_date"]
    first = typed.groupBy(*keys).agg(F.min(F.struct(*COLLAPSE_ORDER)).alias("row"))
    tags = typed.groupBy(*keys).agg(F.countDistinct("tag_name").alias("tag_count"))
    return first.join(tags, keys).select(*keys, "row.*", "tag_count")


def collapse_owned(typed: DataFrame) -> DataFrame:
    """``keep_earliest_date(collapse(typed))`` where nothing needs the rows of the other dates.

    With the date in front of the order one aggregate finds an event's owner and its first row there, so wide rows are shuffled
    once, combined, and meet no window. Tags are counted by date as in ``collapse``; only the owner's count goes on.
    """
    keys = EVENT_KEY + ["p_date"]
    rows = typed.na.drop(subset=keys)
    first = rows.groupBy(*EVENT_KEY).agg(F.min(F.struct("p_date", *COLLAPSE_ORDER)).alias("row"))
    counts = rows.groupBy(*keys).agg(F.countDistinct("tag_name").alias("tag_count"))
    tags = counts.groupBy(*EVENT_KEY).agg(F.min_by("tag_count", "p_date").alias("tag_count"))
    return first.join(tags, EVENT_KEY).select(*EVENT_KEY, "row.*", "tag_count")


def needed_for(wanted) -> list:
    """The attributes that decide what a first row holds in the wanted columns: the order up to the last of them."""
    return COLLAPSE_ORDER[:1 + max(COLLAPSE_ORDER.index(c) for c in wanted)]


def owned_attributes(typed: DataFrame, wanted) -> DataFrame:
    """The wanted columns of ``keep_earliest_date(collapse(typed))``, for readers that need no others.

    Columns behind the last wanted one in the order are neither compared nor moved. With the date in front of the order one
    aggregate finds an event's owner and its first row there.
    """
    keys = EVENT_KEY + ["p_date"]
    first = typed.na.drop(subset=keys).groupBy(*EVENT_KEY).agg(F.min(F.struct("p_date", *needed_for(wanted))).alias("row"))
    return first.select(*EVENT_KEY, "row.p_date", *[F.col(f"row.{c}") for c in wanted])


def keep_earliest_date(rows: DataFrame, key=EVENT_KEY, date="p_date") -> DataFrame:
    """Keep each key under its earliest date. Input: at most one row per key and date."""
    w = Window.partitionBy(*key).orderBy(date)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def not_owned_earlier(rows: DataFrame, owners: DataFrame, key=EVENT_KEY, seen_in=None) -> DataFrame:
    """Incremental ownership: drop events whose key an earlier partition already owns.

    ``owners`` is the compact (key, p_date) table of earlier dates. Only owners inside the exposure range of the
    new rows can match; the range is one small aggregate over ``seen_in`` (the cheapest table that holds the new
    exposure times, ``rows`` itself by default) and limits the owner scan.
    """
    source = rows if seen_in is None else seen_in
    t = F.col("exposed_time").cast("bigint")
    span = source.agg(F.struct(F.min(t).alias("lo"), F.max(t).alias("hi")).alias("span")).scalar()
    near = owners.where(F.col("exposed_time").between(span["lo"], span["hi"])).select(*key).distinct()
    return rows.join(near, list(key), "left_anti")


def owned_category_pairs(typed: DataFrame) -> DataFrame:
    """Distinct (p_date, pid, category_id) of the events owned by that date.

    A semi join with one row per event, not a window per event: an event with very many categories is split by
    the adaptive skew join instead of being ordered in one task.
    """
    seen = typed.select(*EVENT_KEY, "p_date", "category_id").distinct()
    owners = typed.groupBy(*EVENT_KEY).agg(F.min("p_date").alias("p_date"))
    return seen.join(owners, EVENT_KEY + ["p_date"], "left_semi").select("p_date", "pid", "category_id").distinct()


def derive(events: DataFrame, params: Params = DEFAULTS, batch_id=None, staged_at=None) -> DataFrame:
    """Watch ratio, rewatch flag and the lineage columns."""
    return (
        events.withColumn("watch_ratio", C.watch_ratio())
        .withColumn("is_rewatch_flagged", C.is_rewatch(params))
        .withColumn("ingest_batch_id", F.lit(batch_id).cast("string"))
        .withColumn("staged_at", F.lit(staged_at).cast("string"))
    )
