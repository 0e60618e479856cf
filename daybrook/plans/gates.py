"""Quality gates of the three layers. Every gate reports all its dates from one pass per input.

Scalar checks of a layer share one aggregate per date; set checks (keys, references, consistency) are reduced
to distinct keys or per-key minima before they meet anything, so a hot key never becomes one task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybrook.functions import columns as C
from daybrook.operators import checks as K, compare, dedup, events as E
from daybrook.operators.checks import Check
from daybrook.params import DEFAULTS, Params
from daybrook.schemas import (
    ACCEPTED_VALUES, BOOL_COLUMNS, EVENT_KEY, INT_COLUMNS, RAW_COLUMNS, USER_ATTRIBUTES,
)
from daybrook.sources.readers import PART

COLUMNS_AT_A_TIME = 7  # raw columns whose checks are counted by one aggregate


def _n():
    return F.count(F.lit(1))


def _named_counts(prefix, names):
    """``{'a': 3}`` as JSON text of the counters that are not zero."""
    pairs = F.filter(
        F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"{prefix}{n}").alias("v")) for n in names]),
        lambda x: x["v"] > 0)
    return F.to_json(F.map_from_entries(pairs))


def _total(prefix, names):
    return reduce(lambda a, b: a + b, [F.col(f"{prefix}{n}") for n in names])


def _scalar(df, column):
    return df.select(column).scalar()


def accepted_value_violations(raw: DataFrame) -> DataFrame:
    """Values outside the accepted lists with their counts, per date and column."""
    cols = list(ACCEPTED_VALUES)
    bad = F.array_compact(F.array(*[
        F.when(~F.col(c).isin(ACCEPTED_VALUES[c]), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c in cols]))
    return raw.select(PART, F.inline(bad)).groupBy(PART, "column_name", "value").agg(_n().alias("n"))


def top_unexpected_values(raw: DataFrame, k=5) -> DataFrame:
    """The ``k`` most frequent unexpected values per date and column."""
    w = Window.partitionBy(PART, "column_name").orderBy(F.desc("n"), "value")
    return (
        accepted_value_violations(raw).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    )


def _value_lists(raw: DataFrame) -> DataFrame:
    """Per date one JSON text for each checked column: its most frequent unexpected values and their counts."""
    listed = top_unexpected_values(raw).groupBy(PART, "column_name").agg(
        F.to_json(F.map_from_entries(F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "value", "n"))), lambda x: F.struct(x["value"], x["n"])))).alias("text"))
    return listed.groupBy(PART).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("text"))).alias(f"top_{c}") for c in ACCEPTED_VALUES])


def orphan_category_ids(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Category ids of each date that the lookup does not know."""
    ids = raw.select(PART, F.col("category_id").try_cast("bigint").alias("category_id")).distinct()
    known = lookup.select(F.col("category_id").try_cast("bigint").alias("category_id")).distinct()
    return ids.join(known, "category_id", "left_anti")


def first_orphans(raw: DataFrame, lookup: DataFrame, k=10) -> DataFrame:
    """The ``k`` smallest unknown ids over all dates, for the report."""
    return orphan_category_ids(raw, lookup).select("category_id").distinct().orderBy("category_id").limit(k)


def orphans_per_date(raw: DataFrame, lookup: DataFrame, k=10) -> DataFrame:
    """Per date: how many category ids the lookup does not know, and the ``k`` smallest of them."""
    w = Window.partitionBy(PART).orderBy("category_id")
    ranked = orphan_category_ids(raw, lookup).withColumn("rank", F.row_number().over(w))
    return ranked.groupBy(PART).agg(
        _n().alias("orphan_ids"), F.sort_array(F.collect_list(F.when(F.col("rank") <= k, F.col("category_id")))).alias("first_orphans"))


def inconsistent_users(raw: DataFrame) -> DataFrame:
    """Users with more than one combination of attributes inside one date.

    Distinct combinations are a hash aggregate that shrinks map-side; six distinct counts would expand every row.
    """
    seen = raw.select(PART, "user_id", *USER_ATTRIBUTES).distinct()
    return seen.groupBy(PART, "user_id").agg(_n().alias("n")).where("n > 1").select(PART, "user_id")


def _plainly_good(c, params: Params) -> Column:
    """The cell passes every check of its own column, seen without counting. False or null: the checks decide."""
    col = F.col(c)
    if c in INT_COLUMNS:
        good = col.try_cast("bigint").cast("string") == col
    elif c in BOOL_COLUMNS:
        good = C.is_bool_text(c)
    elif c in ACCEPTED_VALUES:
        good = col.isin(ACCEPTED_VALUES[c])
    else:
        good = C.is_number_text(c) if c == "duration" else ~C.is_blank(c)
    ranges = _range_rules(params)
    return good & ~ranges[c][1] if c in ranges else good


def _range_rules(params: Params) -> dict:
    """column -> (name of its range check, out of range)."""
    def num(c):
        return F.col(c).try_cast("bigint")

    return {
        "p_hour": ("p_hour_0_23", (num("p_hour") < 0) | (num("p_hour") > 23)),
        "age": ("age_in_range", (num("age") < params.age_min) | (num("age") > params.age_max)),
        "watch_time": ("watch_time_non_negative", num("watch_time") < 0),
        "duration": ("duration_positive", F.col("duration").try_cast("double") <= 0),
        "mod_price": ("mod_price_non_negative", num("mod_price") < 0),
        "exposed_time": ("exposed_time_positive", num("exposed_time") <= 0),
    }


def _cell_counters(c, params: Params) -> list[Column]:
    """What the checks of one column count. ``miss_`` is 1 if the date lacks the column.

    A landed cell is null only where the row's file had no such column (``readers.read_delivered_csv``).
    """
    out = [F.max(F.col(c).isNull().cast("int")).alias(f"miss_{c}"), C.count_if(C.is_blank(c)).alias(f"blank_{c}")]
    wrong = (~C.is_int_text(c) if c in INT_COLUMNS else ~C.is_bool_text(c) if c in BOOL_COLUMNS
             else ~C.is_number_text(c) if c == "duration" else None)
    if wrong is not None:
        out.append(C.count_if(wrong).alias(f"type_{c}"))
    ranges = _range_rules(params)
    if c in ranges:
        name, cond = ranges[c]
        out.append(C.count_if(cond).alias(name))
    if c in ACCEPTED_VALUES:
        out.append(C.count_if(~F.col(c).isin(ACCEPTED_VALUES[c])).alias(f"{c}_accepted_values"))
    return out


def raw_counters(raw: DataFrame, extra, params: Params = DEFAULTS) -> DataFrame:
    """Per date its rows and the counters of all cell checks, for rows with the 28 columns and ``extra`` ones.

    One aggregate over all columns is a method too long for the JVM to compile. Each takes ``COLUMNS_AT_A_TIME`` columns,
    reads these alone and counts only in rows that have a cell which is not plainly good.
    """
    out = raw.groupBy(PART).agg(
        _n().alias("n_rows"), *[F.max(F.col(c).isNotNull().cast("int")).alias(f"extra_{c}") for c in extra],
        C.count_if(F.col("p_date") != F.col(PART)).alias("off_date"))
    n = -(-len(RAW_COLUMNS) // COLUMNS_AT_A_TIME)
    for columns in (RAW_COLUMNS[i::n] for i in range(n)):
        good = reduce(lambda a, b: a & b, [_plainly_good(c, params) for c in columns])
        counted = raw.where(~F.coalesce(good, F.lit(False))).groupBy(F.col(PART).alias("_part")).agg(
            *[x for c in columns for x in _cell_counters(c, params)])
        out = out.join(counted, F.col(PART).eqNullSafe(F.col("_part")), "left").drop("_part")
    return out.fillna(0)


def _names_of(prefix, names):
    """Sorted names whose counter is set, as ``[a, b]``."""
    set_names = F.array_compact(F.array(*[F.when(F.col(f"{prefix}{n}") > 0, n) for n in sorted(names)])) if names else F.array()
    return F.concat(F.lit("["), F.array_join(set_names.cast("array<string>"), ", "), F.lit("]"))


def raw_gate(raw: DataFrame, lookup: DataFrame, transcripts: DataFrame, params: Params = DEFAULTS, dates=None) -> DataFrame:
    """19 checks per date on text rows as delivered, plus ``part_date``.

    ``dates``: expected values of ``part_date``; one without rows fails ``partition_not_empty``. A date that is empty or
    lacks a column ends after the two checks of its shape, one with blank or untyped cells after the two of its cells.
    """
    extra = [c for c in raw.columns if c not in RAW_COLUMNS and c != PART]
    absent = [c for c in RAW_COLUMNS if c not in raw.columns]
    raw = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])
    ranges = [name for name, _ in _range_rules(params).values()]
    typed = INT_COLUMNS + ["duration"] + BOOL_COLUMNS
    counters = raw_counters(raw, extra, params)
    if dates is not None:
        counters = dates.select(F.col(dates.columns[0]).cast("string").alias(PART)).distinct().join(counters, PART, "left").fillna(0)
    dups = dedup.duplicate_stats(raw.select(*RAW_COLUMNS, PART), [PART]).select(
        PART, "exact_duplicate_rows", "exact_duplicate_share")
    users = inconsistent_users(raw).groupBy(PART).agg(_n().alias("bad_users"))
    repeated = dedup.duplicate_keys(lookup, ["category_id"]).select(F.col("category_id").try_cast("bigint").alias("id"))
    ids = F.slice(F.sort_array(F.collect_list("id")), 1, 10)
    rows = (
        counters.join(dups, PART, "left").join(users, PART, "left").join(orphans_per_date(raw, lookup), PART, "left")
        .join(_value_lists(raw), PART, "left")
        .withColumn("repeated", _scalar(repeated.agg(F.struct(_n().alias("n"), ids.alias("ids")).alias("r")), "r"))
        .withColumn("lookup_repeated", F.col("repeated.n"))
        .withColumn("transcripts", _scalar(transcripts.agg(_n().alias("n")), "n"))
        .fillna(0, ["bad_users", "orphan_ids"])
    )
    missing, surplus = _total("miss_", RAW_COLUMNS), _total("extra_", extra) if extra else F.lit(0)
    blank, bad_type = _total("blank_", RAW_COLUMNS), _total("type_", typed)
    shaped = (missing == 0) & (F.col("n_rows") > 0)
    clean = shaped & (blank == 0) & (bad_type == 0)

    def listed(column):
        return F.coalesce(F.concat(F.lit("["), F.array_join(F.col(column).cast("array<string>"), ", "), F.lit("]")), F.lit("[]"))

    def counted(name, kind, column, text, severity=K.ERROR, passed=None, more=None):
        detail = F.concat(F.col(column).cast("string"), F.lit(text))
        return Check(name, kind, F.col(column), detail if more is None else F.concat(detail, F.lit(": "), more), severity, passed, clean)

    schema_check = Check(
        "schema_columns", "schema", missing + surplus,
        F.when(missing + surplus == 0, F.lit(f"all {len(RAW_COLUMNS)} columns")).otherwise(
            F.concat(F.lit("missing "), _names_of("miss_", RAW_COLUMNS), F.lit(", unknown "), _names_of("extra_", extra))))
    not_empty = Check("partition_not_empty", "row_count", F.when(F.col("n_rows") > 0, 0).otherwise(1),
                      F.concat(F.col("n_rows").cast("string"), F.lit(" rows")))
    specs = [
        schema_check, not_empty,
        Check("required_fields_not_null", "nullability", blank, _named_counts("blank_", RAW_COLUMNS), when=shaped),
        Check("column_datatypes", "datatype", bad_type, _named_counts("type_", typed), when=shaped),
        *[counted(n, "range", n, " rows out of range") for n in ranges],
        *[counted(f"{c}_accepted_values", "accepted_values", f"{c}_accepted_values", " rows, most frequent",
                  more=F.coalesce(f"top_{c}", F.lit("{}"))) for c in ACCEPTED_VALUES],
        counted("p_date_matches_partition", "consistency", "off_date", " rows of another date"),
        counted("user_attributes_consistent", "consistency", "bad_users", " users differ in an attribute"),
        counted("exact_duplicate_share", "duplicates", "exact_duplicate_rows", " copies of rows", K.WARN,
                F.col("exact_duplicate_share") <= params.duplicate_share_warn),
        counted("category_id_in_lookup", "referential_integrity", "orphan_ids", " unknown ids, first", more=listed("first_orphans")),
        counted("category_lookup_unique_ids", "uniqueness", "lookup_repeated", " ids with several rows, first", K.WARN,
                more=listed("repeated.ids")),
        Check("transcript_files_present", "coverage", F.when(F.col("transcripts") > 0, 0).otherwise(1),
              F.concat(F.col("transcripts").cast("string"), F.lit(" files")), when=clean),
    ]
    return K.report(rows, "raw", specs, PART)


def staged_gate(raw: DataFrame, staged: DataFrame, pairs: DataFrame, params: Params = DEFAULTS, owners=None) -> DataFrame:
    """10 checks per date: staging against the raw rows it came from.

    Without ``owners`` the inputs hold every date. With it they hold one date and ``owners`` the event keys of all
    earlier ones. The business rules and the category rule only bind on the first date, where no earlier
    partition can own events.
    """
    typed = E.type_rows(raw.select(*RAW_COLUMNS))
    keys = typed.groupBy(*EVENT_KEY).agg(F.min("p_date").alias("p_date"))
    if owners is None:
        is_first = F.col("p_date") == _scalar(typed.agg(F.min("p_date").alias("d")), "d")
    else:
        keys = E.not_owned_earlier(keys, owners)
        is_first = F.lit(owners.isEmpty())
    expected = keys.groupBy("p_date").agg(_n().alias("expected"))
    unknown = ["fre_community_type", "fre_city_level"]
    # the smallest row's first columns are the smallest first columns: what comes after the last one read need not move
    leading = E.COLLAPSE_ORDER[:1 + max(E.COLLAPSE_ORDER.index(c) for c in ("watch_time", "duration"))]
    first_rows = typed.groupBy(*EVENT_KEY, "p_date").agg(
        F.min(F.struct(*leading)).alias("r"),
        *[F.max((F.col(c) == "unknown").cast("int")).alias(f"u_{c}") for c in unknown])
    raw_side = first_rows.groupBy("p_date").agg(
        C.count_if(F.col("r.watch_time") > F.col("r.duration") * F.lit(params.rewatch_ratio)).alias("raw_rewatch"),
        *[F.sum(f"u_{c}").alias(f"raw_{c}") for c in unknown])
    stg = staged.groupBy("p_date").agg(
        _n().alias("staged"),
        C.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in EVENT_KEY])).alias("null_keys"),
        C.count_if(~(F.col("tag_count") >= 1) | F.col("tag_count").isNull()).alias("low_tags"),
        C.count_if(~(F.col("watch_ratio") >= 0) | F.col("watch_ratio").isNull()).alias("low_ratio"),
        F.max("watch_ratio").alias("max_ratio"),
        C.count_if(F.col("is_rewatch_flagged")).alias("rewatch"),
        *[C.count_if(F.col(c) == "unknown").alias(f"stg_{c}") for c in unknown])
    dup = dedup.duplicate_keys(staged, EVENT_KEY, ["p_date"]).groupBy("p_date").agg(F.sum("surplus").alias("dup_keys"))
    dup_pairs = dedup.duplicate_keys(pairs, ["pid", "category_id"], ["p_date"]).groupBy("p_date").agg(
        F.sum("surplus").alias("dup_pairs"))
    bare = compare.missing_keys(staged, pairs, ["p_date", "pid"]).groupBy("p_date").agg(_n().alias("bare"))
    rows = (
        expected.join(stg, "p_date", "full_outer").join(raw_side, "p_date", "left").join(dup, "p_date", "left")
        .join(dup_pairs, "p_date", "left").join(bare, "p_date", "left")
        .fillna(0).withColumn("is_first", is_first)
        .withColumn("p_date", C.date_to_label("p_date"))
    )
    first = F.col("is_first")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def kept(c):
        r, s = F.col(f"raw_{c}") > 0, F.col(f"stg_{c}") > 0
        return Check(f"{c}_unknown_preserved", "business_rule", F.when(first & (r != s), 1).otherwise(0),
                     text("'unknown' events in staging=", F.col(f"stg_{c}"), " raw=", F.col(f"raw_{c}")))

    specs = [
        Check("event_key_unique", "uniqueness", F.col("dup_keys"), text(F.col("dup_keys"), " duplicate keys")),
        Check("event_count_reconciles_to_raw", "reconciliation", F.abs(F.col("staged") - F.col("expected")),
              text("staged=", F.col("staged"), " expected_from_raw=", F.col("expected"))),
        Check("key_columns_not_null", "nullability", F.col("null_keys"), text(F.col("null_keys"), " null keys")),
        Check("tag_count_positive", "range", F.col("low_tags"), text(F.col("low_tags"), " events without a tag")),
        Check("watch_ratio_non_negative", "range", F.col("low_ratio"), text(F.col("low_ratio"), " bad ratios")),
        Check("rewatch_retained_and_flagged", "business_rule",
              F.when(first, F.abs(F.col("rewatch") - F.col("raw_rewatch"))).otherwise(0),
              text("flagged=", F.col("rewatch"), " max ratio ", F.round("max_ratio", 1))),
        *[kept(c) for c in unknown],
        Check("video_category_pairs_unique", "uniqueness", F.col("dup_pairs"), text(F.col("dup_pairs"), " duplicates")),
        Check("staged_events_have_categories", "referential_integrity", F.when(first, F.col("bare")).otherwise(0),
              text(F.col("bare"), " videos without a category row")),
    ]
    return K.report(rows, "staged", specs)


def curated_gate(events: DataFrame, features: DataFrame, users: DataFrame, videos: DataFrame, categories: DataFrame,
                 bridge: DataFrame, staged: DataFrame) -> DataFrame:
    """11 checks per date on the curated tables."""
    ft = features.withColumnRenamed("feature_date", "p_date")

    def outside(c):
        return C.count_if((F.col(c) < 0) | (F.col(c) > 1))

    f = ft.groupBy("p_date").agg(
        _n().alias("n_features"), F.sum("n_events").alias("sum_events"),
        *[outside(c).alias(f"out_{c}") for c in ("late_night_share", "hate_rate", "rewatch_rate")],
        C.count_if(F.col("hate_events") > F.col("n_events")).alias("hate_over"),
        C.count_if(~((F.col("n_sessions") >= 1) & (
            F.col("max_session_seconds") >= F.col("avg_session_seconds") - 1e-9))).alias("bad_sessions"))
    e = events.groupBy("p_date").agg(_n().alias("curated"))
    s = staged.groupBy("p_date").agg(_n().alias("staged"))
    dup = dedup.duplicate_keys(ft, ["user_id", "p_date"]).groupBy("p_date").agg(F.sum("surplus").alias("dup"))

    def per_date_missing(df, dim, key, name):
        ids = df.select("p_date", key).distinct()
        return ids.join(dim.select(key).distinct(), key, "left_anti").groupBy("p_date").agg(_n().alias(name))

    rows = f.join(e, "p_date", "full_outer").join(s, "p_date", "full_outer").join(dup, "p_date", "left")
    for part in (per_date_missing(ft, users, "user_id", "ft_users"), per_date_missing(events, users, "user_id", "ev_users"),
                 per_date_missing(events, videos, "pid", "ev_videos")):
        rows = rows.join(part, "p_date", "left")
    no_cat = compare.missing_keys(bridge, categories, "category_id").agg(_n().alias("n"))
    no_vid = compare.missing_keys(bridge, videos, "pid").agg(_n().alias("n"))
    words, has = F.col("transcript_word_count"), F.col("has_transcript")
    tr = videos.agg(C.count_if(
        (~has & words.isNotNull()) | (has & ~F.coalesce(words >= 0, F.lit(False)))).alias("n"))
    rows = (
        rows.fillna(0).withColumn("bridge_orphans", _scalar(no_cat, "n") + _scalar(no_vid, "n"))
        .withColumn("bad_transcripts", _scalar(tr, "n")).withColumn("p_date", C.date_to_label("p_date"))
    )

    def counted(name, kind, col, text):
        return Check(name, kind, col, F.concat(col.cast("string"), F.lit(text)))

    totals = F.greatest("sum_events", "curated", "staged") - F.least("sum_events", "curated", "staged")
    specs = [
        counted("features_pk_unique", "uniqueness", F.col("dup"), " duplicate feature rows"),
        *[counted(f"{c}_within_0_1", "range", F.col(f"out_{c}"), " values outside [0, 1]")
          for c in ("late_night_share", "hate_rate", "rewatch_rate")],
        counted("hate_events_le_events", "business_rule", F.col("hate_over"), " rows with more hates than events"),
        counted("sessions_consistent", "business_rule", F.col("bad_sessions"), " rows with inconsistent sessions"),
        Check("feature_event_totals_reconcile", "reconciliation", totals, F.concat_ws(
            " ", F.concat(F.lit("sum(n_events)="), F.col("sum_events")), F.concat(F.lit("curated="), F.col("curated")),
            F.concat(F.lit("staged="), F.col("staged")))),
        counted("features_users_exist", "referential_integrity", F.col("ft_users"), " unknown users"),
        counted("events_users_videos_exist", "referential_integrity", F.col("ev_users") + F.col("ev_videos"),
                " unknown users or videos"),
        counted("video_categories_exist", "referential_integrity", F.col("bridge_orphans"), " orphans"),
        counted("transcript_fields_consistent", "business_rule", F.col("bad_transcripts"), " inconsistent videos"),
    ]
    return K.report(rows, "curated", specs)
