"""Gates and constraints over the driver's tables, on clean and on spoiled input."""

from pyspark.sql import functions as F

from daybrook.catalog import inputs as I
from daybrook.catalog.entry import ORACLES, query
from daybrook.operators import checks as K, compare
from daybrook.plans import constraints, curate, gates, ingest, stage
from daybrook.schemas import (
    ACCEPTED_VALUES, BOOL_COLUMNS, CURATED_EVENT_COLUMNS, FEATURE_COLUMNS, INT_COLUMNS, RAW_COLUMNS,
    USER_ATTRIBUTES, USER_COLUMNS, VIDEO_COLUMNS,
)
from daybrook.session import materialize, release, work_path
from daybrook.sources import readers as R, sinks as W
from daybrook.sources.readers import PART

_REPORT = ["stage", "p_date", "name", "check_type", "severity", "passed", "violations"]


# ---- raw ------------------------------------------------------------------------------------

def _sql_raw_gate(rows, key, lookup, transcripts="transcripts"):
    """DuckDB statement of the raw gate; ``rows`` is a named sub-query with the 28 columns and ``key`` the date."""
    cnt = {f"{c}": f"CASE WHEN trim({c}, ' \t\n') = '' THEN 1 ELSE 0 END" for c in [f'"{x}"' for x in RAW_COLUMNS]}
    blank = " + ".join(cnt.values())
    bad = [f"CASE WHEN regexp_full_match({c}, '-?[0-9]+') THEN 0 ELSE 1 END" for c in INT_COLUMNS]
    bad.append("CASE WHEN try_cast(duration AS DOUBLE) IS NULL THEN 1 ELSE 0 END")
    bad += [f"""CASE WHEN "{c}" IN ('True','False') THEN 0 ELSE 1 END""" for c in BOOL_COLUMNS]
    bad = " + ".join(bad)

    def n(c):
        return f"try_cast({c} AS BIGINT)"

    ranges = {
        "p_hour_0_23": f"{n('p_hour')} < 0 OR {n('p_hour')} > 23",
        "age_in_range": f"{n('age')} < -1 OR {n('age')} > 200",
        "watch_time_non_negative": f"{n('watch_time')} < 0",
        "duration_positive": "try_cast(duration AS DOUBLE) <= 0",
        "mod_price_non_negative": f"{n('mod_price')} < 0",
        "exposed_time_positive": f"{n('exposed_time')} <= 0",
    }
    out = [f"SELECT {key} AS d, 'schema_columns' AS name, 'schema' AS check_type, 'ERROR' AS severity, 0 AS v, "
           f"NULL AS ok, true AS always FROM {rows} GROUP BY 1",
           f"SELECT {key}, 'partition_not_empty', 'row_count', 'ERROR', 0, NULL, true FROM {rows} GROUP BY 1",
           f"SELECT {key}, 'required_fields_not_null', 'nullability', 'ERROR', sum({blank}), NULL, true FROM {rows} GROUP BY 1",
           f"SELECT {key}, 'column_datatypes', 'datatype', 'ERROR', sum({bad}), NULL, true FROM {rows} GROUP BY 1"]
    for name, cond in ranges.items():
        out.append(f"SELECT {key}, '{name}', 'range', 'ERROR', count(*) FILTER (WHERE {cond}), NULL, false FROM {rows} GROUP BY 1")
    for c, ok in ACCEPTED_VALUES.items():
        allowed = ",".join(f"'{v}'" for v in ok)
        out.append(f"SELECT {key}, '{c}_accepted_values', 'accepted_values', 'ERROR', "
                   f"count(*) FILTER (WHERE {c} NOT IN ({allowed})), NULL, false FROM {rows} GROUP BY 1")
    out.append(f"SELECT {key}, 'p_date_matches_partition', 'consistency', 'ERROR', "
               f"count(*) FILTER (WHERE p_date <> {key}), NULL, false FROM {rows} GROUP BY 1")
    differs = " OR ".join(f"count(DISTINCT {c}) > 1" for c in USER_ATTRIBUTES)
    out.append(f"SELECT d, 'user_attributes_consistent', 'consistency', 'ERROR', count(*) FILTER (WHERE bad), NULL, false "
               f"FROM (SELECT {key} AS d, user_id, {differs} AS bad FROM {rows} GROUP BY 1, 2) GROUP BY 1")
    out.append(f"SELECT d, 'exact_duplicate_share', 'duplicates', 'WARN', sum(n - 1), sum(n - 1) / sum(n) <= 0.30, false "
               f"FROM (SELECT {key} AS d, *, count(*) AS n FROM {rows} GROUP BY ALL) GROUP BY 1")
    out.append(f"SELECT d, 'category_id_in_lookup', 'referential_integrity', 'ERROR', count(DISTINCT c) FILTER (WHERE NOT known), NULL, false "
               f"FROM (SELECT {key} AS d, category_id AS c, category_id IN (SELECT category_id FROM {lookup}) AS known "
               f"FROM {rows}) GROUP BY 1")
    out.append(f"SELECT {key}, 'category_lookup_unique_ids', 'uniqueness', 'WARN', (SELECT count(*) FROM (SELECT category_id "
               f"FROM {lookup} GROUP BY 1 HAVING count(*) > 1)), NULL, false FROM {rows} GROUP BY 1")
    out.append(f"SELECT {key}, 'transcript_files_present', 'coverage', 'ERROR', CASE WHEN (SELECT count(*) FROM {transcripts}) > 0 "
               f"THEN 0 ELSE 1 END, NULL, false FROM {rows} GROUP BY 1")
    union = "\nUNION ALL ".join(out)
    return f"""
SELECT 'raw' AS stage, g.d AS p_date, name, check_type, severity, coalesce(ok, v = 0) AS passed, CAST(v AS BIGINT) AS violations
FROM ({union}) g JOIN (SELECT {key} AS d, sum({blank}) + sum({bad}) AS dirty FROM {rows} GROUP BY 1) s ON g.d = s.d
WHERE always OR dirty = 0"""


_NO_TRANSCRIPTS = "(SELECT * FROM transcripts WHERE false)"


def _raw_gate(spark, sf, raw, transcripts=None):
    files = I.transcripts(spark, sf) if transcripts is None else transcripts
    return gates.raw_gate(raw, I.raw_categories(spark, sf), files).select(*_REPORT)


@query("gate_raw", _sql_raw_gate("raw", "p_date", "cats"))
def gate_raw(spark, sf):
    return _raw_gate(spark, sf, I.landed_raw(spark, sf).withColumn(PART, F.col("p_date")))


@query("gate_raw_defects", _sql_raw_gate("defects", "part_date", "cats", _NO_TRANSCRIPTS))
def gate_raw_defects(spark, sf):
    """Spoiled rows, and no transcript landed."""
    return _raw_gate(spark, sf, materialize(I.raw_with_defects(spark, sf), "raw"), I.transcripts(spark, sf).where("false"))


_DATES = "(SELECT DISTINCT p_date FROM raw UNION SELECT '19990101')"


@query("gate_raw_schema", f"""
SELECT p_date, 'schema_columns' AS name, CAST(p_date IN ('19960101', '19970101') AS BIGINT) AS violations,
       CASE p_date WHEN '19960101' THEN 'missing [hate], unknown []' WHEN '19970101' THEN 'missing [], unknown [surprise]'
       ELSE 'all 28 columns' END AS detail FROM {_DATES} d
UNION ALL SELECT p_date, 'partition_not_empty', CAST(p_date = '19990101' AS BIGINT), CASE p_date WHEN '19990101' THEN '0'
       ELSE CAST((SELECT count(*) FROM raw r WHERE r.p_date = d.p_date) AS VARCHAR) END || ' rows' FROM {_DATES} d
UNION ALL SELECT p_date, name, 0, '{{}}' FROM {_DATES} d, (SELECT unnest(['required_fields_not_null', 'column_datatypes']) AS name)
WHERE p_date NOT IN ('19960101', '19990101')""")
def gate_raw_schema(spark, sf):
    """Files with a missing, an extra and reordered columns, and a date without rows, from delivered CSV to the gate."""
    raw, root = I.landed_raw(spark, sf), work_path(spark, "delivered")
    year = F.substring("p_date", 1, 4)
    shapes = {
        "plain": raw.where(~year.isin("1996", "1997", "1998", "1999")),
        "missing": raw.where(year == "1996").drop("hate"),
        "extra": raw.where(year == "1997").withColumn("surprise", F.lit("x")),
        "reordered": raw.where(year == "1998").select(*reversed(RAW_COLUMNS)),
    }
    for name, rows in shapes.items():
        rows.write.options(**R.CSV_WRITE).csv(f"{root}/source/{name}")
    none = spark.createDataFrame([], raw.schema)
    release(raw)
    landed = f"{root}/raw"
    ingest.land_interactions(spark, f"{root}/source/*/*.csv", landed)
    W.replace_partition(none.withColumn(PART, F.col("p_date")), landed, PART, "19990101")
    rep = gates.raw_gate(R.read_raw_as_delivered(spark, landed), I.raw_categories(spark, sf), I.transcripts(spark, sf),
                         dates=R.partition_dates_df(spark, landed))
    return rep.where("seq <= 4").select("p_date", "name", "violations", "detail")


@query("unexpected_values_top5", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part_date, column_name ORDER BY n DESC, value) AS rank FROM (
  SELECT part_date, 'gender' AS column_name, gender AS value, count(*) AS n FROM defects
  WHERE gender NOT IN ('M','F') GROUP BY ALL
  UNION ALL SELECT part_date, 'fre_community_type', fre_community_type, count(*) FROM defects
  WHERE fre_community_type NOT IN ('乡村','镇区','城区','unknown') GROUP BY ALL
  UNION ALL SELECT part_date, 'fre_city_level', fre_city_level, count(*) FROM defects
  WHERE fre_city_level NOT IN ('一线城市','新一线城市','二线城市','三线城市','四线城市','五线城市','unknown') GROUP BY ALL))
WHERE rank <= 5""")
def unexpected_values_top5(spark, sf):
    return gates.top_unexpected_values(I.raw_with_defects(spark, sf))


@query("orphan_ids_first10", """
SELECT DISTINCT CAST(l_partkey AS BIGINT) AS category_id FROM lineitem
WHERE l_partkey NOT IN (SELECT n_nationkey FROM nation) ORDER BY 1 LIMIT 10""")
def orphan_ids_first10(spark, sf):
    """Part numbers used as category ids against the 25-id lookup: the ten smallest unknown ones."""
    rows = I.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("category_id"), F.date_format("l_shipdate", "yyyyMMdd").alias(PART))
    return gates.first_orphans(rows, I.raw_categories(spark, sf))


@query("users_inconsistent", f"""
SELECT part_date, user_id FROM defects GROUP BY 1, 2
HAVING {" OR ".join(f"count(DISTINCT {c}) > 1" for c in USER_ATTRIBUTES)}""")
def users_inconsistent(spark, sf):
    return gates.inconsistent_users(I.raw_with_defects(spark, sf))


# ---- staged ---------------------------------------------------------------------------------

_SPOILED_STAGED = """
SELECT * REPLACE (CASE WHEN p_date = DATE '1995-01-01' THEN is_rewatch_flagged AND NOT click ELSE is_rewatch_flagged END AS is_rewatch_flagged,
                  CASE WHEN p_date = DATE '1995-01-01' AND fre_city_level = 'unknown' THEN '五线城市' ELSE fre_city_level END AS fre_city_level,
                  CASE WHEN p_date = DATE '1995-01-01' AND fre_community_type = 'unknown' THEN '镇区' ELSE fre_community_type END AS fre_community_type,
                  CASE WHEN p_date = DATE '1999-01-01' AND hate THEN NULL ELSE pid END AS pid,
                  CASE WHEN p_date = DATE '1996-01-01' AND click THEN 0 ELSE tag_count END AS tag_count,
                  CASE WHEN p_date = DATE '1996-01-01' AND hate THEN -1.0 ELSE watch_ratio END AS watch_ratio)
FROM staged WHERE NOT (p_date = DATE '1997-01-01' AND follow)
UNION ALL SELECT * FROM staged WHERE p_date = DATE '1998-01-01' AND hate"""


def spoil_staged(staged):
    d, day = F.col("p_date"), (lambda y: F.lit(f"{y}-01-01").cast("date"))
    kept = (
        staged.where(~((d == day(1997)) & F.col("follow")))
        .withColumn("is_rewatch_flagged", F.when(d == day(1995), F.col("is_rewatch_flagged") & ~F.col("click"))
                    .otherwise(F.col("is_rewatch_flagged")))
        .withColumn("fre_city_level", F.when((d == day(1995)) & (F.col("fre_city_level") == "unknown"), "五线城市")
                    .otherwise(F.col("fre_city_level")))
        .withColumn("fre_community_type", F.when((d == day(1995)) & (F.col("fre_community_type") == "unknown"), "镇区")
                    .otherwise(F.col("fre_community_type")))
        .withColumn("pid", F.when(~((d == day(1999)) & F.col("hate")), F.col("pid")))
        .withColumn("tag_count", F.when((d == day(1996)) & F.col("click"), 0).otherwise(F.col("tag_count")))
        .withColumn("watch_ratio", F.when((d == day(1996)) & F.col("hate"), -1.0).otherwise(F.col("watch_ratio")))
    )
    return kept.unionByName(staged.where((d == day(1998)) & F.col("hate")))


def _stored_layers(spark, sf):
    """Raw, staged events and pairs as the gate finds them: stored."""
    raw = I.landed_raw(spark, sf)
    return (raw, materialize(stage.stage_events(raw).drop("staged_at"), "staged"),
            materialize(stage.stage_category_pairs(raw), "pairs"))


def _sql_staged_gate(staged, pairs):
    first = "p_date = (SELECT min(p_date) FROM typed)"

    def group(name, kind, expr, src):
        return f"SELECT p_date, '{name}' AS name, '{kind}' AS check_type, {expr} AS v FROM ({src}) GROUP BY p_date"

    dup = f"SELECT p_date, user_id, pid, exposed_time, count(*) AS n FROM {staged} GROUP BY ALL"
    dup_pairs = f"SELECT p_date, pid, category_id, count(*) AS n FROM {pairs} GROUP BY ALL"
    expected = "SELECT CAST(strptime(owner, '%Y%m%d') AS DATE) AS p_date, count(*) AS n FROM (SELECT DISTINCT user_id, pid, exposed_time, owner FROM typed) GROUP BY 1"
    first_rows = """SELECT p_date, watch_time, duration FROM (SELECT *, row_number() OVER (PARTITION BY user_id, pid, exposed_time, p_date
      ORDER BY p_hour, title, author_id, author_fans_count, watch_time, duration, cvm_like, click, comment, follow, "collect", forward,
      hate, gender, age, mod_price, fre_city, fre_community_type, fre_city_level) AS rn FROM typed) WHERE rn = 1"""

    def unknown(c):
        return (f"SELECT p_date, '{c}_unknown_preserved', 'business_rule', CASE WHEN {first} AND "
                f"((SELECT count(*) FROM typed t WHERE t.p_date = s.p_date AND {c} = 'unknown') > 0) <> (count(*) FILTER (WHERE {c} = 'unknown') > 0) "
                f"THEN 1 ELSE 0 END FROM {staged} s GROUP BY p_date")

    out = [
        group("event_key_unique", "uniqueness", "sum(n - 1)", dup),
        f"SELECT e.p_date, 'event_count_reconciles_to_raw', 'reconciliation', abs(e.n - coalesce(s.n, 0)) FROM ({expected}) e "
        f"LEFT JOIN (SELECT p_date, count(*) AS n FROM {staged} GROUP BY 1) s ON e.p_date = s.p_date",
        group("key_columns_not_null", "nullability", "count(*) FILTER (WHERE user_id IS NULL OR pid IS NULL OR exposed_time IS NULL)", f"SELECT * FROM {staged}"),
        group("tag_count_positive", "range", "count(*) FILTER (WHERE tag_count < 1)", f"SELECT * FROM {staged}"),
        group("watch_ratio_non_negative", "range", "count(*) FILTER (WHERE watch_ratio < 0)", f"SELECT * FROM {staged}"),
        f"SELECT p_date, 'rewatch_retained_and_flagged', 'business_rule', CASE WHEN {first} THEN abs(count(*) FILTER (WHERE is_rewatch_flagged) - "
        f"(SELECT count(*) FROM ({first_rows}) r WHERE r.p_date = s.p_date AND r.watch_time > r.duration)) ELSE 0 END FROM {staged} s GROUP BY p_date",
        unknown("fre_community_type"), unknown("fre_city_level"),
        group("video_category_pairs_unique", "uniqueness", "sum(n - 1)", dup_pairs),
        f"SELECT p_date, 'staged_events_have_categories', 'referential_integrity', CASE WHEN {first} THEN count(DISTINCT pid) FILTER (WHERE pid NOT IN "
        f"(SELECT pid FROM {pairs} p WHERE p.p_date = (SELECT min(p_date) FROM typed))) ELSE 0 END FROM {staged} s GROUP BY p_date",
    ]
    return f"""
SELECT 'staged' AS stage, strftime(p_date, '%Y%m%d') AS p_date, name, check_type, 'ERROR' AS severity, v = 0 AS passed, CAST(v AS BIGINT) AS violations
FROM ({" UNION ALL ".join(out)})"""


@query("gate_staged", _sql_staged_gate("staged", "pairs"))
def gate_staged(spark, sf):
    raw, staged, pairs = _stored_layers(spark, sf)
    return gates.staged_gate(raw, staged, pairs).select(*_REPORT)


def _with_spoiled(sql):
    return sql.replace("\nSELECT 'staged' AS stage", f"\n, spoiled AS MATERIALIZED ({_SPOILED_STAGED}), "
                       "spoiled_pairs AS MATERIALIZED (SELECT * FROM pairs WHERE NOT (p_date = DATE '1995-01-01' AND category_id = 3) "
                       "UNION ALL SELECT * FROM pairs WHERE category_id = 5)\nSELECT 'staged' AS stage", 1)


@query("gate_staged_defects", _sql_staged_gate("spoiled", "spoiled_pairs") + " -- staged pairs")
def gate_staged_defects(spark, sf):
    raw, staged, pairs = _stored_layers(spark, sf)
    lost = (F.col("p_date") == F.lit("1995-01-01").cast("date")) & (F.col("category_id") == 3)
    spoiled_pairs = pairs.where(~lost).unionByName(pairs.where("category_id = 5"))
    return gates.staged_gate(raw, spoil_staged(staged), spoiled_pairs).select(*_REPORT)


ORACLES["gate_staged_defects"] = _with_spoiled(ORACLES["gate_staged_defects"])


# ---- curated --------------------------------------------------------------------------------

_EV_VIDEOS = """(SELECT v.*, t.pid IS NOT NULL AS has_transcript, t.transcript_word_count FROM (
  SELECT pid, author_id, title, duration FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY title, author_id, duration) AS rn FROM ev)
  WHERE rn = 1) v LEFT JOIN dim_transcripts t ON v.pid = t.pid)"""


def _sql_curated_gate(feat, users, ev="ev", staged="ev", videos=_EV_VIDEOS, cats="(SELECT n_nationkey AS category_id FROM nation)"):
    def f(name, kind, expr):
        return f"SELECT feature_date AS d, '{name}' AS name, '{kind}' AS check_type, {expr} AS v FROM {feat} GROUP BY 1"

    def g(name, kind, expr):
        return f"SELECT d, '{name}', '{kind}', {expr} FROM dates"

    out = [
        f"SELECT d, 'features_pk_unique' AS name, 'uniqueness' AS check_type, sum(n - 1) AS v FROM (SELECT feature_date AS d, user_id, count(*) AS n FROM {feat} GROUP BY ALL) GROUP BY 1",
        *[f(f"{c}_within_0_1", "range", f"count(*) FILTER (WHERE {c} < 0 OR {c} > 1)") for c in ("late_night_share", "hate_rate", "rewatch_rate")],
        f("hate_events_le_events", "business_rule", "count(*) FILTER (WHERE hate_events > n_events)"),
        f("sessions_consistent", "business_rule", "count(*) FILTER (WHERE n_sessions < 1 OR max_session_seconds < avg_session_seconds - 1e-9)"),
        f"SELECT a.d, 'feature_event_totals_reconcile', 'reconciliation', greatest(a.n, b.n, c.n) - least(a.n, b.n, c.n) "
        f"FROM (SELECT feature_date AS d, sum(n_events) AS n FROM {feat} GROUP BY 1) a JOIN (SELECT p_date AS d, count(*) AS n FROM {ev} GROUP BY 1) b ON a.d = b.d "
        f"JOIN (SELECT p_date AS d, count(*) AS n FROM {staged} GROUP BY 1) c ON a.d = c.d",
        f("features_users_exist", "referential_integrity", f"count(DISTINCT user_id) FILTER (WHERE user_id NOT IN (SELECT user_id FROM {users}))"),
        f"SELECT p_date, 'events_users_videos_exist', 'referential_integrity', count(DISTINCT user_id) FILTER (WHERE user_id NOT IN (SELECT user_id FROM {users})) "
        f"+ count(DISTINCT pid) FILTER (WHERE pid NOT IN (SELECT pid FROM {videos})) FROM {ev} GROUP BY 1",
        g("video_categories_exist", "referential_integrity", f"(SELECT count(DISTINCT category_id) FROM bridge WHERE category_id NOT IN (SELECT category_id FROM {cats})) "
          f"+ (SELECT count(DISTINCT pid) FROM bridge WHERE pid NOT IN (SELECT pid FROM {videos}))"),
        g("transcript_fields_consistent", "business_rule", f"(SELECT count(*) FROM {videos} WHERE (NOT has_transcript AND transcript_word_count IS NOT NULL) "
          "OR (has_transcript AND NOT coalesce(transcript_word_count >= 0, false)))"),
    ]
    return f"""
SELECT 'curated' AS stage, strftime(d, '%Y%m%d') AS p_date, name, check_type, 'ERROR' AS severity, v = 0 AS passed, CAST(v AS BIGINT) AS violations
FROM ({" UNION ALL ".join(out)})""".replace("FROM dates", "FROM (SELECT DISTINCT p_date AS d FROM ev)")


def curated_tables(spark, sf, facts=None):
    """The published tables over ``events``: facts, features and dimensions, stored as the gate finds them.

    ``facts``: the events as the fact table is to hold them, where they differ from ``daily_events``.
    """
    e = I.daily_events(spark, sf)
    plans = {
        "interactions_curated": curate.curated_events(e if facts is None else facts),
        "daily_user_features": curate.daily_features(e),
        "users": I.users(spark, sf),
        "videos": curate.dim_videos(e, stage.stage_transcripts(I.transcripts(spark, sf))),
        "categories": stage.stage_categories(I.raw_categories(spark, sf)),
        "video_categories": I.video_categories(spark, sf),
    }
    return {name: materialize(df, name) for name, df in plans.items()}


def _curated_gate(t, staged):
    return gates.curated_gate(t["interactions_curated"], t["daily_user_features"], t["users"], t["videos"],
                              t["categories"], t["video_categories"], staged).select(*_REPORT)


@query("gate_curated", _sql_curated_gate("feat", "users_typed"))
def gate_curated(spark, sf):
    return _curated_gate(curated_tables(spark, sf), I.daily_events(spark, sf))


_SPOILED_FEAT = """(SELECT * REPLACE (
  CASE WHEN feature_date = DATE '2024-01-02' THEN 1.5 ELSE hate_rate END AS hate_rate,
  CASE WHEN feature_date = DATE '2024-01-03' THEN n_events + 5 ELSE n_events END AS n_events,
  CASE WHEN feature_date = DATE '2024-01-04' THEN n_events + 1 ELSE hate_events END AS hate_events,
  CASE WHEN feature_date = DATE '2024-01-05' THEN 0 ELSE n_sessions END AS n_sessions,
  CASE WHEN feature_date = DATE '2024-01-06' THEN -0.5 ELSE late_night_share END AS late_night_share,
  CASE WHEN feature_date = DATE '2024-01-08' THEN 2.0 ELSE rewatch_rate END AS rewatch_rate)
FROM feat UNION ALL SELECT * FROM feat WHERE feature_date = DATE '2024-01-07')"""


_SPOILED_VIDEOS = f"""(SELECT * REPLACE (CASE WHEN pid % 10 = 4 THEN -1 ELSE transcript_word_count END AS transcript_word_count)
FROM {_EV_VIDEOS} WHERE pid % 10 <> 3)"""


@query("gate_curated_defects", _sql_curated_gate(
    _SPOILED_FEAT, "(SELECT * FROM users_typed WHERE fre_community_type <> '镇区')", videos=_SPOILED_VIDEOS,
    cats="(SELECT n_nationkey AS category_id FROM nation WHERE n_nationkey <> 5)"))
def gate_curated_defects(spark, sf):
    t = curated_tables(spark, sf)
    f, d = t["daily_user_features"], F.col("feature_date")

    def on(day, value, column):
        return F.when(d == F.lit(day).cast("date"), value).otherwise(F.col(column))

    again = f.where(d == F.lit("2024-01-07").cast("date"))
    t["daily_user_features"] = (
        f.withColumn("hate_rate", on("2024-01-02", F.lit(1.5), "hate_rate"))
        .withColumn("hate_events", on("2024-01-04", F.col("n_events") + 1, "hate_events"))
        .withColumn("n_events", on("2024-01-03", F.col("n_events") + 5, "n_events"))
        .withColumn("n_sessions", on("2024-01-05", F.lit(0), "n_sessions"))
        .withColumn("late_night_share", on("2024-01-06", F.lit(-0.5), "late_night_share"))
        .withColumn("rewatch_rate", on("2024-01-08", F.lit(2.0), "rewatch_rate"))
        .unionByName(again)
    )
    t["videos"] = t["videos"].where("pid % 10 <> 3").withColumn(
        "transcript_word_count", F.when(F.col("pid") % 10 == 4, -1).otherwise(F.col("transcript_word_count")))
    t["categories"] = t["categories"].where("category_id <> 5")
    t["users"] = t["users"].where("fre_community_type <> '镇区'")
    return _curated_gate(t, I.daily_events(spark, sf))


@query("gate_summary", f"""
SELECT stage, p_date, count(*) AS checks_run, count(*) FILTER (WHERE passed) AS passed,
       count(*) FILTER (WHERE NOT passed AND severity = 'WARN') AS warnings,
       count(*) FILTER (WHERE NOT passed AND severity = 'ERROR') AS errors
FROM ({_sql_raw_gate("defects", "part_date", "cats", _NO_TRANSCRIPTS)}) GROUP BY ALL""")
def gate_summary(spark, sf):
    return K.summary(gate_raw_defects(spark, sf))


# ---- constraints ----------------------------------------------------------------------------

def _sql_constraints(tables):
    out = []
    for name, (src, cols) in tables.items():
        key = constraints.PRIMARY_KEYS[name]
        out.append(f"SELECT '{name}' AS table_name, 'primary_key' AS kind, '{','.join(key)}' AS name, "
                   f"coalesce((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {src} GROUP BY {', '.join(key)})), 0) AS violations")
        for rule, expr in constraints.VALUE_RULES.get(name, {}).items():
            out.append(f"SELECT '{name}', 'check', '{rule}', (SELECT count(*) FROM {src} WHERE NOT ({expr}))")
        for c in cols:
            if c not in constraints.NULLABLE:
                out.append(f"""SELECT '{name}', 'not_null', '{c}', (SELECT count(*) FROM {src} WHERE "{c}" IS NULL)""")
    for child, column, parent in constraints.FOREIGN_KEYS:
        if child in tables and parent in tables:
            out.append(f"SELECT '{child}', 'foreign_key', '{column}->{parent}', (SELECT count(DISTINCT {column}) FROM {tables[child][0]} "
                       f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {tables[parent][0]}))")
    return f"SELECT table_name, kind, name, CAST(violations AS BIGINT) AS violations FROM ({' UNION ALL '.join(out)})"


_CAT_COLUMNS = ["category_level", "category_id", "category_name_cn", "parent_id", "root_id", "category_name_en", "en_label_ambiguous"]
_TABLES_SQL = {
    "interactions_curated": ("ev", CURATED_EVENT_COLUMNS),
    "daily_user_features": ("feat", FEATURE_COLUMNS),
    "users": ("users_typed", USER_COLUMNS),
    "videos": (_EV_VIDEOS, VIDEO_COLUMNS),
    "categories": ("dim_cats", _CAT_COLUMNS),
    "video_categories": ("bridge", ["pid", "category_id"]),
    "risk_scores": ("(SELECT user_id, feature_date AS score_date, CAST(n_sessions AS DOUBLE) AS risk_score FROM feat)",
                    ["user_id", "score_date", "risk_score"]),
}


@query("constraint_violations", _sql_constraints(_TABLES_SQL))
def constraint_violations(spark, sf):
    t = curated_tables(spark, sf)
    t["risk_scores"] = t["daily_user_features"].select(
        "user_id", F.col("feature_date").alias("score_date"), F.col("n_sessions").cast("double").alias("risk_score"))
    return constraints.constraint_violations(t)


_BAD_SQL = {
    "interactions_curated": ("(SELECT * REPLACE (CASE WHEN hate THEN -1 ELSE watch_time END AS watch_time, CASE WHEN click THEN NULL ELSE p_hour END AS p_hour, "
                             "CASE WHEN follow THEN 0 ELSE tag_count END AS tag_count) FROM ev2)", CURATED_EVENT_COLUMNS),
    "users": ("(SELECT * REPLACE (CASE WHEN fre_city_level = 'unknown' THEN age + 90 ELSE age END AS age, "
              "CASE WHEN fre_community_type = 'unknown' THEN 'X' ELSE gender END AS gender) FROM users_typed WHERE fre_community_type <> '镇区')", USER_COLUMNS),
}


@query("constraint_violations_defects", _sql_constraints(_BAD_SQL))
def constraint_violations_defects(spark, sf):
    e = curate.curated_events(I.daily_events_in_two_dates(spark, sf))
    u = I.users(spark, sf)
    return constraints.constraint_violations({
        "interactions_curated": e.withColumn("watch_time", F.when(F.col("hate"), -1).otherwise(F.col("watch_time")))
        .withColumn("p_hour", F.when(~F.col("click"), F.col("p_hour")))
        .withColumn("tag_count", F.when(F.col("follow"), 0).otherwise(F.col("tag_count"))),
        "users": u.withColumn("age", F.when(F.col("fre_city_level") == "unknown", F.col("age") + 90).otherwise(F.col("age")))
        .withColumn("gender", F.when(F.col("fre_community_type") == "unknown", "X").otherwise(F.col("gender")))
        .where("fre_community_type <> '镇区'"),
    })


@query("containment_orphans", """
SELECT DISTINCT l_orderkey AS pid FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""")
def containment_orphans(spark, sf):
    lines = I.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pid"))
    known = I.table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("pid"))
    return compare.missing_keys(lines, known, "pid")
