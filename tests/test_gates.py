"""Every gate passes on clean data and reports exactly the injected defect."""

import pytest
from pyspark.sql import functions as F, types as T

from daybrook.operators import checks as K
from daybrook.params import Params
from daybrook.plans import constraints, curate, gates, stage
from daybrook.schemas import RAW_COLUMNS, RAW_SCHEMA
from daybrook.sources.readers import PART
from tests.conftest import D1, D2, files_df, lookup_df, raw_df, raw_row, two_days


def day_one():
    return [r for r in two_days() if r["p_date"] == D1]


def raw_report(spark, rows, lookup=None, files=None, part=D1):
    raw = raw_df(spark, rows).withColumn(PART, F.lit(part))
    rep = gates.raw_gate(raw, lookup if lookup is not None else lookup_df(spark),
                         files if files is not None else files_df(spark))
    return {r["name"]: r for r in rep.collect()}


def failing(rep):
    return {n for n, r in rep.items() if not r["passed"]}


def test_clean_raw_passes_all_19(spark):
    rep = raw_report(spark, day_one())
    assert len(rep) == 19 and not failing(rep)


# one changed column of one row, and the check it must fail
DEFECTS = [
    (dict(fre_city=""), "required_fields_not_null"), (dict(title="　"), "required_fields_not_null"),
    (dict(watch_time="ten"), "column_datatypes"), (dict(hate="maybe"), "column_datatypes"),
    (dict(duration="long"), "column_datatypes"),
    (dict(p_hour=24), "p_hour_0_23"), (dict(age=-2), "age_in_range"), (dict(age=201), "age_in_range"),
    (dict(watch_time=-1), "watch_time_non_negative"), (dict(duration="0"), "duration_positive"),
    (dict(mod_price=-5), "mod_price_non_negative"), (dict(exposed_time=0), "exposed_time_positive"),
    (dict(gender="X"), "gender_accepted_values"), (dict(fre_community_type="suburb"), "fre_community_type_accepted_values"),
    (dict(fre_city_level="六线城市"), "fre_city_level_accepted_values"),
    (dict(p_date="20990101"), "p_date_matches_partition"), (dict(category_id=999), "category_id_in_lookup"),
    # boundary values that must pass
    (dict(p_hour=23), None), (dict(age=100), None), (dict(watch_time=0), None), (dict(mod_price=0), None),
    (dict(age=5), None),
]


def test_each_defect_fails_its_check_in_its_own_date(spark):
    """Every defect lands in a date of its own; one gate run reports them all, date by date."""
    raw = None
    for i, (change, _) in enumerate(DEFECTS):
        part = str(20230101 + i)
        rows = [{**r, "p_date": part} for r in day_one()] + [raw_row(**{"user_id": 50, "pid": 500, "p_date": part, **change})]
        df = [[r[c] for c in RAW_COLUMNS] + [part] for r in rows]
        raw = (raw or []) + df
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(PART, T.StringType())])
    rep = gates.raw_gate(spark.createDataFrame(raw, schema), lookup_df(spark), files_df(spark)).collect()
    for i, (change, name) in enumerate(DEFECTS):
        mine = {r["name"]: r for r in rep if r["p_date"] == str(20230101 + i)}
        assert failing(mine) == ({name} if name else set()), change
        assert name is None or mine[name]["violations"] == 1
        # blank or untyped cells end the gate early: range checks need numbers
        assert len(mine) == (4 if name in ("required_fields_not_null", "column_datatypes") else 19)


def test_user_attributes_must_agree(spark):
    assert failing(raw_report(spark, day_one() + [raw_row(user_id=11, pid=7, gender="M", age=33)])) == {"user_attributes_consistent"}


def test_warnings_do_not_stop(spark):
    rows = [raw_row()] * 8 + [raw_row(pid=1), raw_row(pid=2)]
    twice = lookup_df(spark, [("1", "1", "a", "1", "1", "x"), ("1", "1", "a", "1", "1", "y")])
    raw = raw_df(spark, rows).withColumn(PART, F.lit(D1))
    rep = gates.raw_gate(raw, twice, files_df(spark))
    assert failing({r["name"]: r for r in rep.collect()}) == {"exact_duplicate_share", "category_lookup_unique_ids"}
    K.enforce(rep)
    s = K.summary(rep).first()
    assert (s["checks_run"], s["passed"], s["warnings"], s["errors"]) == (19, 17, 2, 0)


def test_missing_transcripts_and_columns(spark):
    assert failing(raw_report(spark, day_one(), files=files_df(spark).where("false"))) == {"transcript_files_present"}
    raw = raw_df(spark, day_one()).drop("hate").withColumn(PART, F.lit(D1))
    rep = {r["name"]: r for r in gates.raw_gate(raw, lookup_df(spark), files_df(spark)).collect()}
    assert set(rep) == {"schema_columns", "partition_not_empty"} and failing(rep) == {"schema_columns"}
    extra = raw_df(spark, day_one()).withColumn("x", F.lit("1")).withColumn(PART, F.lit(D1))
    rep = {r["name"]: r for r in gates.raw_gate(extra, lookup_df(spark), files_df(spark)).collect()}
    assert failing(rep) == {"schema_columns"}


def test_error_lists_every_failure(spark, tmp_path):
    raw = raw_df(spark, [raw_row(p_hour=99, gender="Q")]).withColumn(PART, F.lit(D1))
    with pytest.raises(K.GateError) as err:
        K.enforce(gates.raw_gate(raw, lookup_df(spark), files_df(spark)), str(tmp_path / "rep"))
    assert "p_hour_0_23" in str(err.value) and "gender_accepted_values" in str(err.value)
    assert spark.read.json(str(tmp_path / "rep")).count() == 19


def staged_report(spark, change=lambda e: e, change_pairs=lambda p: p, rows=None):
    raw = raw_df(spark, rows or two_days())
    rep = gates.staged_gate(raw, change(stage.stage_events(raw)), change_pairs(stage.stage_category_pairs(raw)))
    return {(r["p_date"], r["name"]): r for r in rep.collect()}


def test_clean_staged_passes(spark):
    rep = staged_report(spark)
    assert len(rep) == 20 and all(r["passed"] for r in rep.values())


def on_user_13(column, value):
    return F.when(F.col("user_id") == 13, value).otherwise(F.col(column))


@pytest.mark.parametrize("names, change", [
    ({"event_key_unique", "event_count_reconciles_to_raw"}, lambda e: e.unionByName(e.where("user_id = 11"))),
    ({"event_count_reconciles_to_raw"}, lambda e: e.where("user_id <> 12 OR p_date > '2022-09-16'")),
    ({"rewatch_retained_and_flagged", "fre_community_type_unknown_preserved", "fre_city_level_unknown_preserved",
      "tag_count_positive", "watch_ratio_non_negative"},
     lambda e: e.withColumn("is_rewatch_flagged", F.lit(False)).withColumn("fre_community_type", F.lit("城区"))
     .withColumn("fre_city_level", F.lit("一线城市")).withColumn("tag_count", on_user_13("tag_count", 0))
     .withColumn("watch_ratio", on_user_13("watch_ratio", -1.0))),
    ({"key_columns_not_null"}, lambda e: e.withColumn("pid", F.when(F.col("user_id") != 13, F.col("pid")))),
])
def test_staged_defects(spark, names, change):
    rep = staged_report(spark, change)
    assert names <= {n for (d, n), r in rep.items() if d == D1 and not r["passed"]}


def test_staged_pair_defects(spark):
    assert not staged_report(spark, change_pairs=lambda p: p.unionByName(p))[(D1, "video_category_pairs_unique")]["passed"]
    assert not staged_report(spark, change_pairs=lambda p: p.where("pid <> 300"))[(D1, "staged_events_have_categories")]["passed"]


def test_business_rules_only_bind_the_first_date(spark):
    rep = staged_report(spark, lambda e: e.withColumn("is_rewatch_flagged", F.col("p_date") > F.lit("2022-09-16").cast("date")))
    assert rep[(D2, "rewatch_retained_and_flagged")]["passed"]


def curated(spark):
    raw = raw_df(spark, two_days())
    ev = stage.stage_events(raw)
    return dict(
        events=curate.curated_events(ev), features=curate.daily_features(ev), users=curate.dim_users(ev),
        videos=curate.dim_videos(ev, stage.stage_transcripts(files_df(spark))),
        categories=stage.stage_categories(lookup_df(spark)),
        bridge=curate.dim_video_categories(stage.stage_category_pairs(raw)), staged=ev)


def test_clean_curated_passes(spark):
    rep = gates.curated_gate(**curated(spark)).collect()
    assert len(rep) == 22 and all(r["passed"] for r in rep)


def test_curated_defects(spark):
    t = curated(spark)
    f = t["features"]
    t["features"] = f.unionByName(f).withColumn("hate_rate", F.lit(1.5)).withColumn("hate_events", F.lit(99)).withColumn(
        "n_sessions", F.lit(0)).withColumn("n_events", F.col("n_events") + 5)
    t["users"] = t["users"].where("user_id <> 11")
    t["videos"] = t["videos"].where("pid <> 301").withColumn("transcript_word_count", F.lit(-1))
    bad = {r["name"] for r in gates.curated_gate(**t).collect() if r["p_date"] == D1 and not r["passed"]}
    assert bad == {
        "hate_rate_within_0_1", "features_pk_unique", "feature_event_totals_reconcile", "hate_events_le_events",
        "sessions_consistent", "features_users_exist", "events_users_videos_exist", "video_categories_exist",
        "transcript_fields_consistent"}


def test_constraints(spark):
    t = curated(spark)
    tables = {"users": t["users"], "videos": t["videos"], "categories": t["categories"], "video_categories": t["bridge"],
              "interactions_curated": t["events"], "daily_user_features": t["features"]}
    assert constraints.constraint_violations(tables).where("violations > 0").count() == 0
    tables["users"] = t["users"].withColumn("age", F.when(F.col("user_id") == 11, 9).otherwise(F.col("age"))).where("user_id <> 13")
    bad = {(r["table_name"], r["name"]): r["violations"]
           for r in constraints.constraint_violations(tables).where("violations > 0").collect()}
    assert bad == {("users", "age_10_to_100"): 1, ("interactions_curated", "user_id->users"): 1,
                   ("daily_user_features", "user_id->users"): 1}


def test_age_gate_is_wider_than_the_constraint():
    assert (Params().age_min, Params().age_max) == (-1, 200)
    assert "age BETWEEN 10 AND 100" in constraints.VALUE_RULES["users"].values()


def test_the_staged_gate_moves_no_columns_it_does_not_read(spark):
    """The raw side needs a row's first columns up to the duration; attributes of users never reach an exchange."""
    raw = raw_df(spark, two_days())
    plan = gates.staged_gate(raw, stage.stage_events(raw), stage.stage_category_pairs(raw))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    firsts = [line for line in text.splitlines() if "min(struct(p_hour" in line and "raw_rewatch" not in line]
    assert any("duration" in line and "fre_city," not in line.split("min(struct(")[1].split(")")[0] for line in firsts)
