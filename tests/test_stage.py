"""Typing, duplicates, ownership, collapse, lookups and transcripts."""

import random

import pytest
from pyspark.sql import functions as F

from daybrook.functions import columns as C
from daybrook.operators import compare, dedup, events as E
from daybrook.params import Params
from daybrook.plans import curate, stage
from daybrook.schemas import EVENT_KEY
from tests.conftest import D1, D2, D3, T0, files_df, lookup_df, raw_df, raw_row, two_days


def staged(spark, rows, **kw):
    return stage.stage_events(raw_df(spark, rows), staged_at="now", **kw)


def test_two_day_counts(spark):
    raw = raw_df(spark, two_days())
    stats = {r["p_date"].strftime("%Y%m%d"): r for r in stage.stage_statistics(
        raw, stage.stage_events(raw), stage.stage_category_pairs(raw)).collect()}
    assert stats[D1]["exact_duplicate_rows_dropped"] == 1 and stats[D2]["exact_duplicate_rows_dropped"] == 0
    assert [stats[d]["staged_events"] for d in (D1, D2)] == [4, 2]
    assert [stats[d]["events_owned_by_earlier_partition"] for d in (D1, D2)] == [0, 1]
    assert stats[D1]["rewatch_flagged_events"] == 1 and stats[D1]["hate_events"] == 1


def test_duplicates_compare_text(spark):
    df = raw_df(spark, [raw_row(duration="20.0"), raw_row(duration="20.00"), raw_row(duration="20.0")])
    s = dedup.duplicate_stats(df).first()
    assert (s["n_rows"], s["distinct_rows"], s["exact_duplicate_rows"]) == (3, 2, 1)
    assert dedup.drop_exact_duplicates(df).count() == 2


def test_typed_key_joins_spellings_of_one_number(spark):
    assert staged(spark, [raw_row(user_id="007"), raw_row(user_id="7", tag_name="b")]).count() == 1


def test_collapse_counts_distinct_tags_not_rows(spark):
    rows = [raw_row(tag_name=t, category_id=c) for t in "abc" for c in (1, 2)]
    e = staged(spark, rows).first()
    assert e["tag_count"] == 3


def test_collapse_keeps_the_whole_first_row(spark):
    rows = [raw_row(p_hour=11, title="a", watch_time=1), raw_row(p_hour=10, title="z", watch_time=9),
            raw_row(p_hour=10, title="m", watch_time=5)]
    for order in (rows, rows[::-1]):
        e = staged(spark, order).first()
        assert (e["p_hour"], e["title"], e["watch_time"]) == (10, "m", 5)


def test_event_belongs_to_its_earliest_date(spark):
    rows = [raw_row(p_date=d) for d in (D3, D1, D2)] + [raw_row(p_date=D3, pid=5)]
    got = {(r["pid"], r["p_date"].strftime("%Y%m%d")) for r in staged(spark, rows).collect()}
    assert got == {(100, D1), (5, D3)}


def test_incremental_ownership_equals_range(spark):
    rows = two_days()
    full = staged(spark, rows)
    day1 = stage.stage_events(raw_df(spark, [r for r in rows if r["p_date"] == D1]), staged_at="now")
    day2 = stage.stage_events_after(raw_df(spark, [r for r in rows if r["p_date"] == D2]),
                                    day1.select(*EVENT_KEY, "p_date"), staged_at="now")
    assert compare.same_rows(full, day1.unionByName(day2))


def test_pairs_belong_to_the_owning_date(spark):
    got = {(str(r["p_date"]), r["pid"], r["category_id"])
           for r in stage.stage_category_pairs(raw_df(spark, two_days())).collect()}
    assert {g[1:] for g in got if g[1] == 300} == {(300, 2), (300, 3)}
    assert {g[0] for g in got if g[1] == 300} == {"2022-09-16"}


def test_rewatch_is_strict_and_uncapped(spark):
    rows = [raw_row(pid=1, watch_time=20), raw_row(pid=2, watch_time=21), raw_row(pid=3, watch_time=500)]
    got = {r["pid"]: (r["is_rewatch_flagged"], r["watch_ratio"]) for r in staged(spark, rows).collect()}
    assert got == {1: (False, 1.0), 2: (True, 1.05), 3: (True, 25.0)}
    twice = {r["pid"]: r["is_rewatch_flagged"] for r in staged(spark, rows, params=Params(rewatch_ratio=2.0)).collect()}
    assert twice == {1: False, 2: False, 3: True}


def test_zero_duration_gives_null_ratio(spark):
    assert staged(spark, [raw_row(duration="0")]).first()["watch_ratio"] is None


def test_unknown_stays_and_types_are_fixed(spark):
    e = staged(spark, two_days(), batch_id="b1").where("user_id = 14").first()
    assert e["fre_community_type"] == "unknown" and e["fre_city_level"] == "unknown" and e["ingest_batch_id"] == "b1"
    types = dict(staged(spark, two_days()).dtypes)
    assert types["p_date"] == "date" and types["duration"] == "double" and types["hate"] == "boolean" and types["age"] == "bigint"
    assert not set(types) & {"category_id", "category_level", "parent_id", "root_id", "tag_name"}


def test_lookup_keeps_first_label_and_flags_conflicts(spark):
    rows = [("2", "41", "鸟", "4", "4", " birds"), ("2", "40", "树", "4", "4", "trees "), ("2", "41", "鸟", "4", "4", " fowl"),
            ("2", "41", "鸟", "4", "4", " birds")]
    got = {r["category_id"]: (r["category_name_en"], r["en_label_ambiguous"])
           for r in stage.stage_categories(lookup_df(spark, rows)).collect()}
    assert got == {41: ("birds", True), 40: ("trees", False)}


def test_strip_removes_unicode_space(spark):
    df = spark.createDataFrame([("　 a b \n",), ("\x1c x\x1f",), ("",)], "s string")
    assert [r[0] for r in df.select(C.strip("s")).collect()] == ["a b", "x", ""]


def test_transcripts(spark):
    got = {r["pid"]: r["transcript_word_count"] for r in stage.stage_transcripts(files_df(spark)).collect()}
    assert got == {300: 5, 301: 1}
    empty = stage.no_transcripts(spark)
    assert empty.count() == 0 and dict(empty.dtypes)["transcript_word_count"] == "bigint"


def test_word_count_matches_python_split(spark):
    texts = ["", "  ", "one", " a\tb\nc ", "x　y", "p\x1cq", "tail "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(C.word_count("t")).collect()] == [len(t.split()) for t in texts]


def test_text_type_rules(spark):
    cases = {"1": True, "-5": True, "007": True, " 1 ": False, "+1": False, "1.0": False, "": False, "1\n": False,
             "99999999999999999999": False, "ten": False, "-0": True}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert dict((r[0], r[1]) for r in df.select("c", C.is_int_text("c")).collect()) == cases
    numbers = {"1.5": True, "1.0d": False, "1f": False, "NaN": False, "long": False, "-3": True, "1e3": True}
    df = spark.createDataFrame([(c,) for c in numbers], "c string")
    assert dict((r[0], r[1]) for r in df.select("c", C.is_number_text("c")).collect()) == numbers
    blanks = {"": True, " ": True, "　": True, "\n\t": True, "a": False, " a": False, "美": False}
    df = spark.createDataFrame([(c,) for c in blanks], "c string")
    assert dict((r[0], r[1]) for r in df.select("c", C.is_blank("c")).collect()) == blanks


def test_dimensions(spark):
    ev = staged(spark, two_days() + [raw_row(pid=300, user_id=9, exposed_time=T0 + 5, title="Z", p_date=D2, age=60),
                                     raw_row(pid=9, user_id=9, exposed_time=T0 + 6, p_date=D2, age=61)])
    users = {r["user_id"]: r["age"] for r in curate.dim_users(ev).collect()}
    assert users[9] == 61 and len(users) == 5
    videos = {r["pid"]: r for r in curate.dim_videos(ev, stage.stage_transcripts(files_df(spark))).collect()}
    assert videos[300]["title"] == "Z" and videos[300]["transcript_word_count"] == 5
    assert videos[302]["has_transcript"] is False and videos[302]["transcript_word_count"] is None


def test_hot_event_is_combined_before_the_shuffle(spark):
    """A third of all rows are one event with many tags; the collapse still yields one row per event."""
    from daybrook.schemas import RAW_COLUMNS
    base = raw_df(spark, [raw_row()])
    n = 30_000
    many = spark.range(n).join(base.drop("pid", "tag_name", "exposed_time"), how="cross").select(
        *[{"pid": F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("pid"),
           "tag_name": F.concat(F.lit("t"), (F.col("id") % 5000).cast("string")).alias("tag_name"),
           "exposed_time": F.lit(str(T0)).alias("exposed_time")}.get(c, F.col(c)) for c in RAW_COLUMNS])
    got = stage.stage_events(many)
    assert got.count() == n - n // 3 and got.where("pid = 1").first()["tag_count"] == 5000


@pytest.mark.parametrize("wanted", [["title", "author_id", "duration"], ["gender", "fre_city_level"]])
def test_owned_attributes_equal_the_staged_columns(spark, wanted):
    raw = raw_df(spark, two_days() + [raw_row(title="b", author_id=3), raw_row(title="a", author_id=4, duration="9.0"),
                                      raw_row(title="a", author_id=4, duration="8.0", p_date=D2)])
    got = stage.stage_attributes(raw, wanted)
    want = stage.stage_events(raw).select(*EVENT_KEY, "p_date", *wanted)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_owned_events_equal_the_two_steps(spark):
    """Events in several dates, with copies, ties, nulls and tags that differ by date."""
    rng = random.Random(8)
    rows = [raw_row(user_id=rng.randrange(3), pid=rng.randrange(4), exposed_time=T0 + rng.randrange(2), p_hour=rng.randrange(3),
                    title=rng.choice("ab"), tag_name=rng.choice("xyz"), p_date=rng.choice([D1, D2]), watch_time=rng.randrange(4))
            for _ in range(150)]
    rows += [{**raw_row(pid=9), "pid": None}, {**raw_row(pid=8), "p_date": None}, {**raw_row(pid=7), "tag_name": None}]
    typed = E.type_rows(raw_df(spark, rows))
    want, got = E.keep_earliest_date(E.collapse(typed)), E.collapse_owned(typed)
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect()))) and got.count() > 10
    plan = E.collapse_owned(typed)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Aggregate" in line and "min(struct" in line]
    assert "row_number()" not in plan and len(wide) == 2  # before and after the one exchange of wide rows
