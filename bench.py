"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Queries run once unmeasured and then ``$BENCH_REPEATS`` times; the median counts. Results are fully computed (noop
sink), including whatever a query writes and reads back on the way. The ``read_*`` and ``write_*`` entries time single
scans and writes of stored copies, written once beforehand: formats, column subsets, and ways to read one date.
"""

import json
import os
import statistics
import time

from daybrook.catalog import all_queries, inputs
from daybrook.plans import curate, layout
from daybrook.session import local_session, work_path
from daybrook.sources import readers as R, sinks as W

HEADLINE = [
    "daily_user_features", "session_ids", "event_collapse", "exact_dedup", "video_category_pairs", "dim_users_latest",
    "ownership_full_range", "late_partition_dates", "gate_raw", "gate_curated", "screening_flags", "usage_summary",
    "exact_quantiles", "q1_late_night_top", "q2_long_sessions_hate", "q3_late_night_by_tier", "q4_hate_trend",
    "q5_top_categories", "transcript_word_count", "profile_columns",
]
DAY = "2024-01-15"
RAW_DAY = "19980101"


def timed(run, repeats):
    times = []
    for i in range(repeats + 1):
        start = time.perf_counter()
        run()
        if i:
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def storage_times(spark, sf_dir, repeats):
    """Format and partition timings on the curated events and the raw rows."""
    out = {}
    events = curate.curated_events(inputs.daily_events(spark, sf_dir))
    root = work_path(spark, "bench")
    W.write_partitions(events, f"{root}/partitioned")
    stored = R.read_table(spark, f"{root}/partitioned", events.schema)
    stored.coalesce(1).write.parquet(f"{root}/single")
    W.write_clustered(stored, f"{root}/clustered")
    single = R.read_table(spark, f"{root}/single", events.schema)
    for fmt in R.FORMATS:
        path = f"{root}/{fmt}"
        copies = iter(range(repeats + 2))
        out[f"write_{fmt}"] = timed(lambda: W.write_format(single, fmt, f"{path}/{next(copies)}"), repeats)
        out[f"read_{fmt}"] = timed(lambda: drain(R.read_format(spark, fmt, f"{path}/0", events.schema)), repeats)
        out[f"read_3_columns_{fmt}"] = timed(
            lambda: drain(R.read_format(spark, fmt, f"{path}/0", events.schema, layout.SUBSET_COLUMNS)), repeats)

    for name, copy in zip(layout.STRATEGIES, ("partitioned", "partitioned", "single", "clustered")):
        out[f"read_one_day_{name}"] = timed(
            lambda: drain(layout.read_one_date(spark, name, f"{root}/{copy}", events.schema, DAY)), repeats)
    raw = inputs.landed_raw(spark, sf_dir)
    for fmt in ("csv", "parquet"):
        W.fanout_by_date(raw, f"{root}/raw_{fmt}", fmt)
        out[f"read_raw_{fmt}_one_day"] = timed(lambda: drain(R.read_raw(spark, f"{root}/raw_{fmt}", RAW_DAY, fmt=fmt)), repeats)
        out[f"read_raw_{fmt}_all_filter"] = timed(
            lambda: drain(R.read_raw(spark, f"{root}/raw_{fmt}", fmt=fmt).where(f"p_date = '{RAW_DAY}'")), repeats)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = all_queries()
    seconds = {n: timed(lambda: drain(queries[n](spark, sf_dir)), repeats) for n in names}
    if not os.environ.get("BENCH_QUERIES"):
        seconds.update(storage_times(spark, sf_dir, max(repeats, 3)))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
