"""Record traces and layer counts with consistency checks."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from daybrook.operators import events as E
from daybrook.schemas import EVENT_KEY


def record_trace(raw: DataFrame, staged: DataFrame, features: DataFrame) -> DataFrame:
    """Raw rows and dates of every event key, the staged row that owns it and the feature row it feeds."""
    per_day = E.type_rows(raw, EVENT_KEY + ["p_date"]).groupBy(*EVENT_KEY, "p_date").agg(F.count(F.lit(1)).alias("n"))
    rows = per_day.groupBy(*EVENT_KEY).agg(F.sum("n").alias("raw_rows"), F.count(F.lit(1)).alias("raw_dates"))
    s = staged.select(*EVENT_KEY, F.col("p_date").alias("staged_date"), "tag_count")
    f = features.select("user_id", F.col("feature_date").alias("staged_date"), F.col("n_events").alias("feature_events"))
    return rows.join(s, EVENT_KEY, "left").join(f, ["user_id", "staged_date"], "left").select(
        *EVENT_KEY, "raw_rows", "raw_dates", "staged_date", "tag_count", "feature_events")


def layer_counts(counts: dict) -> DataFrame:
    """``(layer, name) -> one-row DataFrame`` of counts as one long table; nothing is collected."""
    out = [df.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), F.col(df.columns[0]).cast("bigint").alias("n"))
           for (layer, name), df in counts.items()]
    return reduce(DataFrame.unionByName, out)


# fixed rules: left = sum of signed right-hand counters
CONSISTENCY = {
    "rows after dedup": [("raw", "interaction_rows", 1), ("staging", "exact_duplicate_rows", -1), ("staging", "rows_after_dedup", -1)],
    "events after ownership": [("staging", "events_in_partitions", 1), ("staging", "owned_earlier", -1), ("staging", "events", -1)],
    "curated equals staged": [("staging", "events", 1), ("curated", "interactions_curated", -1)],
    "features cover events": [("curated", "feature_events", 1), ("curated", "interactions_curated", -1)],
}


def consistency(counts: DataFrame) -> DataFrame:
    """Every rule with its signed difference; zero when the layers agree."""
    out = []
    for rule, terms in CONSISTENCY.items():
        signed = reduce(lambda acc, t: acc.when((F.col("layer") == t[0]) & (F.col("name") == t[1]), F.col("n") * t[2]), terms, F)
        out.append(counts.agg(F.sum(signed).alias("difference")).select(F.lit(rule).alias("rule"), "difference"))
    return reduce(DataFrame.unionByName, out)


def consistency_problems(counts: DataFrame) -> DataFrame:
    """Rules that do not hold."""
    return consistency(counts).where("difference <> 0")
