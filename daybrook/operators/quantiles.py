"""Exact interpolated quantiles without collecting the values in one task.

Values are first counted (map-side combined, so a hot value is one row). Approximate split points over the distinct
values cut each column into at most ``SPLITS`` + 1 ranges; only the ranges that hold a wanted rank are ordered,
each by its own task. The splits steer the work only: ranks are counted exactly.
"""

from pyspark.sql import DataFrame, Window, functions as F

from daybrook.session import materialize

STEP = 16
SPLITS = STEP * STEP - 1


def value_counts(df: DataFrame, columns) -> DataFrame:
    """``(name, value, n)`` for several numeric columns in one pass; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull())
        .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles_of_counts(hist: DataFrame, qs) -> DataFrame:
    """``(name, q, quantile)`` from a ``(name, value, n)`` histogram, linear interpolation between ranks."""
    grid = [i / (SPLITS + 1) for i in range(1, SPLITS + 1)]
    splits = hist.groupBy("name").agg(F.percentile_approx("value", grid, 10 * SPLITS).alias("splits")).withColumn(
        "coarse", F.array(*[F.element_at("splits", STEP * k) for k in range(1, STEP)]))
    # one row per column with SPLITS numbers: the broadcast side cannot grow with the data
    splits = materialize(splits, "splits")
    # number of splits below the value, found in two steps of 15 comparisons
    cut = hist.join(F.broadcast(splits), "name").withColumn(
        "block", F.expr("size(filter(coarse, s -> s < value))")).withColumn(
        "bucket", F.expr(f"block * {STEP} + size(filter(slice(splits, block * {STEP} + 1, {STEP - 1}), s -> s < value))"))
    sizes = cut.groupBy("name", "bucket").agg(F.sum("n").alias("size"))
    by_name = Window.partitionBy("name")
    upto = by_name.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        sizes.withColumn("offset", F.sum("size").over(upto) - F.col("size"))
        .withColumn("total", F.sum("size").over(by_name))
        .withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
        .withColumn("pos", F.col("q") * (F.col("total") - 1))
        .withColumn("lo", F.floor("pos")).withColumn("hi", F.ceil("pos"))
    )
    end = F.col("offset") + F.col("size")
    holds = ((F.col("offset") <= F.col("lo")) & (F.col("lo") < end)) | ((F.col("offset") <= F.col("hi")) & (F.col("hi") < end))
    # at most two buckets per column and quantile, each with the value range it covers
    wanted = materialize(ranked.where(holds).select("name", "bucket", "offset", "q", "pos", "lo", "hi"), "ranks")
    places = wanted.select("name", "bucket", "offset").distinct().join(F.broadcast(splits.select("name", "splits")), "name").select(
        "name", "bucket", "offset", F.get("splits", F.col("bucket") - 1).alias("above"), F.get("splits", "bucket").alias("upto"))
    h, p = hist.alias("h"), F.broadcast(places).alias("p")
    in_range = (F.col("h.name") == F.col("p.name")) & (F.col("above").isNull() | (F.col("value") > F.col("above"))) & (
        F.col("upto").isNull() | (F.col("value") <= F.col("upto")))
    inside = Window.partitionBy("name", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = (
        h.join(p, in_range).select("h.name", "bucket", "offset", "value", "n")
        .withColumn("end", F.col("offset") + F.sum("n").over(inside))
        .withColumn("start", F.col("end") - F.col("n"))
    )
    hit = ordered.join(F.broadcast(wanted.drop("offset")), ["name", "bucket"])

    def at(rank):
        return F.max(F.when((F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("value")))

    return (
        hit.groupBy("name", "q").agg(at("lo").alias("a"), at("hi").alias("b"), F.max("pos").alias("pos"),
                                     F.max("lo").alias("lo"))
        .select("name", "q", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.col("lo"))).alias("quantile"))
    )


def quantiles(df: DataFrame, columns, qs) -> DataFrame:
    """Quantiles of several columns. The counts are read three times, so they are written once first."""
    return quantiles_of_counts(materialize(value_counts(df, columns), "value-counts"), qs)


def quantile(df: DataFrame, column: str, q: float):
    """One quantile as a scalar sub-query column."""
    return quantiles(df, [column], [q]).select("quantile").scalar()
