"""Cell counters of the raw gate: several short aggregates give what one over all columns gives."""

from pyspark.sql import functions as F, types as T

from daybrook.functions import columns as C
from daybrook.params import DEFAULTS
from daybrook.plans import gates
from daybrook.schemas import RAW_COLUMNS, RAW_SCHEMA
from daybrook.sources.readers import PART
from tests.conftest import D1, D2, files_df, lookup_df, raw_df, raw_row

ODD = ["", " ", "　", "x", "007", "-1", "99999999999999999999", "1.0d", "NaN", "0", "24", "201", "True", "true", "M", None, "城区", "É"]


def test_counters_of_odd_cells_equal_one_aggregate_over_all_columns(spark):
    rows = [{**raw_row(), PART: D1}, {**raw_row(title=" "), PART: None}]
    rows += [{**raw_row(), c: v, PART: D1 if i % 2 else D2} for c in RAW_COLUMNS for i, v in enumerate(ODD)]
    raw = spark.createDataFrame([[r[c] for c in [*RAW_COLUMNS, PART]] for r in rows],
                                T.StructType(RAW_SCHEMA.fields + [T.StructField(PART, T.StringType())]))
    got = gates.raw_counters(raw, [])
    want = raw.groupBy(PART).agg(
        F.count(F.lit(1)).alias("n_rows"), C.count_if(F.col("p_date") != F.col(PART)).alias("off_date"),
        *[x for c in RAW_COLUMNS for x in gates._cell_counters(c, DEFAULTS)]).select(got.columns)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert got.where(F.col(PART).isNull()).first()["blank_title"] == 1


def test_methods_generated_for_the_raw_gate_are_short_enough_to_be_compiled(spark, tmp_path, capsys):
    raw_df(spark, [raw_row()]).withColumn(PART, F.col("p_date")).write.parquet(f"{tmp_path}/raw")
    conf = {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        gates.raw_gate(spark.read.parquet(f"{tmp_path}/raw"), lookup_df(spark), files_df(spark)).explain("codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plans = [(x, x.split("Generated code:")[0]) for x in capsys.readouterr().out.split("== Subtree")[1:]]
    # what runs over raw rows; joins are of one row a date. The JVM leaves longer methods to its interpreter
    sizes = [int(x.split("maxMethodCodeSize:")[1].split(";")[0]) for x, plan in plans if "FileScan parquet" in plan and "Join" not in plan]
    assert len(sizes) > 4 and max(sizes) < 8000
