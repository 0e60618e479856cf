"""How the input tables are joined: what moves with an order line."""

from daybrook.catalog import inputs as I

SF = "/root/testdata/sf0.001"


def subtree(plan: str, node: str) -> str:
    """The lines of a plan below the first one that holds ``node``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-*()0123456789"))

    below = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    return "\n".join(below)


def test_order_lines_do_not_move_for_the_users(spark):
    """Users meet orders: what is dealt by customer holds no order lines."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = I.raw_interactions(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = subtree(plan, "Exchange hashpartitioning(o_custkey")
    assert "o_orderkey" in dealt and "l_orderkey" not in dealt
    assert "l_discount" in plan and "Exchange hashpartitioning(l_partkey" in plan


def test_null_conditions_are_false(spark, tmp_path):
    """A line without flags, discount and tax has every flag ``False`` and no copy."""
    from pyspark.sql import functions as F
    for name in ("orders", "lineitem", "part", "nation", "customer"):
        t = I.table(spark, SF, name)
        if name == "lineitem":
            none = {c: F.lit(None).cast(t.schema[c].dataType) for c in ("l_returnflag", "l_linestatus", "l_discount", "l_tax")}
            t = t.withColumns(none)
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    rows = I.raw_interactions(spark, str(tmp_path))
    flags = ["cvm_like", "click", "comment", "follow", "collect", "hate"]
    assert rows.count() == I.raw_fanout(spark, SF).count()
    assert [tuple(r) for r in rows.select(*flags).distinct().collect()] == [("False",) * 6]
