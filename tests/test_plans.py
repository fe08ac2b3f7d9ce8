"""Plan shapes that the scale design relies on, and a hot-key correctness run."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from benefitlens.operators import dedup, ranking
from tests.conftest import SF0001


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_dedup_combines_map_side_and_uses_no_window(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    p = plan(dedup.dedup_keep_none(df, "k"))
    assert "partial_count" in p and "Window" not in p
    p2 = plan(dedup.mark_duplicates(df, "k"))
    assert "partial_count" in p2 and "Window" not in p2


def test_capacity_rank_limits_rows_before_the_shuffle(spark):
    p = plan(E.queries()["rank_capacity"](spark, SF0001))
    head = p.split("\n\n")[0]
    assert "WindowGroupLimit" in head
    # the partial limit sits below the exchange, the final one above it
    assert head.count("WindowGroupLimit") >= 2


def test_global_topk_is_take_ordered(spark):
    df = spark.range(100).select(F.col("id").alias("employee_id"), (F.col("id") % 7).cast("double").alias("p"))
    top = ranking.rank_topk(df, 5)
    assert "TakeOrderedAndProject" in plan(top)


def test_scans_are_pruned_and_filters_pushed(spark):
    p = plan(E.queries()["mark_duplicates"](spark, SF0001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in p
    p = plan(E.queries()["filter_isin"](spark, SF0001))
    assert "EqualTo(o_orderpriority,1-URGENT)" in p


def test_hot_key_holding_a_third_of_rows(spark):
    n = 3000
    rows = [(0 if i % 3 == 0 else i, "A" if i % 3 else "B", float(i % 11) / 10, i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "employee_id int, region string, p double, enrolled int")
    kept = dedup.dedup_keep_none(df, "employee_id")
    assert kept.count() == n - n // 3
    marked = dedup.mark_duplicates(df, "employee_id").filter("employee_id = 0").select("dup_count").distinct()
    assert [r.dup_count for r in marked.collect()] == [n // 3]
    rep = dedup.duplicate_conflicts(df, "employee_id", "enrolled").collect()
    assert len(rep) == 1 and rep[0].n_rows == n // 3 and rep[0].label_values == "0,1"
    first = dedup.dedup_keep_first(df, "employee_id", ["p", "enrolled"]).filter("employee_id = 0").collect()
    assert len(first) == 1 and first[0].p == 0.0
    regs = spark.createDataFrame([("A", 7), ("B", 4)], "region string, hr_outreach_capacity int")
    top = ranking.rank_capacity(df, regs).groupBy("region").count().collect()
    assert {r.region: r["count"] for r in top} == {"A": 7, "B": 4}
