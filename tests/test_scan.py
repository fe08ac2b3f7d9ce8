"""The distributed scan: offsets of many slices, ranks of hot groups."""
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from benefitlens.operators import ranking
from benefitlens.operators.prefix import numbered_slices, ranks_within, slice_offsets
from tests.conftest import SF0001
from tests.test_plans import plan


def test_offsets_of_ten_thousand_slices(spark):
    """Three groups over 10,000 slices, one of them in every slice, and no window over more than a block of slices."""
    t = spark.range(10_000).select(F.col("id").alias("_slice"), F.explode(F.array(F.lit("a"), F.when(F.col("id") % 2 == 0, F.lit("b")), F.lit(None).cast("string"))).alias("g"), (F.col("id") % 7).alias("n"))
    t = t.filter("g IS NOT NULL OR _slice % 3 = 0").groupBy("_slice", "g").agg(F.sum("n").alias("n"))
    before = {}
    for r in sorted(t.collect(), key=lambda r: r._slice):
        before.setdefault(r.g, []).append((r._slice, r.n))
    got = slice_offsets(t, ["n"], ["g"], slices=10_000)
    rows = {(r.g, r._slice): (r.n_before, r.n_total) for r in got.collect()}
    assert len(rows) == t.count()
    for g, slices in before.items():
        total = 0
        for s, n in slices:
            assert rows[g, s] == (total, sum(x for _, x in slices))
            total += n
    blocks = got.groupBy("g", F.floor(F.col("_slice") / 100)).count().agg(F.max("count")).first()[0]
    assert blocks <= 100
    p = plan(got)
    assert "collect_list" not in p and "_slice_block" in p


def _rows(n, seed):
    rnd = random.Random(seed)
    return [(i, "hot" if rnd.random() < 0.9 else rnd.choice(["N", "S", None]), round(rnd.random(), 2), i % 2) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_ranks_equal_row_number(spark, slices):
    rows = _rows(1500, 4)
    df = spark.createDataFrame(rows, "employee_id int, region string, p double, enrolled int")
    got = ranks_within(df, ["region"], [F.col("p").desc(), F.col("employee_id").asc()], slices=slices).collect()
    assert len(got) == len(rows)
    for g in {r[1] for r in rows}:
        want = [r[0] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))]
        assert [r.employee_id for r in sorted((r for r in got if r.region == g), key=lambda r: r["rank"])] == want
        assert sorted(r["rank"] for r in got if r.region == g) == list(range(1, len(want) + 1))


def test_ranks_of_repeated_rows_nulls_and_nothing(spark):
    rows = [(1, "a", 0.5)] * 40 + [(2, "a", None), (None, "a", 0.7), (None, None, None)]
    df = spark.createDataFrame(rows, "employee_id int, region string, p double")
    got = ranks_within(df, ["region"], [F.col("p").desc(), F.col("employee_id").asc()], slices=5).collect()
    a = sorted((r for r in got if r.region == "a"), key=lambda r: r["rank"])
    assert [r["rank"] for r in a] == list(range(1, 43)) and a[0].p == 0.7 and a[-1].p is None
    assert [r["rank"] for r in got if r.region is None] == [1]
    assert ranks_within(df.limit(0), ["region"], [F.col("p").desc()]).collect() == []


def test_uncapped_hot_region_spreads_over_the_slices(spark):
    rows = _rows(6000, 8)
    df = spark.createDataFrame(rows, "employee_id int, region string, p double, enrolled int")
    sliced = numbered_slices(df, [F.col("region"), F.col("p").desc(), F.col("employee_id")], 12)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 11 and max(sizes) < 2 * len(rows) / 12
    regs = spark.createDataFrame([("N", 5)], "region string, hr_outreach_capacity int")
    got = ranking.rank_capacity(df, regs)
    for g, most in (("hot", None), ("S", None), (None, None), ("N", 5)):
        want = [r[0] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))][:most]
        assert [r.employee_id for r in sorted((r for r in got.collect() if r.region == g), key=lambda r: r["rank"])] == want


def test_no_whole_region_is_a_windows_work(spark):
    """Where a window partitions by region alone, a limit has cut each map task's rows before."""
    p = E.queries()["rank_capacity"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in p.splitlines() if "Window [row_number" in line]
    limits = [line for line in p.splitlines() if "WindowGroupLimit" in line]
    assert len(windows) == 1 and len(limits) == 2
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    df = spark.createDataFrame(_rows(200, 1), "employee_id int, region string, p double, enrolled int")
    regs = spark.createDataFrame([("hot", 50), ("N", 50), ("S", 50)], "region string, hr_outreach_capacity int")
    spark.conf.set(key, "4")
    try:
        p = ranking.rank_capacity(df, regs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert "Window [row_number" not in p
