"""Joins with hot keys on a dimension too large to broadcast, and on both sides."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from benefitlens.operators import joins


def _sides(spark, right_copies=1):
    rnd = random.Random(3)
    left = [(1 if i % 3 == 0 else 2 if i % 10 == 1 else rnd.choice([None, *range(3, 900)]), i) for i in range(3000)]
    right = [(k, f"v{k}-{c}") for k in range(1, 800) for c in range(right_copies if k < 3 else 1)] + [(None, "none")]
    return (spark.createDataFrame(left, "k long, x long").repartition(8), spark.createDataFrame(right, "k long, v string").repartition(3), left, right)


def _want(left, right, how):
    by_key = {}
    for k, v in right:
        by_key.setdefault(k, []).append(v)
    out = Counter()
    for k, x in left:
        found = by_key.get(k, []) if k is not None else []
        for v in found or ([None] if how == "left" else []):
            out[k, x, v] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("copies, most, salt", [(1, 100_000, 50_000), (7, 5, 100), (1, 0, 40)])
def test_spread_join_equals_join(spark, how, copies, most, salt):
    """Hot keys broadcast, and salted."""
    left, right, l, r = _sides(spark, copies)
    got = joins.spread_join(left, right, "k", how, share=0.05, most_broadcast=most, salt_rows=salt)
    assert got.columns == ["k", "x", "v"]
    assert Counter(map(tuple, got.collect())) == _want(l, r, how)


def test_hot_rows_do_not_meet_in_one_task(spark):
    """A third of all rows on one key of a dimension too large to broadcast: no task above its share."""
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left, right, l, _ = _sides(spark)
        for out in (joins.join_dimension(left, right.filter("k IS NOT NULL"), "k", max_broadcast_rows=10),
                    joins.spread_join(left, right, "k", share=0.05, most_broadcast=0, salt_rows=10)):
            tasks = [r["count"] for r in out.withColumn("t", F.spark_partition_id()).filter("k = 1").groupBy("t").count().collect()]
            assert sum(tasks) == 1000 and max(tasks) < 1000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)


def test_hot_keys_are_few_and_right(spark):
    left, _, l, _ = _sides(spark)
    assert {r.k: r.n for r in joins.hot_keys(left, "k", 0.05).collect()} == {k: n for k, n in Counter(k for k, _ in l).items() if k is not None and n >= 150}
    assert joins.hot_keys(left.limit(0), "k").collect() == []
    assert joins.spread_join(left.limit(0), left.limit(0).withColumnRenamed("x", "y"), "k", "left").collect() == []
