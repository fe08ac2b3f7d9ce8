"""Adaptive buckets of the split: hot ids, identical rows, forced small widths."""
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from benefitlens.operators import split


def _frame(spark, seed=1):
    """A third of the rows on one id with different contents, a tenth identical, some without label or id."""
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 1), rnd.random()) for i in range(300)] + [(10_000, 1, rnd.random()) for _ in range(250)]
    rows += [(20_000, 0, 0.5)] * 120 + [(None, 1, 0.1), (5, None, 0.2)] * 3
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "employee_id long, enrolled int, v double").repartition(6), rows


def _ranks(df, **k):
    return sorted((r.employee_id, r.enrolled, r.v, r.class_rank) for r in split.class_rank(df, **k).filter("class_rank IS NOT NULL").collect())


@pytest.mark.parametrize("digits, limit", [(1, 10), (2, 25), (4, 8), (1, 10**6)])
def test_ranks_do_not_depend_on_buckets(spark, digits, limit):
    df, rows = _frame(spark)
    got = _ranks(df, digits=digits, limit=limit)
    assert got == _ranks(df.repartition(3))
    by_class = defaultdict(list)
    for i, y, v, rank in got:
        by_class[y].append((rank, hashlib.md5(f"42:{i}".encode()).hexdigest()))
    for y, ranks in by_class.items():
        ranks.sort()
        assert [r for r, _ in ranks] == list(range(sum(1 for i, c, _ in rows if c == y and i is not None)))
        assert [h for _, h in ranks] == sorted(h for _, h in ranks)


@pytest.mark.parametrize("digits, limit", [(1, 10), (4, 20)])
def test_no_bucket_is_above_the_limit(spark, digits, limit):
    """Identical rows come apart in runs of a partition; everything else below the limit."""
    df, rows = _frame(spark)
    r, sizes = split.buckets(df, digits=digits, limit=limit)
    held = {(x.enrolled, x._b): x["count"] for x in r.filter("enrolled IS NOT NULL AND _b IS NOT NULL").groupBy("enrolled", "_b").count().collect()}
    assert held == {(x.enrolled, x._b): x._nb for x in sizes.collect()}
    assert max(held.values()) <= limit
    names = sorted({b for _, b in held})
    assert not any(b != a and b.startswith(a) for a, b in zip(names, names[1:]) if {c for c, n in held if n == a} & {c for c, n in held if n == b})


def test_a_split_of_a_hot_id_keeps_sizes(spark, monkeypatch):
    monkeypatch.setattr(split.buckets, "__defaults__", ("enrolled", "employee_id", 42, 1, 15))
    monkeypatch.setattr(split.class_rank, "__defaults__", ("enrolled", "employee_id", 42, False, 1, 15))
    df, rows = _frame(spark)
    got = split.stratified_split(df).groupBy("split").agg(F.count("*").alias("n")).collect()
    n = sum(1 for i, y, _ in rows if i is not None and y is not None)
    assert {r.split: r.n for r in got} == {"test": -(-n // 5), "train": n - -(-n // 5), None: 6}
