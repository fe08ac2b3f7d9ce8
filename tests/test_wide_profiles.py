"""Top values and cardinality of wide text columns, co-missing pairs of many columns."""
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from benefitlens.operators import heavy, profile


def _rows(n, seed=2):
    """A nearly unique column, a skewed one, a flat one with ties, one of nulls mostly."""
    rnd = random.Random(seed)
    return [(f"id{rnd.randrange(10**6)}" if rnd.random() < 0.97 else rnd.choice(["zz", "yy"]),
             f"w{int(rnd.paretovariate(0.7))}", f"t{i % 40:02d}", None if rnd.random() < 0.8 else f"n{i % 3}") for i in range(n)]


COLUMNS = ["unique", "skewed", "flat", "holes"]


def _top(rows, i, k=5):
    counts = Counter(r[i] for r in rows)
    return [(v, n, j + 1) for j, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k])]


@pytest.mark.parametrize("probed, top", [(300, 5), (10**9, 5), (1, 3)])
def test_top_values_are_exact_whatever_was_probed(spark, monkeypatch, probed, top):
    monkeypatch.setattr(heavy, "PROBED", probed)
    rows = _rows(3000)
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = heavy.top_values(df, COLUMNS, top).collect()
    for i, c in enumerate(COLUMNS):
        assert sorted(((r.value, r["count"], r["rank"]) for r in got if r.column_name == c), key=lambda x: x[2]) == _top(rows, i, top)


def test_rare_values_are_dropped_before_the_count(spark):
    rows = _rows(6000)
    long = heavy._long(spark.createDataFrame(rows, COLUMNS).repartition(4), ["unique"])
    assert heavy.candidates(long, 2).count() < len(rows) / 2


def test_cardinality_report_by_both_ways(spark):
    rows = _rows(2500)
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    want = sorted(map(tuple, profile.cardinality_top5(df).select("column_name", "value", "count", "rank", "n_unique").collect()), key=repr)
    wide = profile.cardinality_top5(df, narrow=30).select("column_name", "value", "count", "rank", "n_unique").collect()
    assert sorted(map(tuple, wide), key=repr) == want
    assert {(r[0], r[4]) for r in want} == {(c, len({x[i] for x in rows} - {None})) for i, c in enumerate(COLUMNS)}
    near = profile.cardinality_top5(df, exact=False, rsd=0.02).collect()
    exact = {r[0]: r[4] for r in want}
    assert all(abs(r.n_unique - exact[r.column_name]) <= 0.06 * exact[r.column_name] + 1 and r.relative_sd == 0.02 for r in near)
    assert sorted(((r.column_name, r.value, r["count"], r["rank"]) for r in near), key=repr) == [r[:4] for r in want]


def test_top_values_of_nothing(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
    assert heavy.top_values(df, COLUMNS).collect() == []


def test_co_missing_pairs_of_five_hundred_columns(spark):
    m, rnd = 500, random.Random(9)
    names = [f"c|{i:03d}" for i in range(m)]
    holes = [sorted(rnd.sample(range(m), rnd.choice([0, 1, 2, 7]))) for _ in range(60)] + [list(range(0, m, 9))] * 3
    df = spark.createDataFrame([(h,) for h in holes], "h array<int>")
    df = df.select(*[F.when(~F.array_contains("h", i), F.lit(1)).alias(c) for i, c in enumerate(names)])
    want = Counter(p for h in holes for p in combinations(h, 2))
    got = {(r.column_a, r.column_b): r.both_missing for r in profile.missing_cooccur(df, names).collect()}
    assert len(got) == m * (m - 1) // 2
    assert {k: n for k, n in got.items() if n} == {(names[a], names[b]): n for (a, b), n in want.items()}
