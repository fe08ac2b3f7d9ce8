"""Exact quantiles through brackets: equal to numpy, whatever the sketch says, with little shuffled."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from benefitlens.operators import quantiles as Q

PROBS = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _frame(spark, seed=3):
    """A nearly unique group, one of a single value, one with a hot value, a small one, a null one."""
    rnd = random.Random(seed)
    rows = [("unique", rnd.gauss(0, 1)) for _ in range(4000)] + [("one", 7.0)] * 900
    rows += [("hot", 5.0 if rnd.random() < 0.4 else rnd.random() * 10) for _ in range(2500)]
    rows += [("small", float(i)) for i in range(3)] + [(None, rnd.random()) for _ in range(700)] + [("hot", None), ("none", None)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(5), rows


def _check(got, rows):
    got = {(r.g, r.prob): r.value for r in got.collect()}
    groups = {g for g, v in rows if v is not None}
    assert set(got) == {(g, p) for g in groups for p in PROBS}
    for g in groups:
        vals = [v for k, v in rows if k == g and v is not None]
        for p in PROBS:
            assert math.isclose(got[g, p], float(np.percentile(vals, p * 100)), rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("accuracy, whole", [(100, 500), (20, 50), (1000, 0), (100, 10**9)])
def test_bracketed_quantiles_equal_numpy(spark, accuracy, whole):
    df, rows = _frame(spark)
    _check(Q.exact_quantiles(df, "v", PROBS, ["g"], accuracy, whole), rows)


def test_a_sketch_that_misses_is_repaired(spark, monkeypatch):
    """Brackets far off their positions are found out by the exact counts and widened."""
    df, rows = _frame(spark)
    honest = Q._sketch

    def wrong(*a):
        s = honest(*a)
        return s.withColumn("_brackets", F.transform("_brackets", lambda b: F.struct(b["at"].alias("at"), (b["hi"] + 1).alias("lo"), (b["hi"] + 2).alias("hi"))))

    monkeypatch.setattr(Q, "_sketch", wrong)
    _check(Q.exact_quantiles(df, "v", PROBS, ["g"], 100, 10), rows)


def test_only_brackets_are_shuffled(spark):
    df = spark.range(0, 60_000, 1, 4).select((F.hash("id") / 7.0).alias("v"), F.lit("a").alias("g"))
    probs = [0.25, 0.5, 0.75]
    rows = df.select("g", F.col("v").alias("_v"))
    sketch = Q._sketch(rows, probs, ["g"], 1000)
    hist = Q.bracketed_histogram(rows, probs, ["g"], sketch, 0)
    assert hist.agg(F.sum("_c")).first()[0] <= len(probs) * (4 / 1000 + 2 / 1000) * 60_000 + 10
    got = {r.prob: r.value for r in Q.exact_quantiles(df, "v", probs, [], 1000, 0).collect()}
    vals = [r.v for r in df.collect()]
    assert all(math.isclose(got[p], float(np.percentile(vals, 100 * p)), rel_tol=1e-12) for p in probs)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert Q.exact_quantiles(df, "v", PROBS, ["g"]).collect() == []
    assert Q.exact_quantiles(df, "v", PROBS).collect() == []
