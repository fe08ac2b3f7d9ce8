"""SURVEY §5 (e): a run with another partition count gives equal results."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

KEYS = ["rank_capacity", "stratified_split", "metric_auc", "metric_avg_precision", "duplicate_conflicts",
        "dedup_keep_first", "cardinality_top5", "leakage_screen", "fairness_gap", "category_codes",
        "precision_lift_at_k", "split_sample"]


def _rows(spark, key):
    return sorted(map(repr, (tuple(r) for r in E.queries()[key](spark, SF0001).collect())))


@pytest.mark.parametrize("key", KEYS)
def test_same_result_for_other_partition_counts(spark, key):
    conf = spark.conf
    saved = {k: conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        conf.set("spark.sql.adaptive.enabled", "false")
        conf.set("spark.sql.shuffle.partitions", "3")
        a = _rows(spark, key)
        conf.set("spark.sql.shuffle.partitions", "17")
        b = _rows(spark, key)
    finally:
        for k, v in saved.items():
            conf.set(k, v)
    assert a == b
