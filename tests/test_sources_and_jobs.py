"""Sources, the shared feature job, scoring edge cases and invariants."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from benefitlens.constants import EXPECTED_FEATURES
from benefitlens.sources import readers
from tests.conftest import SF0001

REGIONS = [("West", 2400, 0.61, 64000.0, 455, 3.1, 15, 17, "High"),
           ("South", 2420, 0.615, 64250.0, 485, 3.35, 35, 22, "MED")]
REG_DDL = ("region string, n_employees_region int, hist_enrollment_rate_region double, avg_salary_region double, "
           "avg_premium_cost_usd int, benefits_broker_rating double, hr_outreach_capacity int, "
           "open_enrollment_window_days int, state_mandate_level string")


def test_csv_reader_null_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="bl-csv-")
    path = os.path.join(d, "emp.csv")
    with open(path, "w") as f:
        f.write("employee_id,age,salary,last_contact_channel,prior_year_enrolled\n")
        f.write("1,30,50000,none,-1\n2,NA,N/A,NULL,1\n3,x,70000.5,,0\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("employee_id", T.LongType()), T.StructField("age", T.IntegerType()),
                           T.StructField("salary", T.DoubleType()), T.StructField("last_contact_channel", T.StringType()),
                           T.StructField("prior_year_enrolled", T.IntegerType())])
    rows = {r.employee_id: r for r in readers.read_csv_typed(spark, path, schema).collect()}
    assert rows[1].last_contact_channel == "none"          # a value, not a null token
    assert rows[2].age is None and rows[2].salary is None and rows[2].last_contact_channel is None
    assert rows[3].age is None and rows[3].salary == 70000.5


def test_validate_records(spark):
    regs = spark.createDataFrame(REGIONS, REG_DDL)
    recs = spark.createDataFrame([(1, "West"), (2, None), (3, "west")], "employee_id int, region string")
    got = {r.employee_id: r.reason for r in readers.validate_records(recs, regs).collect()}
    assert got == {1: None, 2: "missing_region", 3: "unknown_region"}
    with pytest.raises(ValueError):
        readers.validate_records(recs.drop("region"), regs)
    with pytest.raises(ValueError):
        readers.validate_records(recs.limit(0), regs, require_rows=True)


def _edge_records(spark):
    rows = [
        # all-null record (scoring suite): only id, gender, region, prior
        dict(employee_id=99001, gender="Female", region="West", prior_year_enrolled=-1),
        # unseen labels
        dict(employee_id=99002, region="West", employment_type="Consultant", last_contact_channel="Telepathy",
             plan_tier_requested="Platinum", broker_channel="UnknownBroker"),
        # smallest valid record
        dict(employee_id=99003, region="South", age=40, salary=55000.0),
    ]
    ddl = "employee_id int, region string, gender string, prior_year_enrolled int, employment_type string, " \
          "last_contact_channel string, plan_tier_requested string, broker_channel string, age int, salary double"
    cols = [c.split()[0] for c in ddl.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ddl)


def test_preprocess_scoring_edge_cases(spark):
    from benefitlens.plans.features import preprocess_scoring
    regs = spark.createDataFrame(REGIONS, REG_DDL)
    out = preprocess_scoring(_edge_records(spark), regs)
    assert out.columns == ["employee_id", "reason", *EXPECTED_FEATURES]
    rows = {r.employee_id: r for r in out.collect()}
    assert len(rows) == 3
    assert rows[99002].employment_type is None and rows[99002].last_contact_channel_clean == "Unknown"
    assert rows[99002].plan_tier_requested_clean == "Unknown" and rows[99002].broker_channel_clean is None
    assert rows[99001].no_prior_record == 1 and rows[99001].has_application_date == 0
    assert rows[99003].state_mandate_level == "Medium"


def test_model_scores_edge_cases_and_reloads(spark):
    """Invariants of the ML path: probabilities in [0,1], rows kept, forbidden
    columns absent, a reloaded model gives equal scores."""
    import __spark_entry__  # noqa: F401
    from benefitlens import catalog as C
    from benefitlens.plans import modeling
    from benefitlens.plans.features import preprocess_scoring
    from benefitlens.plans.training import split_frames
    e = C._eng(spark, SF0001)
    train, _ = split_frames(e)
    model = modeling.tree_pipeline(train, modeling.gbt(max_iter=5)).fit(train)
    regs = C._reg(spark, SF0001)
    recs = _edge_records(spark).withColumn("region", F.lit("ASIA"))
    scored = modeling.score(model, modeling.prepare(preprocess_scoring(recs, regs)))
    rows = scored.collect()
    assert len(rows) == 3 and all(0.0 <= r.predicted_probability <= 1.0 for r in rows)
    assert all(r.predicted_class == int(r.predicted_probability >= 0.5) for r in rows)
    assert "legacy_propensity_score" not in scored.columns and "age" not in scored.columns
    d = tempfile.mkdtemp(prefix="bl-model-")
    again = modeling.score(modeling.save_and_reload(model, d), modeling.prepare(preprocess_scoring(recs, regs)))
    a = {r.employee_id: r.predicted_probability for r in rows}
    b = {r.employee_id: r.predicted_probability for r in again.collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)
    train.unpersist()


def test_written_fact_fixture_equals_the_view(spark):
    from benefitlens.sources import fixtures
    table = fixtures.emp_raw(spark, SF0001)
    view = fixtures._emp_raw(spark, SF0001)
    assert table.schema.names == view.schema.names
    assert [f.dataType for f in table.schema] == [f.dataType for f in view.schema]
    assert table.exceptAll(view).count() == 0 and view.exceptAll(table).count() == 0
    # the table is a scan of the written files, not the view's joins
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Join" not in plan


def test_fixture_publish_replaces_an_unfinished_folder_and_keeps_a_finished_one(spark):
    from benefitlens.sources.fixtures import _publish
    base = tempfile.mkdtemp(prefix="bl-pub-")
    path = os.path.join(base, "t")
    os.makedirs(path)                       # left behind without _SUCCESS
    _publish(spark, spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    _publish(spark, spark.range(9), path)   # a finished table is kept; the late copy is dropped
    assert spark.read.parquet(path).count() == 5
    assert [n for n in os.listdir(base) if ".tmp-" in n] == []


def test_csv_is_read_as_pandas_reads_it(spark, tmp_path):
    from pyspark.sql import types as T

    from benefitlens.sources import readers
    (tmp_path / "t.csv").write_text('id,note,x\n1,"say ""hi"", ok",1.5\n2,"two\nlines",NA\n3, NA ,n/a\n4,none,\n5,NA, 7\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType()), T.StructField("x", T.DoubleType())])
    got = [tuple(r) for r in readers.read_csv_typed(spark, str(tmp_path / "t.csv"), schema, multi_line=True).orderBy("id").collect()]
    assert got == [(1, 'say "hi", ok', 1.5), (2, "two\nlines", None), (3, " NA ", None), (4, "none", None), (5, None, 7.0)]


def test_a_half_written_model_is_replaced(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from benefitlens.plans import training
    from benefitlens.sources.tables import path_exists
    path = str(tmp_path / "model")
    PipelineModel([]).write().save(path)  # as a job leaves it that was killed before the mark
    assert not path_exists(spark, f"{path}/{training.MODEL_MARK}")
    training.publish_model(spark, PipelineModel([]), path)
    assert path_exists(spark, f"{path}/{training.MODEL_MARK}") and PipelineModel.load(path).stages == []
    training.publish_model(spark, PipelineModel([]), path)  # the first one stays
    assert [p.name for p in tmp_path.iterdir()] == ["model"]
