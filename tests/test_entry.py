import __spark_entry__ as E
from ridemart.operators import ml
from ridemart.registry import fixed_terms
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["revenue_zone", "revenue_month", "service_type"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = set(E.QUERIES) - set(E.oracle_sql())
    assert rows_only == set()


def test_model_explanations_sum_to_prediction(spark):
    from pyspark.sql import functions as F
    from ridemart.sources import testbed
    ft = ml.ml_table(testbed.yellow(spark, SF_SMALL))
    model = ml.train_tip_model(ft)
    train, _ = ml.auto_split(ft.where(F.col("tip_amount").isNotNull()))
    terms = ml.linear_terms(model, train)
    x = ml.predict(model, ft).withColumn("_i", F.monotonically_increasing_id())
    e = ml.explain_predict(terms, x.drop(ml.PREDICTION)).select("_i", F.col(ml.PREDICTION).alias("e"))
    diff = x.join(e, "_i").agg(F.max(F.abs(F.col(ml.PREDICTION) - F.col("e")))).first()[0]
    assert diff < 1e-9
    assert len(fixed_terms().numeric) == 4


def test_trials_sampling():
    t = ml.sample_trials(5, seed=1)
    assert len(t) == 5 and all(0 <= l1 <= 20 and l2 in (0, 0.1, 1, 10) for l1, l2 in t)
    assert ml.to_spark_reg(0, 0) == (0.0, 0.0) and ml.to_spark_reg(1, 3) == (4, 0.25)
