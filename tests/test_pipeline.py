from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ridemart.operators.checks import CheckFailed
from ridemart.plans.pipeline import backfill, build, load_month, load_month_staged, target_schema
from ridemart.sources import files as io
from ridemart.specs import GREEN, YELLOW, Config
from ridemart.streaming.months import stream_months
from tests.test_models import raw, zones


def _months(spark):
    rows = [dict(fare_amount=float(i), **{YELLOW.pickup: datetime(2019, m, 1 + i), YELLOW.dropoff: datetime(2019, m, 2 + i)})
            for m in (1, 2, 3) for i in range(5)]
    return raw(spark, YELLOW, rows)


def test_load_month_is_idempotent(spark, scratch):
    root, target = scratch("raw"), scratch("target")
    io.land_raw(_months(spark), root, YELLOW)
    src = io.raw_month_path(root, YELLOW, "2019-02")
    assert load_month(spark, YELLOW, "2019-02", src, target) == 5
    assert load_month(spark, YELLOW, "2019-02", src, target) == 0
    t = spark.read.schema(target_schema(YELLOW)).parquet(target)
    assert {r.filename for r in t.collect()} == {"yellow_tripdata_2019-02.parquet"}


def test_backfill_in_order_and_rerun(spark, scratch):
    root, target = scratch("raw"), scratch("target")
    io.land_raw(_months(spark), root, YELLOW)
    assert backfill(spark, YELLOW, "2019-01", "2019-03", root, target) == {"2019-01": 5, "2019-02": 5, "2019-03": 5}
    assert backfill(spark, YELLOW, "2019-01", "2019-03", root, target) == {"2019-01": 0, "2019-02": 0, "2019-03": 0}


def test_staged_database_load(spark, scratch):
    root, staging, target = scratch("raw"), scratch("staging"), scratch("target")
    io.land_raw(_months(spark), root, YELLOW, fmt="csv")
    src = f"{root}/yellow/month=2019-01"
    assert load_month_staged(spark, YELLOW, "2019-01", src, staging, target) == 5
    assert load_month_staged(spark, YELLOW, "2019-01", src, staging, target) == 0
    assert spark.read.parquet(staging).count() == 5  # staging holds the last month only


def test_stream_restart_continues(spark, scratch):
    root, target, ckpt = scratch("raw"), scratch("target"), scratch("ckpt")
    df = _months(spark)
    io.land_raw(df.where(F.month(YELLOW.pickup) < 3), root, YELLOW)
    stream_months(spark, YELLOW, root, target, ckpt).awaitTermination()
    read = lambda: spark.read.schema(target_schema(YELLOW)).parquet(target)
    assert read().count() == 10
    io.land_raw(df.where(F.month(YELLOW.pickup) == 3), root, YELLOW)  # a new month lands
    stream_months(spark, YELLOW, root, target, ckpt).awaitTermination()
    assert read().count() == 15
    stream_months(spark, YELLOW, root, target, ckpt).awaitTermination()  # nothing new
    assert read().count() == 15


def test_build_runs_checks_and_raises_on_error(spark, scratch):
    g = raw(spark, GREEN, [dict(PULocationID=1, payment_type=None)])
    y = raw(spark, YELLOW, [dict(PULocationID=1)])
    b = build(spark, {GREEN: g, YELLOW: y}, zones(spark), scratch("build"), Config(is_test_run=False))
    res = {(r.column_name, r.check_name): r.failures for r in b.checks.collect()}
    assert res[("payment_type", "accepted_values")] == 1  # the 0 made from NULL
    assert res[("revenue_monthly_total_amount", "not_null")] == 0
    bad = raw(spark, GREEN, [dict(PULocationID=1, total_amount=None)])
    with pytest.raises(CheckFailed):
        build(spark, {GREEN: bad}, zones(spark), scratch("build"), Config(is_test_run=False))
