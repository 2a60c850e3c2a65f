from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.operators.models import dim_zones, fact_trips, monthly_zone_revenue, union_services
from ridemart.operators.staging import dedup_trips, stage_trips
from ridemart.specs import GREEN, YELLOW, ZONE_SEED, Config

FULL = Config(is_test_run=False)
T0 = datetime(2019, 1, 1, 8, 0, 0)


def raw(spark, spec, rows):
    base = {c: None for c in spec.raw_columns}
    base.update(VendorID=1, PULocationID=1, DOLocationID=2, fare_amount=10.0, total_amount=12.0,
                passenger_count=1.0, trip_distance=1.5, payment_type=1)
    base[spec.pickup] = T0
    base[spec.dropoff] = T0
    data = [tuple({**base, **r}[c] for c in spec.raw_columns) for r in rows]
    return spark.createDataFrame(data, spec.raw_schema)


def zones(spark):
    rows = [(1, "Queens", "A", "Boro Zone"), (2, "Manhattan", "B", "Yellow Zone"),
            (3, "Queens", "A", "Boro Zone"), (264, "Unknown", "NV", "N/A")]
    return spark.createDataFrame(rows, ZONE_SEED)


def test_dim_zones_replaces_boro(spark):
    got = {r.locationid: r.service_zone for r in dim_zones(zones(spark)).collect()}
    assert got[1] == "Green Zone" and got[2] == "Yellow Zone"


def test_stage_casts_and_defaults(spark):
    df = raw(spark, GREEN, [dict(payment_type=None, passenger_count=2.5, trip_type=2)])
    r = stage_trips(df, GREEN, FULL).first()
    assert r.payment_type == 0 and r.payment_type_description == "EMPTY"
    assert r.passenger_count == 3 and r.trip_type == 2
    assert r.trip_distance == Decimal("1.500000000")
    y = stage_trips(raw(spark, YELLOW, [{}]), YELLOW, FULL).first()
    assert y.trip_type == 1 and y.ehail_fee == Decimal("0E-9")


def test_stage_drops_null_vendor_and_dedups(spark):
    df = raw(spark, GREEN, [dict(VendorID=None), dict(fare_amount=5.0), dict(fare_amount=3.0),
                            dict(fare_amount=None)])
    out = stage_trips(df, GREEN, FULL).collect()
    assert len(out) == 1
    assert out[0].fare_amount is None  # NULLs first in the tie-break order


def test_dev_limit_flag(spark):
    df = raw(spark, GREEN, [dict(**{GREEN.pickup: datetime(2019, 1, 1, 0, i)}) for i in range(30)])
    assert stage_trips(df, GREEN, Config(is_test_run=True, dev_limit=10)).count() == 10
    assert stage_trips(df, GREEN, FULL).count() == 30


def test_unparseable_timestamp_fails(spark):
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == GREEN.pickup else f.dataType)
                           for f in GREEN.raw_schema.fields])
    row = {c: None for c in GREEN.raw_columns}
    row.update(VendorID=1, **{GREEN.pickup: "not a time"})
    df = spark.createDataFrame([tuple(row[c] for c in GREEN.raw_columns)], schema)
    with pytest.raises(Exception):
        stage_trips(df, GREEN, FULL).collect()


def test_fact_drops_unknown_and_missing_zones(spark):
    g = raw(spark, GREEN, [dict(PULocationID=1, DOLocationID=2),
                           dict(PULocationID=264, DOLocationID=2, **{GREEN.pickup: datetime(2019, 1, 2)}),
                           dict(PULocationID=99, DOLocationID=2, **{GREEN.pickup: datetime(2019, 1, 3)}),
                           dict(PULocationID=None, DOLocationID=2, **{GREEN.pickup: datetime(2019, 1, 4)})])
    staged = {"Green": stage_trips(g, GREEN, FULL)}
    fact = fact_trips(staged, dim_zones(zones(spark))).collect()
    assert len(fact) == 1 and fact[0].pickup_zone == "A" and fact[0].service_type == "Green"


def test_mart_all_null_sum_and_shared_names(spark):
    g = raw(spark, GREEN, [dict(PULocationID=1), dict(PULocationID=3, **{GREEN.pickup: datetime(2019, 1, 5)})])
    y = raw(spark, YELLOW, [dict(PULocationID=1)])
    staged = {"Green": stage_trips(g, GREEN, FULL), "Yellow": stage_trips(y, YELLOW, FULL)}
    mart = {r.service_type: r for r in monthly_zone_revenue(fact_trips(staged, dim_zones(zones(spark)))).collect()}
    assert mart["Green"].revenue_monthly_ehail_fee is None  # all-NULL group
    assert mart["Green"].total_monthly_trips == 2  # zones 1 and 3 share the name 'A'
    assert mart["Green"].revenue_month == datetime(2019, 1, 1)
    assert mart["Yellow"].revenue_monthly_ehail_fee == Decimal("0E-9")


def test_union_is_by_name(spark):
    a = stage_trips(raw(spark, GREEN, [{}]), GREEN, FULL)
    b = stage_trips(raw(spark, YELLOW, [{}]), YELLOW, FULL)
    u = union_services({"Green": a, "Yellow": b.select(*reversed(b.columns))})
    assert sorted(r.service_type for r in u.collect()) == ["Green", "Yellow"]
    assert u.where(F.col("fare_amount").isNull()).count() == 0


def test_dedup_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([Row(k=1, a=None), Row(k=1, a=2), Row(k=2, a=5)])
    out = sorted((r.k, r.a) for r in dedup_trips(df, ["k"]).collect())
    assert out == [(1, None), (2, 5)]
