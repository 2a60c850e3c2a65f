import gzip
import os

import pytest
from pyspark.sql import functions as F

from ridemart.operators import checks as Q
from ridemart.operators.models import dim_zones, fact_trips
from ridemart.operators.staging import stage_trips
from ridemart.operators.tables import materialize
from ridemart.plans.pruning import trips_between
from ridemart.session import local_dir
from ridemart.sources import files as io
from ridemart.sources import testbed
from ridemart.specs import GREEN, YELLOW, Config
from tests.conftest import SF_SMALL

FULL = Config(is_test_run=False)
HEADER = ",".join(YELLOW.raw_columns)
LINE = "1,2019-01-01 00:10:00,2019-01-01 00:20:00,1.0,1.5,1,N,100,200,1,10.0,0.5,0.5,2.0,0.0,0.3,13.3,2.5"


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode()
    with (gzip.open(path, "wb") if gz else open(path, "wb")) as f:
        f.write(data)


def test_csv_scan_drops_extra_trailing_column(spark, scratch):
    d = local_dir(scratch("csv"))
    _write(f"{d}/a.csv", f"{HEADER}\n{LINE},EXTRA\n")
    r = io.read_trips_csv(spark, f"{d}/a.csv", YELLOW).first()
    assert r.congestion_surcharge == 2.5 and r.PULocationID == 100


def test_copy_in_rejects_extra_column(spark, scratch):
    d = local_dir(scratch("csv"))
    _write(f"{d}/a.csv", f"{HEADER}\n{LINE},EXTRA\n")
    with pytest.raises(Exception):
        io.copy_in(spark, f"{d}/a.csv", YELLOW.raw_columns, YELLOW.raw_schema).collect()


def test_gzip_and_list_of_globs(spark, scratch):
    d = local_dir(scratch("csv"))
    _write(f"{d}/2019/a.csv.gz", f"{HEADER}\n{LINE}\n", gz=True)
    _write(f"{d}/2020/b.csv", f"{HEADER}\n{LINE}\n")
    df = io.read_trips_csv(spark, [f"{d}/2019/*.csv.gz", f"{d}/2020/*.csv"], YELLOW, repartition=2)
    assert df.count() == 2


def test_bad_number_fails_hard(spark, scratch):
    d = local_dir(scratch("csv"))
    _write(f"{d}/a.csv", f"{HEADER}\n{LINE.replace('10.0', 'ten', 1)}\n")
    with pytest.raises(Exception):
        io.read_trips_csv(spark, f"{d}/a.csv", YELLOW).collect()


def test_csv_to_parquet_forces_double(spark, scratch):
    d = local_dir(scratch("csv"))
    _write(f"{d}/g.csv", "VendorID,ehail_fee\n1,\n2,\n")
    out = io.csv_to_parquet(spark, f"{d}/g.csv", scratch("pq"))
    assert dict(out.dtypes)["ehail_fee"] == "double"


def test_row_index_and_ddl(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    got = io.with_row_index(df, ["v"]).orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(1000)) and [r.v for r in got] == list(range(1000))
    assert io.schema_ddl(df).startswith("v BIGINT")


def test_checks_and_severity(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, None, 1), (2, "b", 9)], "k int, t string, p int")
    parent = spark.createDataFrame([(1,)], "k int")
    rows = Q.run_checks([Q.check_unique(df, "k", "m"), Q.check_not_null(df, "t", "m"),
                         Q.check_relationships(df, "k", parent, "k", "m"),
                         Q.check_accepted_values(df, "p", [1, 2], "m")]).collect()
    assert [r.failures for r in rows] == [1, 1, 1, 2]
    with pytest.raises(Q.CheckFailed):
        Q.run_checks([Q.check_not_null(df, "t", "m", severity="error")])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark, scratch):
    staged = {"Green": stage_trips(testbed.green(spark, SF_SMALL), GREEN, FULL),
              "Yellow": stage_trips(testbed.yellow(spark, SF_SMALL), YELLOW, FULL)}
    fact = fact_trips(staged, dim_zones(testbed.zone_seed(spark, SF_SMALL)))
    fact.count()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    s_plan = staged["Green"]._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in s_plan
    target = scratch("layout")
    day = materialize(testbed.yellow(spark, SF_SMALL), target, YELLOW.pickup)
    q = trips_between(spark.read.parquet(target), YELLOW.pickup, "1996-06-01", "1996-06-30")
    assert day in q.columns
    scan = q._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull" in scan and day in scan.split("PartitionFilters")[1][:200]


def test_layout_write_plans(spark):
    from ridemart.operators.tables import layout_frame

    y = testbed.yellow(spark, SF_SMALL)
    day_only, day = layout_frame(y, YELLOW.pickup)
    plan = day_only._jdf.queryExecution().sparkPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and f"hashpartitioning({day}" in plan
    clustered, _ = layout_frame(y, YELLOW.pickup, ["VendorID"], num_partitions=5)
    plan = clustered._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and f"rangepartitioning({day}" in plan and "xxhash64(" in plan
    assert clustered.rdd.getNumPartitions() == 5      # the requested ranges, not merged by AQE
