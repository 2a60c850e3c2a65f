"""A third of all rows on one key: results stay whole and exact, plans pre-reduce before the shuffle."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ridemart.operators.models import monthly_zone_revenue
from ridemart.operators.staging import dedup_trips
from ridemart.operators.tables import day_column, ensure_table, merge_new, read_target, stamp_rows
from ridemart.plans.pipeline import target_schema
from ridemart.specs import YELLOW

T0 = datetime(2019, 1, 1)
N = 30_000


def _skewed(spark):
    """Every third row shares (vendor 1, T0); the rest are distinct keys."""
    df = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.lit(2)).cast("long").alias("VendorID"),
        F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(
            F.lit(T0) + F.make_interval(secs=F.col("id").cast("decimal(18,6)"))).alias(YELLOW.pickup),
        (F.col("id") % 97).cast("double").alias("fare_amount"))
    return df


def test_dedup_hot_key(spark):
    df = _skewed(spark)
    out = dedup_trips(df, ["VendorID", YELLOW.pickup])
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 1 + (N - N // 3)
    hot = out.where(F.col("VendorID") == 1).first()
    assert hot.fare_amount == 0.0  # smallest fare among the hot rows


def test_aggregate_hot_group_is_exact(spark):
    df = _skewed(spark).select(
        F.when(F.col("VendorID") == 1, "HOT").otherwise("cold").alias("pickup_zone"),
        F.col(YELLOW.pickup).alias("pickup_datetime"), F.lit("Yellow").alias("service_type"),
        F.lit("x").alias("tripid"), F.lit(1).alias("passenger_count"),
        *[F.col("fare_amount").cast("decimal(38,9)").alias(c) for c in
          ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
           "improvement_surcharge", "total_amount", "trip_distance")])
    mart = {r.revenue_zone: r for r in monthly_zone_revenue(df).collect()}
    assert mart["HOT"].total_monthly_trips == N // 3
    assert "partial_sum" in monthly_zone_revenue(df)._jdf.queryExecution().sparkPlan().toString()


def test_merge_hot_key(spark, scratch):
    day = day_column(YELLOW.pickup)
    base = {c: None for c in YELLOW.raw_columns}
    rows = spark.range(0, 3000, 1, 4).select(
        *[(F.lit(T0) if c == YELLOW.pickup else F.lit(1).cast("long") if c == "VendorID" else
           F.lit(base[c]).cast(f.dataType)).alias(c) for c, f in zip(YELLOW.raw_columns, YELLOW.raw_schema.fields)])
    batch = stamp_rows(rows, YELLOW, "hot").withColumn(day, F.to_date(YELLOW.pickup))
    target = scratch("hot")
    ensure_table(spark, target, target_schema(YELLOW), partition_by=[day])
    kw = dict(prune=(YELLOW.pickup, day), partition_by=[day], schema=target_schema(YELLOW))
    assert merge_new(spark, target, batch, **kw) == 3000  # all in-batch copies of a new key
    assert merge_new(spark, target, batch, **kw) == 0
    assert read_target(spark, target, target_schema(YELLOW)).count() == 3000


def test_identical_rows_spread_over_range_tasks(spark):
    from ridemart.sources.files import with_row_index
    df = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # measure the partitioner itself
    try:
        out = with_row_index(df, ["v"])
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in per_task) < 3000  # the 3000 identical rows do not share one task
    got = out.orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(9000))
    assert [r.v for r in got] == sorted(r.v for r in df.collect())


def test_clustered_write_splits_hot_day_over_requested_ranges(spark, scratch):
    import glob
    from datetime import datetime

    from ridemart.operators.tables import materialize
    from ridemart.session import local_dir
    from ridemart.specs import YELLOW
    from tests.test_models import raw

    hot = [dict(VendorID=1, **{YELLOW.pickup: datetime(2019, 6, 1), "trip_distance": float(i)}) for i in range(3000)]
    cold = [dict(VendorID=2, **{YELLOW.pickup: datetime(2019, 6, d)}) for d in range(2, 12)]
    target = scratch("clustered")
    day = materialize(raw(spark, YELLOW, hot + cold), target, YELLOW.pickup, ["VendorID"], num_partitions=4)
    files = glob.glob(f"{local_dir(target)}/*/*.parquet")
    hot_files = [f for f in files if f"/{day}=2019-06-01/" in f]
    assert len(hot_files) > 1                 # the hot (day, vendor) group is split over tasks
    assert len(files) <= 11 + 4               # one file per day, plus at most one split per range
    assert spark.read.parquet(target).count() == 3010
