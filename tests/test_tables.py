import os
from datetime import datetime

from pyspark.sql import functions as F

from ridemart.operators.tables import (
    day_column,
    ensure_table,
    materialize,
    merge_new,
    partition_stats,
    read_target,
    stamp_rows,
    target_name,
    truncate,
)
from ridemart.plans.pipeline import months_between, target_schema
from ridemart.session import local_dir
from ridemart.specs import GREEN, YELLOW
from tests.test_models import raw

DAY = day_column(YELLOW.pickup)


def _batch(spark, rows, name="b.parquet"):
    return stamp_rows(raw(spark, YELLOW, rows), YELLOW, name).withColumn(DAY, F.to_date(YELLOW.pickup))


def _merge(spark, target, batch, prune=True):
    return merge_new(spark, target, batch, prune=(YELLOW.pickup, DAY) if prune else None,
                     partition_by=[DAY], schema=target_schema(YELLOW))


def test_merge_inserts_in_batch_duplicates_then_nothing(spark, scratch):
    target = scratch("t")
    ensure_table(spark, target, target_schema(YELLOW), partition_by=[DAY])
    b = _batch(spark, [{}, {}])  # two identical rows, same id
    assert _merge(spark, target, b) == 2
    assert _merge(spark, target, b) == 0
    assert read_target(spark, target, target_schema(YELLOW)).count() == 2


def test_merge_never_changes_existing_rows(spark, scratch):
    target = scratch("t")
    ensure_table(spark, target, target_schema(YELLOW), partition_by=[DAY])
    _merge(spark, target, _batch(spark, [dict(fare_amount=1.0)], "first"))
    assert _merge(spark, target, _batch(spark, [dict(fare_amount=2.0)], "second")) == 0  # same 5-part id
    r = read_target(spark, target, target_schema(YELLOW)).first()
    assert r.filename == "first" and r.fare_amount == 1.0


def test_merge_pruning_keeps_null_pickup_collisions(spark, scratch):
    """A target row with NULL pickup can share its id with a batch row whose dropoff is NULL."""
    t1 = datetime(2019, 2, 3, 4, 5, 6)
    target = scratch("t")
    ensure_table(spark, target, target_schema(YELLOW), partition_by=[DAY])
    old = _batch(spark, [{YELLOW.pickup: None, YELLOW.dropoff: t1}])
    assert _merge(spark, target, old) == 1
    new = _batch(spark, [{YELLOW.pickup: t1, YELLOW.dropoff: None}])
    assert new.first().unique_row_id == old.first().unique_row_id
    assert _merge(spark, target, new, prune=True) == 0  # same answer as the unpruned merge
    assert _merge(spark, target, new, prune=False) == 0


def test_truncate_keeps_schema(spark, scratch):
    target = scratch("t")
    raw(spark, GREEN, [{}]).write.parquet(target)
    truncate(spark, target)
    df = spark.read.parquet(target)
    assert df.count() == 0 and df.columns == GREEN.raw_columns


def test_materialize_partitioned_and_clustered(spark, scratch):
    rows = [dict(VendorID=v, **{YELLOW.pickup: datetime(2019, 6, d)}) for d in (1, 2, 3) for v in (1, 2, 2)]
    target = scratch("m")
    day = materialize(raw(spark, YELLOW, rows), target, YELLOW.pickup, ["VendorID"])
    dirs = sorted(p for p in os.listdir(local_dir(target)) if p.startswith(day))
    assert dirs == [f"{day}=2019-06-0{d}" for d in (1, 2, 3)]
    stats = partition_stats(spark.read.parquet(target), day, "x").collect()
    assert [(r.partition_id, r.total_rows) for r in stats] == [("20190601", 3), ("20190602", 3), ("20190603", 3)]


def test_names_and_months():
    assert target_name(GREEN, "2019-04") == "green_2019"
    assert target_name(GREEN, "2019-04", per="month") == "green_taxi_2019_04"
    assert months_between("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]
    assert len(months_between("2019-01", "2020-12")) == 24


def test_merge_into_catalog_table_lists_only_selected_days(spark, scratch):
    import io
    from contextlib import redirect_stdout

    name = "merge_catalog_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, target_schema(YELLOW), partition_by=[DAY], location=scratch("tbl"))
    rows = [{YELLOW.pickup: datetime(2019, 6, d), "VendorID": 1} for d in range(1, 21)]
    assert merge_new(spark, name, _batch(spark, rows), prune=(YELLOW.pickup, DAY), partition_by=[DAY],
                     schema=target_schema(YELLOW)) == 20
    more = [{YELLOW.pickup: datetime(2019, 6, d), "VendorID": 1} for d in range(15, 26)]
    assert merge_new(spark, name, _batch(spark, more), prune=(YELLOW.pickup, DAY), partition_by=[DAY],
                     schema=target_schema(YELLOW)) == 5
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 25
    few = read_target(spark, name).where(F.col(DAY).between(F.to_date(F.lit("2019-06-03")),
                                                            F.to_date(F.lit("2019-06-05"))))
    buf = io.StringIO()
    with redirect_stdout(buf):
        few.explain("formatted")
    location = [ln for ln in buf.getvalue().splitlines() if ln.startswith("Location:")][0]
    assert "2019-06-03" in location and "2 entries" in location  # 3 day folders listed, not 25
    assert few.count() == 3 and spark.table(name).count() == 25
    spark.sql(f"DROP TABLE {name}")
