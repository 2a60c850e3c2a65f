"""Inputs that ordinary queries never produce must not lose rows: strays, missing values, duplicates over files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ridemart.operators import ml
from ridemart.operators.checks import check_accepted_values, check_not_null, column_checks
from ridemart.operators.tables import ensure_table, materialize, merge_new, read_target, stamp_rows
from ridemart.plans.pipeline import backfill, load_month, load_month_staged, load_months, target_schema
from ridemart.session import local_dir
from ridemart.sources import files as io
from ridemart.specs import GREEN, YELLOW, Config
from ridemart.streaming.months import stream_months
from tests.test_tables import raw

P = YELLOW.pickup


def trips(spark, days, vendor=1):
    return raw(spark, YELLOW, [dict(VendorID=vendor, PULocationID=i, **{P: d}) for i, d in enumerate(days)])


def test_landing_a_stray_keeps_the_other_month(spark, scratch):
    root = scratch("raw")
    io.land_raw(trips(spark, [datetime(2019, 1, d) for d in range(1, 11)]), root, YELLOW, "2019-01")
    stray = trips(spark, [datetime(2019, 1, 31, 23, 59), datetime(2019, 2, 2), None], vendor=2)
    io.land_raw(stray, root, YELLOW, "2019-02")
    count = lambda m: io.read_trips_parquet(spark, io.raw_month_path(root, YELLOW, m), YELLOW).count()
    assert (count("2019-01"), count("2019-02")) == (10, 3)
    target = scratch("target")
    assert backfill(spark, YELLOW, "2019-01", "2019-02", root, target) == {"2019-01": 10, "2019-02": 3}
    assert backfill(spark, YELLOW, "2019-01", "2019-02", root, target, months_per_load=1) == {"2019-01": 0, "2019-02": 0}


def test_splitting_a_history_never_overwrites_and_keeps_unknown_times(spark, scratch):
    root = scratch("history")
    df = trips(spark, [datetime(2019, 3, 1), None, datetime(2019, 4, 1)])
    io.land_raw(df, root, YELLOW)
    assert io.read_trips_parquet(spark, io.raw_month_path(root, YELLOW, "2019-03"), YELLOW).count() == 2
    with pytest.raises(FileExistsError, match="2019-04"):
        io.land_raw(trips(spark, [datetime(2019, 4, 2), datetime(2019, 5, 2)]), root, YELLOW)
    with pytest.raises(ValueError):
        io.land_raw(trips(spark, [None]), root, YELLOW)


@pytest.mark.parametrize("files", [1, 2, 256])
def test_stream_equals_batch_load_for_any_trigger_size(spark, scratch, files):
    root, a, b = scratch("raw"), scratch("batch"), scratch("stream")
    path = io.raw_month_path(root, YELLOW, "2019-05")
    for _ in range(2):                      # one identical trip in each of two files, and one of its own
        trips(spark, [datetime(2019, 5, 1), datetime(2019, 5, 2)]).coalesce(1).write.mode("append").parquet(path)
    io.land_raw(trips(spark, [datetime(2019, 6, 1), datetime(2019, 5, 1), None]), root, YELLOW, "2019-06")
    got = backfill(spark, YELLOW, "2019-05", "2019-06", root, a)
    assert got == {"2019-05": 4, "2019-06": 3}
    stream_months(spark, YELLOW, root, b, scratch("ckpt"), files_per_trigger=files).awaitTermination()
    rows = lambda t: sorted(map(str, spark.read.schema(target_schema(YELLOW)).parquet(t).collect()))
    assert rows(a) == rows(b)


def test_months_in_one_merge_equal_months_one_by_one(spark, scratch):
    root = scratch("raw")
    io.land_raw(trips(spark, [datetime(2019, 1, 1), datetime(2019, 1, 1)]), root, YELLOW, "2019-01")
    io.land_raw(trips(spark, [datetime(2019, 1, 1), datetime(2019, 2, 1)]), root, YELLOW, "2019-02")   # a trip delivered again
    a, b = scratch("a"), scratch("b")
    assert backfill(spark, YELLOW, "2019-01", "2019-02", root, a) == backfill(spark, YELLOW, "2019-01", "2019-02", root, b, months_per_load=1)


def test_merge_reads_only_the_batch_days(spark, scratch):
    target, day = scratch("days"), f"{P}_day"
    schema = target_schema(YELLOW)
    ensure_table(spark, target, schema, partition_by=[day])
    stamp = lambda df: stamp_rows(df, YELLOW, "f").withColumn(day, F.to_date(P))
    kw = dict(prune=(P, day), partition_by=[day], schema=schema)
    first = trips(spark, [datetime(2019, 1, d) for d in range(1, 29)] + [None])
    assert merge_new(spark, target, stamp(first), **kw) == 29
    batch = trips(spark, [datetime(2019, 1, 1), datetime(2001, 1, 1), datetime(2090, 1, 1), None])
    again = stamp(first).unionByName(stamp(batch))
    assert merge_new(spark, target, again, **kw) == 3      # place 0 on day 1 is known, so is none of the others
    near = read_target(spark, target, schema).where(F.col(day).isin([datetime(2019, 1, 1).date(), datetime(2090, 1, 1).date()]))
    assert len(near.inputFiles()) > 2 and near.count() == 2


def test_row_index_over_a_shuffled_skewed_frame(spark):
    df = spark.range(200_000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("v"), F.col("id").alias("w")).repartition(16, "v")
    for conf in ({}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false"}):
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            for order in (None, ["v"]):
                r = io.with_row_index(df, order).agg(F.count("*"), F.count_distinct("index"), F.min("index"), F.max("index")).first()
                assert tuple(r) == (200_000, 200_000, 0, 199_999)
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)


def test_parquet_month_without_a_column_is_null_there_only(spark, scratch):
    root = scratch("mixed")
    a = trips(spark, [datetime(2019, 1, 1)]).drop("congestion_surcharge")
    b = trips(spark, [datetime(2019, 2, 1)]).withColumn("congestion_surcharge", F.lit(2.5))
    a.write.parquet(f"{root}/month=2019-01")
    b.write.parquet(f"{root}/month=2019-02")
    rows = io.read_trips_parquet(spark, f"{root}/month=2019-*", YELLOW).orderBy(P).collect()
    assert [r.congestion_surcharge for r in rows] == [None, 2.5]


def test_short_csv_rows_fail_and_long_ones_load(spark, scratch):
    def write(name, line):
        path = scratch(name)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(path)
        return path
    n = len(YELLOW.raw_columns)
    head = ",".join(YELLOW.raw_columns)
    full = ['1', '"2019-01-01 00:00:00"'] + [""] * (n - 2)
    ok = write("long", head + "\n" + ",".join(full + ["x", "y"]) + "\n" + ",".join(full))
    assert io.read_trips_csv(spark, ok, YELLOW).count() == 2
    bad = write("short", head + "\n" + ",".join(full[:4]))
    with pytest.raises(Exception, match="fewer than"):
        io.read_trips_csv(spark, bad, YELLOW).count()


def test_parquet_to_csv_takes_a_list(spark, scratch):
    a, b = scratch("a"), scratch("b")
    spark.range(3).write.parquet(a)
    spark.range(4).write.parquet(b)
    assert io.parquet_to_csv(spark, [a, b], scratch("csv")).count() == 7


def test_staged_load_through_a_catalog_table(spark, scratch):
    src, target = scratch("csv"), scratch("target")
    io.write_csv(trips(spark, [datetime(2019, 1, 1), datetime(2019, 1, 2)]), src)
    spark.sql("DROP TABLE IF EXISTS stg_lossless")
    try:
        assert load_month_staged(spark, YELLOW, "2019-01", src, "stg_lossless", target) == 2
        assert load_month_staged(spark, YELLOW, "2019-01", src, "stg_lossless", target) == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS stg_lossless")


def test_numeric_target_types_and_comments(spark, scratch):
    src, target = scratch("src"), "numeric_lossless"
    trips(spark, [datetime(2019, 1, 1)]).withColumn("fare_amount", F.lit(1.25)).write.parquet(src)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    try:
        assert load_months(spark, YELLOW, {"2019-01": src}, target, variant="numeric") == {"2019-01": 1}
        t = spark.table(target)
        kinds = dict(t.dtypes)
        assert (kinds["unique_row_id"], kinds["VendorID"], kinds["fare_amount"], kinds["payment_type"]) == (
            "binary", "string", "decimal(38,9)", "bigint")
        assert len(t.first().unique_row_id) == 16
        said = {c.name: c.description for c in spark.catalog.listColumns(target)}
        for spec in (YELLOW, GREEN):
            assert set(spec.raw_columns) | {"unique_row_id", "filename"} == set(spec.comments)
        assert all(said[c] == YELLOW.comments[c] for c in YELLOW.raw_columns)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {target}")


def test_development_limit_is_opt_in():
    assert Config().is_test_run is False


def test_metrics_outside_their_domain_are_null(spark):
    df = spark.createDataFrame([(1.0, -2.0), (0.5, 0.4)], "tip_amount double, predicted_tip_amount double")
    r = ml.evaluate(df).first()
    assert r.mean_squared_log_error is None and r.mean_absolute_error is not None
    same = ml.evaluate(df.withColumn("tip_amount", F.lit(1.0))).first()
    assert same.r2_score is None and same.explained_variance is None


def test_column_checks_equal_single_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (9, "c"), (9, "c")], "x int, y string")
    both = column_checks(df, "m", {"y": "warn", "x": "error"}, {"x": ([1, 2], "warn")}).collect()
    single = (check_not_null(df, "y", "m").collect() + check_not_null(df, "x", "m", "error").collect()
              + check_accepted_values(df, "x", [1, 2], "m").collect())
    assert both == single


def test_clustered_layout_skips_row_groups(spark, scratch):
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq
    target = scratch("clustered")
    df = spark.range(60_000).select((F.col("id") * 7919 % 3 + 1).alias("VendorID"), F.lit(datetime(2019, 6, 1)).alias(P), F.col("id").cast("string").alias("s"))
    materialize(df, target, P, ["VendorID"], num_partitions=6)
    groups = skipped = 0
    for f in ds.dataset(local_dir(target), format="parquet", partitioning="hive").files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().names.index("VendorID")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups, skipped = groups + 1, skipped + (not s.min <= 1 <= s.max)
    assert spark.read.parquet(target).count() == 60_000 and groups / (groups - skipped) >= 1.27


def test_load_month_counts_repeat_as_zero(spark, scratch):
    src, target = scratch("src"), scratch("target")
    trips(spark, [datetime(2019, 1, 1)]).write.parquet(src)
    assert [load_month(spark, YELLOW, "2019-01", src, target) for _ in range(2)] == [1, 0]
