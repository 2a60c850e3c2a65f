"""Queries compute the trips once and move the line items once (bytes shuffled, spilled and written)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ridemart import registry
from ridemart.plans import pipeline
from ridemart.sources import files as io
from ridemart.sources import testbed
from ridemart.specs import YELLOW
from tests.conftest import SF_CHECK, SF_SMALL
from tests.test_lossless import trips
from tests.test_tables import raw

P = YELLOW.pickup


@pytest.fixture()
def conf(spark):
    """Settings of one test."""
    old = {}

    def set_(**kw):
        for k, v in kw.items():
            key = f"spark.sql.{k.replace('__', '.')}"
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, v)
    yield set_
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def counting(spark, df):
    """The frame and a counter of its rows, each time they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def passed(_):
        seen.add(1)
        return True
    return df.where(F.udf(passed, "boolean").asNondeterministic()(F.col("RatecodeID"))), seen


def rows(df):
    return sorted(map(str, df.collect()))


def test_line_items_are_shuffled_once(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = testbed.yellow(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(l_suppkey" not in plan
    assert plan.count("hashpartitioning(o_custkey") == 1 and "l_orderkey" not in plan.split("hashpartitioning(o_custkey")[1].split("hashpartitioning(c_custkey")[0]


def test_many_suppliers_are_not_broadcast(spark, conf, monkeypatch):
    few = rows(testbed.yellow(spark, SF_SMALL))
    monkeypatch.setattr(testbed, "BROADCAST_SUPPLIERS", 0)
    conf(autoBroadcastJoinThreshold="-1")
    many = testbed.yellow(spark, SF_SMALL)
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert rows(many) == few


@pytest.mark.parametrize("at, query", list(enumerate(
    ["raw_zone", "merge_rerun_count", "load_text_target", "feature_info", "tip_model_explain"], 2)))
def test_trips_are_computed_once(spark, monkeypatch, at, query):
    real = testbed.yellow
    counters = []

    def yellow(spark, sf_dir):
        df, seen = counting(spark, real(spark, sf_dir))
        counters.append(seen)
        return df
    monkeypatch.setattr(testbed, "yellow", yellow)
    registry.QUERIES[query](spark, SF_SMALL + "/" * at).collect()       # a path of its own: nothing landed yet
    assert sum(c.value for c in counters) == real(spark, SF_SMALL).count()


def test_landing_evaluates_once_and_keeps_undated_trips(spark, scratch):
    df, seen = counting(spark, trips(spark, [datetime(2019, 3, 1), None, datetime(2019, 4, 1), None]).coalesce(1).withColumn("RatecodeID", F.lit(1).cast("long")))
    for fmt in ("parquet", "csv"):
        root, before = scratch("once"), seen.value
        io.land_raw(df, root, YELLOW, fmt=fmt)
        assert seen.value - before == 4
        count = lambda m: pipeline.read_month(spark, YELLOW, io.raw_month_path(root, YELLOW, m), fmt).count()
        assert (count("2019-03"), count("2019-04")) == (3, 1)
        with pytest.raises(FileExistsError, match="2019-03"):
            io.land_raw(df, root, YELLOW, fmt=fmt)
        assert io.Files(spark, root).names() == {"yellow"} and (count("2019-03"), count("2019-04")) == (3, 1)


def test_months_apart_compare_no_ids(spark, scratch, monkeypatch):
    root = scratch("apart")
    io.land_raw(trips(spark, [datetime(2019, 1, 1), datetime(2019, 1, 1), datetime(2019, 2, 1)]), root, YELLOW)
    seen, real = [], pipeline.evaluated
    monkeypatch.setattr(pipeline, "evaluated", lambda df, name: seen.append(name) or real(df, name))
    got = pipeline.backfill(spark, YELLOW, "2019-01", "2019-02", root, scratch("target"))
    assert got == {"2019-01": 2, "2019-02": 1} and seen == ["load_batch"]


def test_an_id_shared_with_an_undated_trip_stays_with_the_first_month(spark, scratch):
    root, t = scratch("undated"), datetime(2019, 1, 1)
    io.land_raw(raw(spark, YELLOW, [{P: t, YELLOW.dropoff: None}]), root, YELLOW, "2019-01")
    io.land_raw(raw(spark, YELLOW, [{P: None, YELLOW.dropoff: t}]), root, YELLOW, "2019-02")    # the same parts in the id
    one, two = (pipeline.backfill(spark, YELLOW, "2019-01", "2019-02", root, scratch("t"), months_per_load=n) for n in (1, 2))
    assert one == two


def test_a_hot_zone_is_split(spark, conf, monkeypatch):
    conf(autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="4k", files__maxPartitionBytes="64k")
    got = []
    real = io.with_row_index
    monkeypatch.setattr(io, "with_row_index", lambda df: got.append(df) or real(df))
    registry.q_row_index_scan(spark, SF_CHECK).collect()
    sizes = got[0].groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert sizes[0] > 13 and sizes[1] < sizes[2] / 13, sizes
