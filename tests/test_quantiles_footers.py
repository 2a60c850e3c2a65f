"""Exact medians, metadata-only answers, one-scan checks, optimality, streamed scores, CSV line widths."""

import io as pyio
import math
import os
from contextlib import redirect_stdout

import duckdb
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ridemart.operators import checks as Q
from ridemart.operators import ml, quantiles
from ridemart.plans import footers
from ridemart.session import local_dir
from ridemart.sources import files as io
from ridemart.specs import YELLOW


def plan(df) -> str:
    buf = pyio.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# ---- exact quantiles ---------------------------------------------------------------------

def test_medians_of_a_million_skewed_rows(spark, scratch, monkeypatch):
    """Heavy ties, huge outliers, NULLs, negative numbers; few values may be fetched, so the search has to narrow."""
    x = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.pow(F.lit(10.0), (F.xxhash64("id") % 300).cast("double") / 10)).alias("tied"),
        (F.xxhash64("id") / 1e12).alias("spread"),
        F.when(F.col("id") % 10 < 7, None).otherwise(F.exp((F.xxhash64("id", F.lit(1)) % 700).cast("double"))).alias("nulls"),
        F.lit(3.5).alias("constant"), F.lit(None).cast("double").alias("nothing"))
    path = scratch("m")
    x.write.parquet(path)
    x = spark.read.parquet(path)
    got = {q: quantiles.exact_quantiles(x, {c: F.col(c) for c in x.columns}, q, max_values=300) for q in (0.5, 0.01)}
    con = duckdb.connect()
    for q, found in got.items():
        want = con.execute(f"SELECT {', '.join(f'quantile_disc({c}, {q}) AS {c}' for c in x.columns)} FROM '{local_dir(path)}/*.parquet'").fetchone()
        assert tuple(found.values()) == want


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [3.0, 1.0, 2.0], [None, 5.0], [-0.0, 0.0], [math.nan, 1.0, 2.0], [math.nan, math.nan, 1.0],
                                    [math.inf, -math.inf, 1.0, 1.0], []])
def test_medians_of_few_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.exact_quantiles(df, {"v": F.col("v")})["v"]
    some = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    want = some[max(0, math.ceil(len(some) / 2) - 1)] if some else None
    assert got == want or (got is not None and math.isnan(got) and math.isnan(want))


def test_a_missed_estimate_is_made_up_for(spark, monkeypatch):
    """However bad the estimates are, every round keeps the rank inside."""
    df = spark.range(5_000).select((F.xxhash64("id") % 100_000).cast("double").alias("v"))
    real = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, p, a: real(c, [0.9, 0.95], a))
    values = sorted(r.v for r in df.collect())
    assert quantiles.exact_quantiles(df, {"v": F.col("v")}, max_values=50)["v"] == values[2499]


# ---- footers -----------------------------------------------------------------------------

@pytest.fixture()
def daily(spark, scratch):
    path = scratch("daily")
    (spark.range(5_000).select(F.expr("timestamp_seconds(1577836800 + id * 1000)").alias("ts"), (F.col("id") % 977 * 1.5 - 3).alias("total_amount"))
     .union(spark.createDataFrame([(None, 5000.0)], "ts timestamp, total_amount double"))
     .withColumn("ts_day", F.to_date("ts")).write.partitionBy("ts_day").parquet(path))
    return path


def test_counts_come_from_footers(spark, daily):
    stats = footers.partition_counts(spark, daily, "ts_day", "t")
    text = plan(stats)
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [ts_day]" in text and "ReadSchema: struct<ts_day:date,count(*):bigint>" in text
    df = spark.read.parquet(daily)
    from ridemart.operators.tables import partition_stats
    assert stats.collect() == partition_stats(df, "ts_day", "t").collect()
    total = footers.table_rows(spark, daily)
    assert "PushedAggregation: [COUNT(*)]" in plan(total) and total.first().row_count == 5_001


def test_extent_reads_two_days(spark, daily):
    out = footers.extent(spark, daily, "ts", "ts_day")
    df = spark.read.parquet(daily)
    assert tuple(out.first()) == tuple(df.agg(F.max("ts"), F.min("ts"), F.max("total_amount")).first())
    assert "PartitionFilters: [ts_day" in plan(out) or "ts_day#" in plan(out)
    read = out._jdf.queryExecution().executedPlan().toString()
    assert "2020-01-01" in read and "2020-02-27" in read
    # the parent session's settings stay as they were
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList") and spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# ---- checks ------------------------------------------------------------------------------

def test_one_scan_answers_all_checks(spark, scratch):
    path = scratch("c")
    rows = [("a", 1, 1, 1), ("a", 2, 9, 0), ("b", None, None, None), (None, 9, 1, 7), (None, 9, 2, 7), ("c", 3, 3, 6), ("c", 3, 3, 6), ("c", 3, 3, 6)]
    spark.createDataFrame(rows, "k string, pu int, `do` int, p int").write.parquet(path)
    df, zones = spark.read.parquet(path), spark.createDataFrame([(1,), (2,), (3,), (3,)], "z int")
    got = Q.table_checks(df, "m", {"k": "warn"}, {"k": "error", "p": "warn"}, {"p": ([1, 6], "warn")},
                         {"pu": (zones, "z", "warn"), "do": (zones, "z", "error")})
    want = [Q.check_unique(df, "k", "m"), Q.check_not_null(df, "k", "m", "error"), Q.check_not_null(df, "p", "m"),
            Q.check_accepted_values(df, "p", [1, 6], "m"), Q.check_relationships(df, "pu", zones, "z", "m"),
            Q.check_relationships(df, "do", zones, "z", "m", "error")]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(w.first()) for w in want)
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet") == 1
    assert [r.failures for r in Q.table_checks(df.limit(0), "m", {"k": "warn"}, {"k": "warn"}, {"p": ([1], "warn")}, {"pu": (zones, "z", "warn")}).collect()] == [0] * 4


# ---- optimality ----------------------------------------------------------------------------

def test_certificate_tells_an_optimum_from_its_neighbours(spark):
    import random
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 3), float(rng.random() < 0.3)
        rows.append((Vectors.dense(a, b, c, 1.0), 2 * a - 0.5 * b + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, ["features", "tip_amount"])
    for reg, mix in ((0.3, 1.0), (0.3, 0.4), (0.5, 0.0), (50.0, 1.0)):
        model = ml.regression(reg, mix).fit(df)
        exact = ml.optimality(model, df)
        assert exact["violation"] < 1e-5 and exact["intercept"] < 1e-9
        other = ml.regression(reg * 1.05, mix).fit(df)          # the optimum of another penalty is none of this one
        other.set(other.regParam, reg)
        if exact["nonzero"]:
            assert ml.optimality(other, df)["violation"] > 1e-3
    assert exact["nonzero"] == 0


# ---- streamed scores -----------------------------------------------------------------------

def test_streamed_scores_once_each(spark, scratch):
    table = spark.createDataFrame([(float(i % 3), 1.0, str(i % 4), "1", str(i % 2), 10.0 + i, 0.0, 0.1 * (i % 5)) for i in range(60)],
                                  "passenger_count double, trip_distance double, PULocationID string, DOLocationID string, payment_type string, "
                                  "fare_amount double, tolls_amount double, tip_amount double").withColumn("passenger_count", F.col("passenger_count").cast("long"))
    model = ml.train_tip_model(table)
    req = table.select(F.to_json(F.struct(F.array(F.struct(*ml.FEATURE_SCHEMA.fieldNames())).alias("instances"))).alias("value"))
    files, out, ckpt = scratch("req"), scratch("out"), scratch("ckpt")
    req.limit(40).repartition(4).write.text(files)
    for n in (40, 40):
        ml.stream_scores(model, files, out, ckpt, spark, files_per_trigger=1).awaitTermination()
        assert spark.read.parquet(out).count() == n
    req.limit(7).write.mode("append").text(files)
    ml.stream_scores(model, files, out, ckpt, spark).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 47
    batch = ml.score_instances(model, spark.read.text(files), "value")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(got.columns).collect()))


# ---- strict CSV rows -------------------------------------------------------------------------

LINES = ['1,2,3', 'a,"b,c",d', '"a ""b"" c",x', '"a ""b, c""",x', '"q\\",r",s,t', '"tail\\\\",u', '"a" ,b', '"a"x,b,c', '"",""', '"a,b', 'a"b,c"d,e',
         '"a\\"b","c""d",e', ' "a,b",c', '"x, ""y"", z","1,5",w', '"only one, value"']


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_values_in_line_counts_as_the_parser_does(spark, scratch, escape):
    path = scratch("lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    wide = spark.read.schema(", ".join(f"c{i} string" for i in range(9))).option("escape", escape).option("nullValue", "\0").option("emptyValue", "").csv(path)
    counted = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in LINES], "value string")
               .select("value", io.values_in_line(F.col("value"), escape)).collect()}
    parsed = [sum(v is not None for v in r) for r in wide.collect()]      # (an empty value without quotes would be NULL)
    assert {x: counted[x] for x in LINES} == dict(zip(LINES, parsed))


def _csv(spark, scratch, *rows):
    path = local_dir(scratch("f")) + ".csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(YELLOW.raw_columns) + "\n" + "\n".join(rows) + "\n")
    return path


def _row(flag):
    values = {c: "1" for c in YELLOW.raw_columns}
    values |= {YELLOW.pickup: "2019-01-01 00:00:00", YELLOW.dropoff: "2019-01-01 00:10:00", "store_and_fwd_flag": flag}
    return [values[c] for c in YELLOW.raw_columns]


@pytest.mark.parametrize("escape, flag, value", [("\\", '"a,b\\"c,d"', 'a,b"c,d'), ('"', '"a,b""c,d"', 'a,b"c,d'), ("\\", '"x, y"', "x, y")])
def test_quoted_values_do_not_hide_short_rows(spark, scratch, escape, flag, value):
    full, short, wide = _row(flag), _row(flag)[:-1], _row(flag) + ["more", '"and, more"']
    got = io.read_trips_csv(spark, _csv(spark, scratch, ",".join(full), ",".join(wide)), YELLOW, escape=escape)
    assert [r.store_and_fwd_flag for r in got.collect()] == [value] * 2
    with pytest.raises(Exception, match="fewer than"):
        io.read_trips_csv(spark, _csv(spark, scratch, ",".join(full), ",".join(short)), YELLOW, escape=escape).collect()


