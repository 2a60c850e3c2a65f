"""Taxi-shaped inputs derived from the driver's TPC-H-like tables.

``lineitem ⋈ orders ⋈ customer ⋈ supplier`` keeps every line item. Green trips
are the lines with return flag 'R', yellow trips the rest. Zones come from
``nation ⋈ region``. All work here scales with the source tables. The joins
are plain equi-joins: Spark's size statistics (and AQE's runtime sizes)
decide between broadcast and a shuffle join, so a large customer or order
table is never broadcast. Customers are joined to the orders first, so that
where both are shuffled the line items, the widest and longest table, move
once only; suppliers are broadcast up to a counted bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.plans.joins import fits_count
from ridemart.specs import GREEN, YELLOW, ServiceSpec

# Fixed values of the test mapping.
GREEN_RETURN_FLAG = "R"
NULL_VENDOR_LINE = 7           # line number whose vendor id is NULL
NULL_PAYMENT_PRIORITY = "5"    # priority digit whose payment type is NULL
UNKNOWN_NATION = 24            # nation whose borough is 'Unknown'
SHARED_NATIONS = (5, 6)        # nations sharing the zone name 'SHARED'
MTA_TAX, IMPROVEMENT, CONGESTION = 0.5, 0.3, 2.5

# Three narrow columns a supplier: some 30 MB in every executor at this bound.
BROADCAST_SUPPLIERS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    o = o.join(c, o["o_custkey"] == c["c_custkey"])
    by_order, by_supplier = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_suppkey") == F.col("s_suppkey")
    if fits_count(s, BROADCAST_SUPPLIERS):      # after the shuffle join: its columns need not be shuffled
        return li.join(o, by_order).join(F.broadcast(s), by_supplier)
    return li.join(s, by_supplier).join(o, by_order)


def raw_trips(spark: SparkSession, sf_dir: str, service: ServiceSpec) -> DataFrame:
    """Raw trips of one service in its file column order and warehouse types."""
    x = _lines(spark, sf_dir)
    is_green = F.col("l_returnflag") == GREEN_RETURN_FLAG
    x = x.where(is_green if service is GREEN else ~F.coalesce(is_green, F.lit(False)))
    dbl = T.DoubleType()
    prio = F.substring("o_orderpriority", 1, 1)
    cols = {
        "VendorID": F.when(F.col("l_linenumber") == NULL_VENDOR_LINE, F.lit(None))
                     .otherwise(F.col("l_linenumber")).cast(T.LongType()),
        service.pickup: F.col("o_orderdate").cast(T.TimestampType()),
        service.dropoff: F.col("l_shipdate").cast(T.TimestampType()),
        "store_and_fwd_flag": F.col("l_linestatus"),
        "RatecodeID": F.col("l_linenumber").cast(T.LongType()),
        "PULocationID": F.col("s_nationkey").cast(T.LongType()),
        "DOLocationID": F.col("c_nationkey").cast(T.LongType()),
        "passenger_count": F.col("l_quantity"),
        "trip_distance": F.col("l_discount"),
        "fare_amount": F.col("l_extendedprice"),
        "extra": F.col("l_discount"),
        "mta_tax": F.lit(MTA_TAX).cast(dbl),
        "tip_amount": F.col("l_tax"),
        "tolls_amount": F.col("s_acctbal"),
        "ehail_fee": F.lit(None).cast(dbl),
        "improvement_surcharge": F.lit(IMPROVEMENT).cast(dbl),
        "total_amount": F.col("o_totalprice"),
        "payment_type": F.when(prio == NULL_PAYMENT_PRIORITY, F.lit(None)).otherwise(prio).cast(T.LongType()),
        "trip_type": F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).cast(T.LongType()),
        "congestion_surcharge": F.lit(CONGESTION).cast(dbl),
    }
    return x.select(*[cols[name].alias(name) for name in service.raw_columns])


def green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips(spark, sf_dir, GREEN)


def yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips(spark, sf_dir, YELLOW)


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup with the seed's columns: locationid, borough, zone, service_zone."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
             .select(k.cast(T.IntegerType()).alias("locationid"),
                     F.when(k == UNKNOWN_NATION, "Unknown").otherwise(F.col("r_name")).alias("borough"),
                     F.when(k.isin(*SHARED_NATIONS), "SHARED").otherwise(F.col("n_name")).alias("zone"),
                     F.when(k % 2 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone")))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Named sources (S11): raw green/yellow and the zone lookup as temp views."""
    green(spark, sf_dir).createOrReplaceTempView("green_tripdata")
    yellow(spark, sf_dir).createOrReplaceTempView("yellow_tripdata")
    zone_seed(spark, sf_dir).createOrReplaceTempView("taxi_zone_lookup")


# The same mapping in plain SQL for the DuckDB oracle (tables pre-registered there).
ORACLE_CTES = f"""
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_nationkey, s.s_nationkey, s.s_acctbal
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
mapped AS (
  SELECT
    CAST(CASE WHEN l_linenumber = {NULL_VENDOR_LINE} THEN NULL ELSE l_linenumber END AS BIGINT) AS VendorID,
    CAST(o_orderdate AS TIMESTAMP) AS pickup_ts,
    CAST(l_shipdate AS TIMESTAMP) AS dropoff_ts,
    l_linestatus AS store_and_fwd_flag,
    CAST(l_linenumber AS BIGINT) AS RatecodeID,
    CAST(s_nationkey AS BIGINT) AS PULocationID,
    CAST(c_nationkey AS BIGINT) AS DOLocationID,
    l_quantity AS passenger_count,
    l_discount AS trip_distance,
    l_extendedprice AS fare_amount,
    l_discount AS extra,
    CAST({MTA_TAX} AS DOUBLE) AS mta_tax,
    l_tax AS tip_amount,
    s_acctbal AS tolls_amount,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    CAST({IMPROVEMENT} AS DOUBLE) AS improvement_surcharge,
    o_totalprice AS total_amount,
    CAST(CASE WHEN substr(o_orderpriority, 1, 1) = '{NULL_PAYMENT_PRIORITY}' THEN NULL
              ELSE substr(o_orderpriority, 1, 1) END AS BIGINT) AS payment_type,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS trip_type,
    CAST({CONGESTION} AS DOUBLE) AS congestion_surcharge,
    l_returnflag = '{GREEN_RETURN_FLAG}' AS is_green
  FROM lines
),
green AS (
  SELECT VendorID, pickup_ts AS lpep_pickup_datetime, dropoff_ts AS lpep_dropoff_datetime,
         store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID, passenger_count, trip_distance,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge,
         total_amount, payment_type, trip_type, congestion_surcharge
  FROM mapped WHERE is_green
),
yellow AS (
  SELECT VendorID, pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime,
         passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID,
         payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge
  FROM mapped WHERE NOT coalesce(is_green, false)
),
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS locationid,
         CASE WHEN n_nationkey = {UNKNOWN_NATION} THEN 'Unknown' ELSE r_name END AS borough,
         CASE WHEN n_nationkey IN {SHARED_NATIONS} THEN 'SHARED' ELSE n_name END AS zone,
         CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
