"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the model semantics,
over the driver's pre-registered views. The taxi mapping is repeated as CTEs.
"""

from __future__ import annotations

from ridemart.sources.testbed import ORACLE_CTES
from ridemart.specs import (
    CODE_COLUMNS,
    COUNT_COLUMNS,
    GREEN,
    PAYMENT_TYPE_DESCRIPTIONS,
    PAYMENT_TYPE_OTHER,
    REVENUE_SUMS,
    SURROGATE_NULL,
    YELLOW,
)

D = "DECIMAL(38,9)"
R = 6  # digits for DOUBLE results
FINE_L1 = (0.0, 0.0005)     # as in the registry


def with_ctes(*extra: str) -> str:
    parts = [ORACLE_CTES.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts)


def _payment_case(expr: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_TYPE_DESCRIPTIONS.items())
    return f"CASE {expr} {whens} ELSE '{PAYMENT_TYPE_OTHER}' END"


def _stg_cte(name: str, source: str, spec) -> str:
    rest = [c for c in spec.raw_columns if c not in ("VendorID", spec.pickup)]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    trip_type = "TRY_CAST(trip_type AS BIGINT)" if "trip_type" in spec.raw_columns else "CAST(1 AS BIGINT)"
    ehail = f"CAST(ehail_fee AS {D})" if "ehail_fee" in spec.raw_columns else f"CAST(0 AS {D})"
    return f"""
{name}_dedup AS (
  SELECT *, row_number() OVER (PARTITION BY VendorID, {spec.pickup} ORDER BY {order}) AS rn
  FROM {source} WHERE VendorID IS NOT NULL
),
{name} AS (
  SELECT
    md5(concat_ws('-', coalesce(CAST(VendorID AS VARCHAR), '{SURROGATE_NULL}'),
                       coalesce(CAST({spec.pickup} AS VARCHAR), '{SURROGATE_NULL}'))) AS tripid,
    TRY_CAST(VendorID AS BIGINT) AS vendorid,
    TRY_CAST(RatecodeID AS BIGINT) AS ratecodeid,
    TRY_CAST(PULocationID AS BIGINT) AS pickup_locationid,
    TRY_CAST(DOLocationID AS BIGINT) AS dropoff_locationid,
    CAST({spec.pickup} AS TIMESTAMP) AS pickup_datetime,
    CAST({spec.dropoff} AS TIMESTAMP) AS dropoff_datetime,
    store_and_fwd_flag,
    TRY_CAST(round(passenger_count) AS BIGINT) AS passenger_count,
    CAST(trip_distance AS {D}) AS trip_distance,
    {trip_type} AS trip_type,
    CAST(fare_amount AS {D}) AS fare_amount,
    CAST(extra AS {D}) AS extra,
    CAST(mta_tax AS {D}) AS mta_tax,
    CAST(tip_amount AS {D}) AS tip_amount,
    CAST(tolls_amount AS {D}) AS tolls_amount,
    {ehail} AS ehail_fee,
    CAST(improvement_surcharge AS {D}) AS improvement_surcharge,
    CAST(total_amount AS {D}) AS total_amount,
    coalesce(TRY_CAST(payment_type AS BIGINT), 0) AS payment_type,
    {_payment_case('TRY_CAST(payment_type AS BIGINT)')} AS payment_type_description
  FROM {name}_dedup WHERE rn = 1
)"""


STG = _stg_cte("stg_green", "green", GREEN) + "," + _stg_cte("stg_yellow", "yellow", YELLOW)

DIM = """
dim_zones AS (
  SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone FROM zones
)"""

UNIONED = """
trips_unioned AS (
  SELECT *, 'Green' AS service_type FROM stg_green
  UNION ALL
  SELECT *, 'Yellow' AS service_type FROM stg_yellow
)"""

FACT = """
fact_trips AS (
  SELECT t.tripid, t.vendorid, t.service_type, t.ratecodeid,
         t.pickup_locationid, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         t.dropoff_locationid, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count,
         t.trip_distance, t.trip_type, t.fare_amount, t.extra, t.mta_tax, t.tip_amount,
         t.tolls_amount, t.ehail_fee, t.improvement_surcharge, t.total_amount,
         t.payment_type, t.payment_type_description
  FROM trips_unioned t
  JOIN (SELECT * FROM dim_zones WHERE borough != 'Unknown') pz ON t.pickup_locationid = pz.locationid
  JOIN (SELECT * FROM dim_zones WHERE borough != 'Unknown') dz ON t.dropoff_locationid = dz.locationid
)"""

_sums = ",\n    ".join(f"sum({s}) AS {d}" for s, d in REVENUE_SUMS)
MART = f"""
mart AS (
  SELECT pickup_zone AS revenue_zone,
    date_trunc('month', pickup_datetime) AS revenue_month,
    service_type,
    {_sums},
    count(tripid) AS total_monthly_trips,
    round(CAST(avg(passenger_count) AS DOUBLE), {R}) AS avg_monthly_passenger_count,
    round(CAST(avg(trip_distance) AS DOUBLE), {R}) AS avg_monthly_trip_distance
  FROM fact_trips
  GROUP BY 1, 2, 3
)"""

MODELS = [STG, DIM, UNIONED, FACT]

JUNE = "CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'"
LONG_RANGE = "CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1997-12-31'"
COUNT_V1 = f"SELECT count(*) AS trips FROM yellow WHERE {LONG_RANGE} AND VendorID = 1"

YCOLS = ", ".join(YELLOW.raw_columns)
GCOLS = ", ".join(GREEN.raw_columns)


def _rid(parts: list[str]) -> str:
    return "md5(concat(" + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + "))"


RID5 = _rid(YELLOW.warehouse_id_columns)
RID7 = _rid(YELLOW.database_id_columns)


DAY = "CAST(tpep_pickup_datetime AS DATE)"
MERGE = f"""
bound AS (SELECT lo, hi, lo + CAST((hi - lo) // 3 AS INTEGER) AS a, lo + 2 * CAST((hi - lo) // 3 AS INTEGER) AS b
          FROM (SELECT min({DAY}) AS lo, max({DAY}) AS hi FROM yellow)),
b1 AS (SELECT {RID5} AS unique_row_id, 'batch_1.parquet' AS filename, {YCOLS}
       FROM yellow, bound WHERE {DAY} BETWEEN lo AND b
       UNION ALL
       SELECT {RID5} AS unique_row_id, 'batch_1.parquet' AS filename, {YCOLS}
       FROM yellow, bound WHERE {DAY} BETWEEN lo AND a),
b2 AS (SELECT {RID5} AS unique_row_id, 'batch_2.parquet' AS filename, {YCOLS}
       FROM yellow, bound WHERE {DAY} BETWEEN a AND hi),
b2_new AS (SELECT * FROM b2 WHERE unique_row_id NOT IN (SELECT unique_row_id FROM b1)),
merged AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2_new)"""


def _typed_target(amount: str, count: str) -> str:
    kind = {f.name: f.dataType.simpleString() for f in YELLOW.raw_schema.fields}
    out = []
    for c in YELLOW.raw_columns:
        to = "VARCHAR" if c in CODE_COLUMNS else count if c in COUNT_COLUMNS else amount if kind[c] == "double" else None
        out.append(f"CAST({c} AS {to}) AS {c}" if to else c)
    return ", ".join(out)


def _check(col: str, check: str, failures: str, severity: str = "warn") -> str:
    return (f"SELECT 'stg_green_tripdata' AS model, '{col}' AS column_name, '{check}' AS check_name, "
            f"'{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures")


CHK_UNIQUE = _check("tripid", "unique",
                    "SELECT count(*) FROM (SELECT tripid FROM stg_green WHERE tripid IS NOT NULL "
                    "GROUP BY tripid HAVING count(*) > 1)")
CHK_NOT_NULL = _check("tripid", "not_null", "SELECT count(*) FROM stg_green WHERE tripid IS NULL")
CHK_REL = "\nUNION ALL\n".join(
    _check(c, "relationships", f"SELECT count(*) FROM stg_green WHERE {c} IS NOT NULL "
                                f"AND {c} NOT IN (SELECT locationid FROM zones WHERE locationid IS NOT NULL)")
    for c in ("pickup_locationid", "dropoff_locationid"))
CHK_ACCEPTED = _check("payment_type", "accepted_values",
                      "SELECT count(DISTINCT payment_type) FROM stg_green WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)")
CHK_MART = ("SELECT 'dm_monthly_zone_revenue' AS model, 'revenue_monthly_total_amount' AS column_name, "
            "'not_null' AS check_name, 'error' AS severity, "
            "CAST((SELECT count(*) FROM mart WHERE revenue_monthly_total_amount IS NULL) AS BIGINT) AS failures")

FEATURES = """
features AS (
  SELECT TRY_CAST(round(passenger_count) AS BIGINT) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(PULocationID AS VARCHAR) AS PULocationID,
         CAST(DOLocationID AS VARCHAR) AS DOLocationID,
         CAST(payment_type AS VARCHAR) AS payment_type,
         CAST(fare_amount AS DOUBLE) AS fare_amount,
         CAST(tolls_amount AS DOUBLE) AS tolls_amount,
         CAST(tip_amount AS DOUBLE) AS tip_amount
  FROM yellow WHERE fare_amount != 0
),
labelled AS (SELECT * FROM features WHERE tip_amount IS NOT NULL)"""

FEATURE_COLS = ["passenger_count", "trip_distance", "PULocationID", "DOLocationID", "payment_type",
                "fare_amount", "tolls_amount", "tip_amount"]


def _num_info(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS input, round(min({x}), {R}) AS min, round(max({x}), {R}) AS max, "
            f"round(avg({x}), {R}) AS mean, round(quantile_disc({x}, 0.5), {R}) AS median, "
            f"round(stddev_samp({x}), {R}) AS stddev, CAST(NULL AS BIGINT) AS category_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM features")


def _cat_info(c: str) -> str:
    return (f"SELECT '{c}' AS input, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, "
            f"NULL::DOUBLE AS median, NULL::DOUBLE AS stddev, count(DISTINCT {c}) AS category_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM features")


FEATURE_INFO = "\nUNION ALL\n".join(
    [_num_info(c) for c in ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")]
    + [_cat_info(c) for c in ("PULocationID", "DOLocationID", "payment_type")])

BUCKET = ("(('0x' || substr(md5(concat_ws('|', " +
          ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in FEATURE_COLS) +
          ")), 1, 8))::BIGINT % 10)")

# Fixed model used by the evaluate / explain checks (same constants as the Spark side).
FX_TERMS = [
    ("passenger_count", "0.00001 * (coalesce(CAST(passenger_count AS DOUBLE), 25.0) - 25.0)"),
    ("trip_distance", "0.05 * (coalesce(trip_distance, 0.05) - 0.05)"),
    ("fare_amount", "1e-7 * (coalesce(fare_amount, 50000.0) - 50000.0)"),
    ("tolls_amount", "-2e-7 * (coalesce(tolls_amount, 4500.0) - 4500.0)"),
    ("payment_type", "(coalesce(CASE payment_type WHEN '1' THEN 0.002 WHEN '2' THEN -0.001 WHEN '3' THEN 0.0005 "
                     "WHEN '4' THEN -0.0015 END, 0.0) - 0.0001)"),
]
FX_BASELINE = "(0.03 + 0.00001 * 25.0 + 0.05 * 0.05 + 1e-7 * 50000.0 + -2e-7 * 4500.0 + 0.0001)"
FX_SUM = " + ".join(f"CAST({e} AS DOUBLE)" for _, e in FX_TERMS)
FIXED = f"""
fx AS (
  SELECT *, row_number() OVER () AS rid, {FX_BASELINE} + ({FX_SUM}) AS predicted_tip_amount FROM labelled
),
fx_attr AS (
  {" UNION ALL ".join(f"SELECT rid, '{n}' AS feature, CAST({e} AS DOUBLE) AS attribution FROM fx" for n, e in FX_TERMS)}
),
fx_rank AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(attribution) DESC, feature ASC) AS rk FROM fx_attr
),
fx_top AS (
  SELECT rid,
    max(CASE WHEN rk = 1 THEN feature END) AS top1_feature, max(CASE WHEN rk = 1 THEN attribution END) AS a1,
    max(CASE WHEN rk = 2 THEN feature END) AS top2_feature, max(CASE WHEN rk = 2 THEN attribution END) AS a2,
    max(CASE WHEN rk = 3 THEN feature END) AS top3_feature, max(CASE WHEN rk = 3 THEN attribution END) AS a3
  FROM fx_rank GROUP BY rid
)"""

EVAL = f"""
SELECT round(avg(abs(p - y)), {R}) AS mean_absolute_error,
       round(avg((p - y) * (p - y)), {R}) AS mean_squared_error,
       round(avg(pow(ln(1 + p) - ln(1 + y), 2)), {R}) AS mean_squared_log_error,
       round(quantile_disc(abs(p - y), 0.5), {R}) AS median_absolute_error,
       round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), {R}) AS r2_score,
       round(1 - var_pop(y - p) / var_pop(y), {R}) AS explained_variance
FROM (SELECT predicted_tip_amount AS p, tip_amount AS y FROM fx"""

# Least squares on one categorical input: the mean of each category over the train rows. NULL, and categories
# that the train rows lack, count as the first category.
PAYMENT = f"""
train AS (SELECT * FROM labelled WHERE {BUCKET} >= 2),
one AS (SELECT min(payment_type) AS p FROM train),
level AS (SELECT coalesce(payment_type, p) AS k, avg(tip_amount) AS m FROM train, one GROUP BY 1),
fx AS (SELECT l.*, coalesce(v.m, f.m) AS predicted_tip_amount
       FROM labelled l CROSS JOIN one JOIN level f ON f.k = one.p LEFT JOIN level v ON v.k = l.payment_type)"""
PAYMENT_COLS = ", ".join(f"round({c}, {R}) AS {c}" if c in ("trip_distance", "fare_amount", "tolls_amount", "tip_amount") else c
                         for c in FEATURE_COLS)
PAYMENT_INPUTS = ", ".join(x for x in PAYMENT_COLS.split(", round(tip")[0:1])


def _trials(**kw) -> str:
    from ridemart.operators.ml import sample_trials, to_spark_reg
    rows = [f"({i + 1}, {l1!r}, {l2!r}, {to_spark_reg(l1, l2)[0]!r}, {to_spark_reg(l1, l2)[1]!r})"
            for i, (l1, l2) in enumerate(sample_trials(5, **kw))]
    return ", ".join(rows)


# Where an l1 penalty is at least the label's standard deviation no column's covariance can exceed it (Cauchy-Schwarz):
# all coefficients 0 is the optimum, whatever the l2, and the prediction is the mean of the train labels.
CERTIFICATE = f"""
train AS (SELECT * FROM labelled WHERE {BUCKET} >= 2),
held AS (SELECT * FROM labelled WHERE {BUCKET} < 2),
base AS (SELECT avg(tip_amount) AS m, stddev_pop(tip_amount) AS t, count(*) AS n FROM train),
judged AS (SELECT 1 - sum((tip_amount - m) ** 2) / (var_pop(tip_amount) * count(*)) AS r2 FROM held, base),
trial AS (SELECT * FROM (VALUES {_trials()}) AS x(trial_id, l1, l2, reg, mixed))"""
# A column stands at an l1 penalty if its covariance with the label exceeds the penalty times its deviation.
STRENGTH = "strength AS (" + " UNION ALL ".join(
    [f"SELECT abs(covar_pop(coalesce({c}, m), tip_amount)) / stddev_pop(coalesce({c}, m)) AS s FROM train, "
     f"(SELECT avg({c}) AS m FROM train)" for c in ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")] +
    [f"SELECT abs(k * 1.0 / n * (y - m)) / sqrt(k * 1.0 / n * (1 - k * 1.0 / n)) FROM base, "
     f"(SELECT {c}, count(*) AS k, avg(tip_amount) AS y FROM train WHERE {c} > (SELECT min({c}) FROM train) GROUP BY 1)"
     for c in ("PULocationID", "DOLocationID", "payment_type")]) + ")"


ORACLE: dict[str, str] = {
    "stg_green_trips": with_ctes(STG) + "\nSELECT * FROM stg_green",
    "stg_yellow_trips": with_ctes(STG) + "\nSELECT * FROM stg_yellow",
    "dim_zones": with_ctes(DIM) + "\nSELECT * FROM dim_zones",
    "trips_unioned": with_ctes(STG, UNIONED) + "\nSELECT * FROM trips_unioned",
    "fact_trips": with_ctes(*MODELS) + "\nSELECT * FROM fact_trips",
    "monthly_zone_revenue": with_ctes(*MODELS, MART) + "\nSELECT * FROM mart",
    "distinct_vendors_unpartitioned": with_ctes() + f"\nSELECT DISTINCT VendorID FROM yellow WHERE {JUNE}",
    "distinct_vendors_june": with_ctes() + f"\nSELECT DISTINCT VendorID FROM yellow WHERE {JUNE}",
    "partition_stats": with_ctes() + """
SELECT 'yellow_tripdata_partitioned' AS table_name,
       strftime(CAST(tpep_pickup_datetime AS DATE), '%Y%m%d') AS partition_id,
       count(*) AS total_rows
FROM yellow GROUP BY 2 ORDER BY total_rows DESC, partition_id""",
    "count_trips_vendor_range": with_ctes() + "\n" + COUNT_V1,
    "clustered_count": with_ctes() + "\n" + COUNT_V1,
    "compacted_count": with_ctes() + "\n" + COUNT_V1,
    "compacted_trips": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "dropoff_clustered_count": with_ctes() + "\n" + COUNT_V1,
    "trip_extent": with_ctes() + """
SELECT max(tpep_pickup_datetime) AS max_pickup, min(tpep_pickup_datetime) AS min_pickup,
       max(total_amount) AS max_total_amount FROM yellow""",
    "trip_extent_scan": with_ctes() + """
SELECT max(tpep_pickup_datetime) AS max_pickup, min(tpep_pickup_datetime) AS min_pickup,
       max(total_amount) AS max_total_amount FROM yellow""",
    "staging_views": with_ctes(STG) + """
SELECT 'Green' AS service_type, count(*) AS trips, count(payment_type) AS with_payment_type FROM stg_green
UNION ALL SELECT 'Yellow', count(*), count(payment_type) FROM stg_yellow""",
    "zone_count": with_ctes() + "\nSELECT count(1) AS row_count FROM zones",
    "row_id_warehouse": with_ctes() + f"\nSELECT {RID5} AS unique_row_id, "
                        f"'yellow_tripdata_1996-01.parquet' AS filename, {YCOLS} FROM yellow",
    "row_id_database": with_ctes() + f"\nSELECT {RID7} AS unique_row_id, "
                       f"'yellow_tripdata_1996-01.csv' AS filename, {YCOLS} FROM yellow",
    "merge_new_rows": with_ctes(MERGE) + "\nSELECT * FROM merged",
    "merge_rerun_count": with_ctes(MERGE) + """
SELECT CAST((SELECT count(*) FROM b1) AS BIGINT) AS first_insert,
       CAST((SELECT count(*) FROM b2_new) AS BIGINT) AS second_insert,
       CAST(0 AS BIGINT) AS rerun_insert""",
    "merge_batch_duplicates": with_ctes(MERGE) + """
SELECT unique_row_id, count(*) AS copies FROM merged GROUP BY unique_row_id HAVING count(*) > 1""",
    "backfill_months": with_ctes() + f"""
SELECT {RID5} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS filename, {YCOLS}
FROM yellow""",
    "load_month_database": with_ctes() + f"""
SELECT {RID7} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.csv' AS filename, {YCOLS}
FROM yellow""",
    "backfill_yearly": with_ctes() + f"""
SELECT {RID5} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS filename, {YCOLS},
       'yellow_' || strftime(tpep_pickup_datetime, '%Y') AS target_table
FROM yellow""",
    "load_numeric_target": with_ctes() + f"""
SELECT {RID5} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS filename, {_typed_target("DECIMAL(38, 9)", "BIGINT")}
FROM yellow""",
    "load_text_target": with_ctes() + f"""
SELECT {RID5} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS filename, {_typed_target("DOUBLE", "INTEGER")}
FROM yellow""",
    "row_id_bytes": with_ctes() + f"\nSELECT {RID5} AS unique_row_id, "
                    f"'yellow_tripdata_1996-01.parquet' AS filename, {YCOLS} FROM yellow",
    "row_index_scan": with_ctes() + """
SELECT count(*) AS row_count, count(*) AS different, CAST(0 AS BIGINT) AS lowest, count(*) - 1 AS highest FROM yellow""",
    "check_unique": with_ctes(STG) + "\n" + CHK_UNIQUE,
    "check_not_null": with_ctes(STG) + "\n" + CHK_NOT_NULL,
    "check_relationships": with_ctes(STG) + "\n" + CHK_REL,
    "check_accepted_values": with_ctes(STG) + "\n" + CHK_ACCEPTED,
    "run_checks": with_ctes(*MODELS, MART) + "\n" + "\nUNION ALL\n".join(
        [CHK_UNIQUE, CHK_NOT_NULL, CHK_REL, CHK_ACCEPTED, CHK_MART]),
    "csv_roundtrip": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "gzip_scan": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "parquet_glob": with_ctes() + f"\nSELECT {YCOLS} FROM yellow WHERE year(tpep_pickup_datetime) = 1996",
    "csv_glob_list": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "raw_zone": with_ctes() + f"\nSELECT {YCOLS}, strftime(tpep_pickup_datetime, '%Y-%m') AS month FROM yellow",
    "parquet_to_csv": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "csv_to_parquet": with_ctes() + f"\nSELECT {GCOLS} FROM green",
    "copy_in_columns": with_ctes() + f"""
SELECT CAST(NULL AS VARCHAR) AS unique_row_id, CAST(NULL AS VARCHAR) AS filename, {YCOLS},
       CAST(NULL AS DATE) AS tpep_pickup_datetime_day FROM yellow""",
    "row_index": with_ctes() + "\nSELECT row_number() OVER (ORDER BY " +
                 ", ".join(f"{c} ASC NULLS FIRST" for c in YELLOW.raw_columns) +
                 f") - 1 AS \"index\", {YCOLS} FROM yellow",
    "load_seed": with_ctes() + "\nSELECT * FROM zones",
    "ingest_table": with_ctes() + f"\nSELECT {YCOLS} FROM yellow",
    "stg_green_dev_limit": with_ctes(STG) + "\nSELECT * FROM stg_green ORDER BY tripid LIMIT 100",
    "feature_columns": with_ctes() + """
SELECT passenger_count, trip_distance, PULocationID, DOLocationID, payment_type, fare_amount, tolls_amount, tip_amount
FROM yellow WHERE fare_amount != 0""",
    "ml_feature_table": with_ctes(FEATURES) + "\nSELECT * FROM features",
    "feature_info": with_ctes(FEATURES) + "\n" + FEATURE_INFO,
    "auto_split_counts": with_ctes(FEATURES) + f"""
SELECT CASE WHEN {BUCKET} >= 2 THEN 'train' ELSE 'eval' END AS split, count(*) AS "rows"
FROM labelled GROUP BY 1""",
    "tip_regression_one_feature": with_ctes(FEATURES) + """
SELECT round(regr_slope(tip_amount, trip_distance), 10) AS slope,
       round(regr_intercept(tip_amount, trip_distance), 10) AS intercept,
       round(regr_r2(tip_amount, trip_distance), 10) AS r2
FROM labelled WHERE trip_distance IS NOT NULL""",
    "evaluate_fixed_model": with_ctes(FEATURES, FIXED) + EVAL + ")",
    "explain_fixed_model": with_ctes(FEATURES, FIXED) + """
SELECT fx.passenger_count, fx.trip_distance, fx.PULocationID, fx.DOLocationID, fx.payment_type,
       fx.fare_amount, fx.tolls_amount, fx.tip_amount, round(fx.predicted_tip_amount, 9) AS predicted_tip_amount,
       t.top1_feature, round(t.a1, 9) AS top1_attribution, t.top2_feature, round(t.a2, 9) AS top2_attribution,
       t.top3_feature, round(t.a3, 9) AS top3_attribution, round(""" + FX_BASELINE + """, 9) AS baseline_prediction_value
FROM fx JOIN fx_top t USING (rid)""",
    "tip_model_predict": with_ctes(FEATURES, PAYMENT) + f"""
SELECT {PAYMENT_COLS}, round(predicted_tip_amount, {R}) AS predicted_tip_amount FROM fx""",
    "score_instances": with_ctes(FEATURES, PAYMENT) + f"""
SELECT {PAYMENT_INPUTS}, round(predicted_tip_amount, {R}) AS predicted_tip_amount FROM fx""",
    "tip_model_evaluate": with_ctes(FEATURES, PAYMENT) + EVAL + f" WHERE {BUCKET} < 2)",
    "tip_model_explain": with_ctes(FEATURES, PAYMENT) + f"""
SELECT {PAYMENT_COLS}, round(predicted_tip_amount, {R}) AS predicted_tip_amount, 'payment_type' AS top_feature,
       round(predicted_tip_amount - base, {R}) AS top_attribution, round(base, {R}) AS baseline_prediction_value
FROM fx, (SELECT avg(predicted_tip_amount) AS base FROM fx WHERE {BUCKET} >= 2)""",
    "tip_model_residuals": "SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in
                                                  ("intercept", "passenger_count", "trip_distance", "fare_amount", "tolls_amount")),
    "tip_model_trials": with_ctes(FEATURES) + f"""
SELECT CAST(trial_id AS INTEGER) AS trial_id, round(CAST(l1 AS DOUBLE), 9) AS l1_reg, round(CAST(l2 AS DOUBLE), 9) AS l2_reg,
       round(CAST(reg AS DOUBLE), 9) AS reg_param, round(CAST(mixed AS DOUBLE), 9) AS elastic_net_param,
       (SELECT count(*) FROM labelled WHERE {BUCKET} >= 2) AS train_rows, (SELECT count(*) FROM labelled WHERE {BUCKET} < 2) AS eval_rows
FROM (VALUES {_trials()}) AS t(trial_id, l1, l2, reg, mixed)""",
    "tip_model_certificate": with_ctes(FEATURES, CERTIFICATE) + f"""
SELECT CAST(trial_id AS INTEGER) AS trial_id, CAST(0 AS DOUBLE) AS violation, CAST(0 AS DOUBLE) AS intercept_violation,
       CAST(CASE WHEN l1 >= t THEN 0 END AS INTEGER) AS nonzero, CASE WHEN l1 >= t THEN round(r2, {R}) END AS r2_score,
       trial_id = (SELECT min(trial_id) FROM trial) AS is_optimal
FROM trial, base, judged""",
    "tip_model_certificate_fine": with_ctes(FEATURES, CERTIFICATE, STRENGTH) + f"""
SELECT CAST(trial_id AS INTEGER) AS trial_id, round(CAST(l1 AS DOUBLE), 9) AS l1_reg, (SELECT max(s) FROM strength) > l1 AS stands,
       CAST(0 AS DOUBLE) AS violation, CAST(0 AS DOUBLE) AS intercept_violation
FROM (VALUES {_trials(l1_range=FINE_L1)}) AS x(trial_id, l1, l2, reg, mixed)""",
    "tip_model_tuned": with_ctes(FEATURES, CERTIFICATE) + f"""
SELECT {PAYMENT_COLS}, round(m, {R}) AS predicted_tip_amount FROM labelled, base""",
    "stream_scores": with_ctes(FEATURES, PAYMENT) + f"""
SELECT {PAYMENT_INPUTS}, round(predicted_tip_amount, {R}) AS predicted_tip_amount FROM fx""",
    "stream_months": with_ctes() + f"""
SELECT {RID5} AS unique_row_id,
       'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS filename, {YCOLS}
FROM yellow""",
    "read_instances": with_ctes(FEATURES) + """
SELECT passenger_count, trip_distance, PULocationID, DOLocationID, payment_type, fare_amount, tolls_amount
FROM labelled""",
}
