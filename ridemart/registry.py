"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver's tables (or frames Spark derives from them), so
its work grows with the data. The matching DuckDB SQL lives in
``ridemart.oracle``; column names and types line up one to one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.operators import checks as Q
from ridemart.operators import compaction, ml
from ridemart.operators.ledger import Files
from ridemart.operators.models import dim_zones, fact_trips, monthly_zone_revenue, union_services
from ridemart.operators.staging import preview, stage_trips
from ridemart.operators.tables import as_view, day_column, ensure_table, evaluated, materialize, merge_new, register_external, stamp_rows
from ridemart.operators.warehouse import count_trips, distinct_vendors, sql, trip_extent
from ridemart.plans import footers
from ridemart.plans.pipeline import backfill, build, load_months, load_months_staged, months_between, target_schema
from ridemart.session import scratch_path
from ridemart.sources import files as io
from ridemart.sources import testbed
from ridemart.specs import GREEN, YELLOW, Config

FULL = Config(is_test_run=False)
DOUBLE_DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DOUBLE_DIGITS) -> DataFrame:
    """Round DOUBLE columns so float summation order cannot change the compared value."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        GREEN.label: stage_trips(testbed.green(spark, sf_dir), GREEN, FULL),
        YELLOW.label: stage_trips(testbed.yellow(spark, sf_dir), YELLOW, FULL),
    }


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(testbed.zone_seed(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(staged(spark, sf_dir), zones(spark, sf_dir))


def q_stg_green_trips(spark, sf_dir):
    return stage_trips(testbed.green(spark, sf_dir), GREEN, FULL)


def q_stg_yellow_trips(spark, sf_dir):
    return stage_trips(testbed.yellow(spark, sf_dir), YELLOW, FULL)


def q_dim_zones(spark, sf_dir):
    return zones(spark, sf_dir)


def q_trips_unioned(spark, sf_dir):
    return union_services(staged(spark, sf_dir))


def q_fact_trips(spark, sf_dir):
    return fact(spark, sf_dir)


def q_monthly_zone_revenue(spark, sf_dir):
    return round_doubles(monthly_zone_revenue(fact(spark, sf_dir)))


# Date windows inside the test data (orders span 1995-01 .. 2001-08).
JUNE = ("1996-06-01", "1996-06-30")
LONG_RANGE = ("1996-06-01", "1997-12-31")
PICKUP = YELLOW.pickup
_LAYOUTS: dict[tuple, tuple[str, str | None]] = {}
_LAYOUT_FRAMES: dict[tuple, DataFrame] = {}


def yellow_layout(spark: SparkSession, sf_dir: str, day_of_col: str | None = None,
                  cluster_by: tuple[str, ...] = ()) -> tuple[DataFrame, str | None]:
    """Yellow raw trips written once per session in the requested layout (T3-T5), read back.

    The read-back frame is kept too: its file index holds the listing of the
    (thousands of) day folders, so later queries on the same table prune from
    that index instead of listing the folders again, as a warehouse table would.
    """
    k = (spark.sparkContext.applicationId, sf_dir, day_of_col, cluster_by)
    if k not in _LAYOUTS:
        path = scratch_path(spark, "yellow_layout")
        day = materialize(testbed.yellow(spark, sf_dir), path, day_of_col, list(cluster_by) or None)
        _LAYOUTS[k] = (path, day)
        _LAYOUT_FRAMES[k] = spark.read.parquet(path)
    return _LAYOUT_FRAMES[k], _LAYOUTS[k][1]


def q_distinct_vendors_unpartitioned(spark, sf_dir):
    df, _ = yellow_layout(spark, sf_dir)
    return distinct_vendors(df, PICKUP, *JUNE)


def q_distinct_vendors_partitioned(spark, sf_dir):
    df, _ = yellow_layout(spark, sf_dir, PICKUP)
    return distinct_vendors(df, PICKUP, *JUNE)


def layout_path(spark, sf_dir, day_of_col=None, cluster_by=()) -> tuple[str, str | None]:
    yellow_layout(spark, sf_dir, day_of_col, cluster_by)
    return _LAYOUTS[spark.sparkContext.applicationId, sf_dir, day_of_col, cluster_by]


def q_partition_stats(spark, sf_dir):
    """Rows of every day of the partitioned table, from the footers of its files."""
    return footers.partition_counts(spark, *layout_path(spark, sf_dir, PICKUP), "yellow_tripdata_partitioned")


def q_count_trips_vendor_range(spark, sf_dir):
    df, _ = yellow_layout(spark, sf_dir, PICKUP)
    return count_trips(df, PICKUP, *LONG_RANGE, vendor=1)


def q_clustered_count(spark, sf_dir):
    df, _ = yellow_layout(spark, sf_dir, PICKUP, ("VendorID",))
    return count_trips(df, PICKUP, *LONG_RANGE, vendor=1)


# A few thousand trips a row group on tables whose days have but a few hundred.
TEST_BIN_ROWS, TEST_ROW_GROUP_ROWS = 20_000, 4_000


def yellow_compacted(spark, sf_dir) -> str:
    """Yellow raw trips by day, written and compacted once per session."""
    def run():
        path = scratch_path(spark, "yellow_bins")
        compaction.write_bins(testbed.yellow(spark, sf_dir), path, PICKUP)
        compaction.compact(spark, path, PICKUP, ["VendorID"], TEST_BIN_ROWS, TEST_ROW_GROUP_ROWS)
        return path
    return _memo(spark, ("bins", sf_dir), run)


def q_compacted_count(spark, sf_dir):
    """The vendor count on the compacted table (T4, T5)."""
    return count_trips(compaction.read_bins(spark, yellow_compacted(spark, sf_dir)), PICKUP, *LONG_RANGE, vendor=1)


def q_compacted_trips(spark, sf_dir):
    """Every row is still there after compaction."""
    return compaction.read_bins(spark, yellow_compacted(spark, sf_dir)).drop(f"{PICKUP}_bin")


def q_dropoff_clustered_count(spark, sf_dir):
    df, _ = yellow_layout(spark, sf_dir, YELLOW.dropoff, ("VendorID",))
    return count_trips(df, PICKUP, *LONG_RANGE, vendor=1)


def q_trip_extent(spark, sf_dir):
    """Global extent of the partitioned table: footers, folder names and two days of rows."""
    path, day = layout_path(spark, sf_dir, PICKUP)
    return footers.extent(spark, path, PICKUP, day)


def q_trip_extent_scan(spark, sf_dir):
    """The same over the raw trips, which have no such metadata."""
    return trip_extent(testbed.yellow(spark, sf_dir), PICKUP)


def q_zone_count(spark, sf_dir):
    """count(1) over an external table of the named zone source, through SQL."""
    from ridemart.sources.catalog import testbed_sources

    def run():
        path = scratch_path(spark, "zones")
        testbed_sources(sf_dir).get(spark, "taxi_zone_lookup").write.parquet(path)
        return path
    table = footers.footers(spark, _memo(spark, ("zones", sf_dir), run))
    register_external(table, "taxi_zone_lookup")
    return sql(table.sparkSession, "SELECT count(1) AS row_count FROM taxi_zone_lookup")


def q_staging_views(spark, sf_dir):
    """Staging models as views, counted by service through SQL."""
    for spec in (GREEN, YELLOW):
        as_view(staged(spark, sf_dir)[spec.label], f"stg_{spec.name}_tripdata")
    return sql(spark, """
        SELECT 'Green' AS service_type, count(*) AS trips, count(payment_type) AS with_payment_type FROM stg_green_tripdata
        UNION ALL SELECT 'Yellow', count(*), count(payment_type) FROM stg_yellow_tripdata""")


# ---- monthly load: row ids, insert-only merge, backfill --------------------------------

_RUNS: dict[tuple, object] = {}


def _memo(spark, key, fn):
    """Input files a query starts from (landed months, CSV copies) are written once a session; results never are."""
    k = (spark.sparkContext.applicationId,) + key
    if k not in _RUNS:
        _RUNS[k] = fn()
    return _RUNS[k]


def q_row_id_warehouse(spark, sf_dir):
    return stamp_rows(testbed.yellow(spark, sf_dir), YELLOW, YELLOW.file_name("1996-01", "parquet"), "warehouse")


def q_row_id_database(spark, sf_dir):
    return stamp_rows(testbed.yellow(spark, sf_dir), YELLOW, YELLOW.file_name("1996-01", "csv"), "database")


def _batch(trips, lo, hi, name):
    day = day_column(PICKUP)
    y = trips.where(F.to_date(PICKUP).between(F.lit(lo), F.lit(hi)))
    return stamp_rows(y, YELLOW, name).withColumn(day, F.to_date(PICKUP))


def merge_runs(spark, sf_dir):
    """Two overlapping batches that cover the whole table merged into an empty target, then the first batch again.

    The first batch holds the first two thirds of the days, its first third
    twice (months delivered in two files: every copy is inserted); the second
    batch holds the last two thirds. The trips are written to scratch once, and
    the batch that is merged twice is too.
    """
    trips = evaluated(testbed.yellow(spark, sf_dir), "merge_trips")
    lo, hi = trips.agg(F.min(F.to_date(PICKUP)), F.max(F.to_date(PICKUP))).first()
    third = (hi - lo) / 3
    a, b = lo + timedelta(days=third.days), lo + timedelta(days=2 * third.days)
    target = _bucketed_target(spark, "merge_target")
    b1 = _batch(trips, lo, b, "batch_1.parquet").unionByName(_batch(trips, lo, a, "batch_1.parquet"))
    b1, b2 = evaluated(b1, "merge_batch"), evaluated(_batch(trips, a, hi, "batch_2.parquet"), "merge_batch")
    return target, tuple(merge_new(spark, target, x, schema=target_schema(YELLOW), in_scratch=True) for x in (b1, b2, b1))


def _bucketed_target(spark, name):
    """An empty catalog table of loaded trips, bucketed on the row id, with its files in shared scratch."""
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    ensure_table(spark, table, target_schema(YELLOW), location=path, bucket_by="unique_row_id", buckets=_buckets(spark))
    return table


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q_merge_new_rows(spark, sf_dir):
    target, _ = merge_runs(spark, sf_dir)
    return spark.table(target).drop(day_column(PICKUP))


def q_merge_rerun_count(spark, sf_dir):
    _, (n1, n2, n3) = merge_runs(spark, sf_dir)
    return spark.createDataFrame([(n1, n2, n3)], "first_insert bigint, second_insert bigint, rerun_insert bigint")


def q_merge_batch_duplicates(spark, sf_dir):
    target, _ = merge_runs(spark, sf_dir)
    t = spark.table(target)         # bucketed on the id: counted without a shuffle
    return t.groupBy("unique_row_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def months_of(spark, sf_dir, fmt="parquet") -> list[str]:
    """First to last pickup month of the data, by the folders of the raw zone."""
    months = [n.removeprefix("month=") for n in Files(spark, raw_zone(spark, sf_dir, fmt)).names(YELLOW.name) if n.startswith("month=")]
    return months_between(min(months), max(months))


def raw_zone(spark, sf_dir, fmt="parquet"):
    """Yellow raw trips landed once per session in the raw zone, one folder per month."""
    def run():
        root = scratch_path(spark, f"raw_{fmt}")
        io.land_raw(testbed.yellow(spark, sf_dir), root, YELLOW, fmt=fmt)
        return root
    return _memo(spark, ("raw", sf_dir, fmt), run)


def _loaded(spark, target, variant="typed"):
    return spark.read.schema(target_schema(YELLOW, variant)).parquet(target).drop(day_column(PICKUP))


def q_backfill_months(spark, sf_dir):
    """Every month of the raw zone into one target."""
    months, target = months_of(spark, sf_dir), scratch_path(spark, "backfill_target")
    backfill(spark, YELLOW, months[0], months[-1], raw_zone(spark, sf_dir), target)
    return _loaded(spark, target)


def q_backfill_yearly(spark, sf_dir):
    """Every month into the consolidated target of its year."""
    months, root = months_of(spark, sf_dir), scratch_path(spark, "yearly")
    backfill(spark, YELLOW, months[0], months[-1], raw_zone(spark, sf_dir), root, per="year")
    out = None
    for y in sorted({m[:4] for m in months}):
        part = _loaded(spark, f"{root}/yellow_{y}").withColumn("target_table", F.lit(f"yellow_{y}"))
        out = part if out is None else out.unionByName(part)
    return out


def q_load_month_database(spark, sf_dir):
    """Every month through the staging-table flow (COPY, 7-part id), a year at a time, the first year twice."""
    root = raw_zone(spark, sf_dir, "csv")
    staging, target = scratch_path(spark, "staging"), _bucketed_target(spark, "db_target")
    years: dict[str, dict[str, str]] = {}
    for m in months_of(spark, sf_dir, "csv"):
        years.setdefault(m[:4], {})[m] = f"{root}/yellow/month={m}"
    for y in [*years, min(years)]:
        load_months_staged(spark, YELLOW, years[y], staging, target, buckets=_buckets(spark))
    return spark.table(target).drop(day_column(PICKUP))


def q_load_numeric_target(spark, sf_dir):
    """Every month into the target with NUMERIC amounts, text codes and a BYTES row id (shown as hex)."""
    root, target = raw_zone(spark, sf_dir), scratch_path(spark, "numeric_target")
    load_months(spark, YELLOW, {m: io.raw_month_path(root, YELLOW, m) for m in months_of(spark, sf_dir)}, target, variant="numeric")
    return _loaded(spark, target, "numeric").withColumn("unique_row_id", F.lower(F.hex("unique_row_id")))


def q_load_text_target(spark, sf_dir):
    """Every month into the target with text codes and double amounts."""
    root, target = raw_zone(spark, sf_dir), scratch_path(spark, "text_target")
    load_months(spark, YELLOW, {m: io.raw_month_path(root, YELLOW, m) for m in months_of(spark, sf_dir)}, target, variant="text")
    return _loaded(spark, target, "text")


def q_row_id_bytes(spark, sf_dir):
    """The row id as bytes, compared as hex."""
    return (stamp_rows(testbed.yellow(spark, sf_dir), YELLOW, YELLOW.file_name("1996-01", "parquet"), as_bytes=True)
            .withColumn("unique_row_id", F.lower(F.hex("unique_row_id"))))


# ---- data-quality checks ----------------------------------------------------------------

def _green_stg(spark, sf_dir):
    return q_stg_green_trips(spark, sf_dir)


def q_check_unique(spark, sf_dir):
    return Q.check_unique(_green_stg(spark, sf_dir), "tripid", "stg_green_tripdata")


def q_check_not_null(spark, sf_dir):
    return Q.check_not_null(_green_stg(spark, sf_dir), "tripid", "stg_green_tripdata")


def q_check_relationships(spark, sf_dir):
    g, seed = _green_stg(spark, sf_dir), testbed.zone_seed(spark, sf_dir)
    return (Q.check_relationships(g, "pickup_locationid", seed, "locationid", "stg_green_tripdata")
            .unionByName(Q.check_relationships(g, "dropoff_locationid", seed, "locationid", "stg_green_tripdata")))


def q_check_accepted_values(spark, sf_dir):
    return Q.check_accepted_values(_green_stg(spark, sf_dir), "payment_type", list(FULL.payment_type_values),
                                   "stg_green_tripdata")


def q_run_checks(spark, sf_dir):
    b = build(spark, {GREEN: testbed.green(spark, sf_dir), YELLOW: testbed.yellow(spark, sf_dir)},
              testbed.zone_seed(spark, sf_dir), scratch_path(spark, "build"), FULL)
    return b.checks


# ---- scans, sinks, conversions ----------------------------------------------------------

def _yellow_files(spark, sf_dir, gzip=False):
    def run():
        path = scratch_path(spark, "yellow_csv_gz" if gzip else "yellow_csv")
        io.write_csv(testbed.yellow(spark, sf_dir), path, gzip=gzip)
        return path
    return _memo(spark, ("csv", sf_dir, gzip), run)


def q_csv_roundtrip(spark, sf_dir):
    return io.read_trips_csv(spark, _yellow_files(spark, sf_dir), YELLOW)


def q_gzip_scan(spark, sf_dir):
    return io.read_trips_csv(spark, _yellow_files(spark, sf_dir, True) + "/*.csv.gz", YELLOW)


def q_parquet_glob(spark, sf_dir):
    return io.read_trips_parquet(spark, raw_zone(spark, sf_dir) + "/yellow/month=1996-*", YELLOW)


def q_csv_glob_list(spark, sf_dir):
    """A list of globs, one for each year."""
    root = raw_zone(spark, sf_dir, "csv") + "/yellow"
    years = sorted({m[:4] for m in months_of(spark, sf_dir, "csv")})
    return io.read_trips_csv(spark, [f"{root}/month={y}-*" for y in years], YELLOW)


def q_parquet_to_csv(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    months = [io.raw_month_path(root, YELLOW, m) for m in months_of(spark, sf_dir)]
    out = io.parquet_to_csv(spark, months, scratch_path(spark, "to_csv"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in YELLOW.raw_schema.fields])


def q_raw_zone(spark, sf_dir):
    return spark.read.parquet(raw_zone(spark, sf_dir) + "/yellow")


def q_csv_to_parquet(spark, sf_dir):
    src = scratch_path(spark, "green_csv")
    io.write_csv(testbed.green(spark, sf_dir), src)
    out = io.csv_to_parquet(spark, src, scratch_path(spark, "green_parquet"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GREEN.raw_schema.fields])


def q_copy_in_columns(spark, sf_dir):
    return io.copy_in(spark, _yellow_files(spark, sf_dir), YELLOW.raw_columns, target_schema(YELLOW))


def q_row_index(spark, sf_dir):
    y = testbed.yellow(spark, sf_dir)
    return io.with_row_index(y, y.columns)


def q_row_index_scan(spark, sf_dir):
    """Scan-order index over a shuffled frame: as many different numbers as rows, from 0 on."""
    x = io.with_row_index(testbed.yellow(spark, sf_dir).hint("rebalance", "PULocationID"))    # a hot zone is split
    return x.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("index").alias("different"),
                 F.min("index").alias("lowest"), F.max("index").alias("highest"))


def q_load_seed(spark, sf_dir):
    path = scratch_path(spark, "zone_seed_csv")
    testbed.zone_seed(spark, sf_dir).write.option("header", True).option("quoteAll", True).csv(path)
    return io.load_seed(spark, path)


def q_ingest_table(spark, sf_dir):
    src = _yellow_files(spark, sf_dir)
    text = spark.read.option("header", True).csv(src)  # every column as text
    target = scratch_path(spark, "ingest")
    io.ingest_table(text, target, ts_cols=(YELLOW.pickup, YELLOW.dropoff))
    t = spark.read.parquet(target)
    return t.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in YELLOW.raw_schema.fields])


def q_stg_green_dev_limit(spark, sf_dir):
    return preview(q_stg_green_trips(spark, sf_dir).orderBy("tripid"), FULL.dev_limit)


# ---- regression --------------------------------------------------------------------------

def features(spark, sf_dir):
    return ml.ml_table(testbed.yellow(spark, sf_dir))


def q_feature_columns(spark, sf_dir):
    """The model's columns as delivered."""
    return ml.select_features(testbed.yellow(spark, sf_dir))


def q_ml_feature_table(spark, sf_dir):
    return features(spark, sf_dir)


def q_feature_info(spark, sf_dir):
    return round_doubles(ml.feature_info(features(spark, sf_dir)))


def q_auto_split_counts(spark, sf_dir):
    train, ev = ml.auto_split(features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull()))
    return (train.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train").alias("split"), "rows")
            .unionByName(ev.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("eval").alias("split"), "rows")))


def q_tip_regression_one_feature(spark, sf_dir):
    """OLS of tip on fare over all labelled rows: slope, intercept, R²."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    x = features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull() & F.col("trip_distance").isNotNull())
    v = VectorAssembler(inputCols=["trip_distance"], outputCol="f").transform(x)
    m = LinearRegression(featuresCol="f", labelCol=ml.LABEL, solver="normal").fit(v)
    row = [(float(m.coefficients[0]), float(m.intercept), float(m.summary.r2))]
    return round_doubles(spark.createDataFrame(row, "slope double, intercept double, r2 double"), 10)


# Fixed coefficients for the oracle-checked evaluation and explanation.
FIXED_INTERCEPT = 0.03
FIXED_NUMERIC = {"trip_distance": (0.05, 0.05), "fare_amount": (1e-7, 50000.0),
                 "tolls_amount": (-2e-7, 4500.0), "passenger_count": (1e-5, 25.0)}
FIXED_PAYMENT = {"1": 0.002, "2": -0.001, "3": 0.0005, "4": -0.0015}
FIXED_PAYMENT_BASE, FIXED_PAYMENT_UNSEEN = 0.0001, 0.0


def fixed_terms() -> ml.LinearTerms:
    return ml.LinearTerms(FIXED_INTERCEPT, dict(FIXED_NUMERIC),
                          {"payment_type": (dict(FIXED_PAYMENT), FIXED_PAYMENT_BASE, FIXED_PAYMENT_UNSEEN)})


def q_evaluate_fixed_model(spark, sf_dir):
    x = features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull())
    pred = ml.explain_predict(fixed_terms(), x)
    return round_doubles(ml.evaluate(pred))


def q_explain_fixed_model(spark, sf_dir):
    x = features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull())
    e = ml.explain_predict(fixed_terms(), x, top_k_features=3)
    top = F.col("top_feature_attributions")
    cols = [*x.columns, ml.PREDICTION]
    for i in range(3):
        cols += [top[i]["feature"].alias(f"top{i + 1}_feature"), top[i]["attribution"].alias(f"top{i + 1}_attribution")]
    return round_doubles(e.select(*cols, "baseline_prediction_value"), 9)


def labelled(spark, sf_dir):
    return features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull())


def labelled_once(spark, sf_dir):
    """The labelled trips written to scratch once, for queries that train on them and then go over them again."""
    return evaluated(labelled(spark, sf_dir), "ml_labelled")


def payment_model(x):
    """The tip by payment type: with one categorical input least squares gives the mean of each category."""
    return ml.train_tip_model(x, numeric=[], categorical=["payment_type"])


def q_tip_model_predict(spark, sf_dir):
    x = labelled_once(spark, sf_dir)
    return round_doubles(ml.predict(payment_model(x), x))


def q_tip_model_evaluate(spark, sf_dir):
    """Metrics of the trained model on the rows it was not trained on."""
    x = labelled_once(spark, sf_dir)
    _, held = ml.auto_split(x)
    return round_doubles(ml.evaluate(ml.predict(payment_model(x), held)))


def q_tip_model_explain(spark, sf_dir):
    x = labelled_once(spark, sf_dir)
    train, _ = ml.auto_split(x)
    e = ml.explain_predict(ml.linear_terms(payment_model(x), train), x, top_k_features=3)
    top = F.col("top_feature_attributions")[0]
    return round_doubles(e.select(*x.columns, ml.PREDICTION, top["feature"].alias("top_feature"),
                                  top["attribution"].alias("top_attribution"), "baseline_prediction_value"))


def q_tip_model_residuals(spark, sf_dir):
    """The full model's residuals on its training rows, in total and against each number: zero up to rounding."""
    x = labelled_once(spark, sf_dir)
    model = ml.train_tip_model(x)
    train, _ = ml.auto_split(x)
    err = F.col(ml.PREDICTION) - F.col(ml.LABEL)
    means = {c: m for c, (_, m) in ml.linear_terms(model, train).numeric.items()}
    x = ml.predict(model, train).fillna(means)      # as the model imputes them
    sums = [F.abs(F.sum(err) / F.sum(F.abs(F.col(ml.LABEL)) + 1)).alias("intercept")]
    sums += [F.abs(F.sum(err * F.col(c)) / F.sum(F.abs(F.col(c)) * (F.abs(F.col(ml.LABEL)) + 1))).alias(c) for c in ml.NUMERIC]
    return round_doubles(x.agg(*sums))


def tuned(spark, sf_dir, **kw):
    return ml.tune_tip_model(features(spark, sf_dir), num_trials=5, max_parallel_trials=2, **kw)


def q_tip_model_trials(spark, sf_dir):
    """The five sampled trials and the split they are judged on."""
    _, trials = tuned(spark, sf_dir)
    return round_doubles(trials.select("trial_id", "l1_reg", "l2_reg", "reg_param", "elastic_net_param", "train_rows", "eval_rows"), 9)


def q_tip_model_certificate(spark, sf_dir):
    """What each trial's fit comes to, how far it is from its optimum, and which trial is chosen."""
    _, trials = tuned(spark, sf_dir)
    return round_doubles(trials.select("trial_id", "violation", "intercept_violation", "nonzero", "r2_score", "is_optimal"))


#: Penalties small enough for the test tables that some coefficients stay and some vanish.
FINE_L1 = (0.0, 0.0005)


def q_tip_model_certificate_fine(spark, sf_dir):
    """The certificate where penalties leave coefficients standing (l2 of 0 and more among the trials)."""
    _, trials = tuned(spark, sf_dir, l1_range=FINE_L1)
    return trials.select("trial_id", F.round("l1_reg", 9).alias("l1_reg"), (F.col("nonzero") > 0).alias("stands"),
                         F.round("violation", 5).alias("violation"), F.round("intercept_violation", 5).alias("intercept_violation"))


def q_tip_model_tuned(spark, sf_dir):
    """Predictions of the chosen tuned model."""
    best, _ = tuned(spark, sf_dir)
    return round_doubles(ml.predict(best, labelled(spark, sf_dir)))


def requests(spark, sf_dir):
    """One score request per labelled trip: {"instances": [{features}]}."""
    x = features(spark, sf_dir).where(F.col(ml.LABEL).isNotNull())
    inst = F.struct(*[F.col(c) for c in ml.FEATURE_SCHEMA.fieldNames()])
    return x.select(F.to_json(F.struct(F.array(inst).alias("instances"))).alias("request"))


def q_read_instances(spark, sf_dir):
    return io.read_instances(requests(spark, sf_dir), "request", ml.FEATURE_SCHEMA)


def q_score_instances(spark, sf_dir):
    path = scratch_path(spark, "tip_model")
    ml.save_model(payment_model(features(spark, sf_dir)), path)
    return round_doubles(ml.score_instances(ml.load_model(path), requests(spark, sf_dir), "request"))


def q_stream_scores(spark, sf_dir):
    """The same requests as files, scored by a drained file stream."""
    files = scratch_path(spark, "request_files")
    requests(spark, sf_dir).repartition(16).write.text(files)
    out = scratch_path(spark, "scores")
    ml.stream_scores(payment_model(features(spark, sf_dir)), files, out, scratch_path(spark, "scores_ckpt"), spark, files_per_trigger=6).awaitTermination()
    return round_doubles(spark.read.parquet(out))


# ---- streaming -----------------------------------------------------------------------------

def q_stream_months(spark, sf_dir):
    """Drain the landed raw zone through the file stream into a fresh target."""
    from ridemart.streaming.months import stream_months

    target = scratch_path(spark, "stream_target")
    q = stream_months(spark, YELLOW, raw_zone(spark, sf_dir), target, scratch_path(spark, "stream_ckpt"), files_per_trigger=24)
    q.awaitTermination()
    return _loaded(spark, target)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_green_trips": q_stg_green_trips,
    "stg_yellow_trips": q_stg_yellow_trips,
    "dim_zones": q_dim_zones,
    "trips_unioned": q_trips_unioned,
    "fact_trips": q_fact_trips,
    "monthly_zone_revenue": q_monthly_zone_revenue,
    "distinct_vendors_unpartitioned": q_distinct_vendors_unpartitioned,
    "distinct_vendors_june": q_distinct_vendors_partitioned,
    "partition_stats": q_partition_stats,
    "count_trips_vendor_range": q_count_trips_vendor_range,
    "clustered_count": q_clustered_count,
    "compacted_count": q_compacted_count,
    "compacted_trips": q_compacted_trips,
    "dropoff_clustered_count": q_dropoff_clustered_count,
    "trip_extent": q_trip_extent,
    "trip_extent_scan": q_trip_extent_scan,
    "zone_count": q_zone_count,
    "staging_views": q_staging_views,
    "row_id_warehouse": q_row_id_warehouse,
    "row_id_database": q_row_id_database,
    "merge_new_rows": q_merge_new_rows,
    "merge_rerun_count": q_merge_rerun_count,
    "merge_batch_duplicates": q_merge_batch_duplicates,
    "backfill_months": q_backfill_months,
    "load_month_database": q_load_month_database,
    "backfill_yearly": q_backfill_yearly,
    "load_numeric_target": q_load_numeric_target,
    "load_text_target": q_load_text_target,
    "row_id_bytes": q_row_id_bytes,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_relationships": q_check_relationships,
    "check_accepted_values": q_check_accepted_values,
    "run_checks": q_run_checks,
    "csv_roundtrip": q_csv_roundtrip,
    "gzip_scan": q_gzip_scan,
    "parquet_glob": q_parquet_glob,
    "csv_glob_list": q_csv_glob_list,
    "raw_zone": q_raw_zone,
    "parquet_to_csv": q_parquet_to_csv,
    "csv_to_parquet": q_csv_to_parquet,
    "copy_in_columns": q_copy_in_columns,
    "row_index": q_row_index,
    "row_index_scan": q_row_index_scan,
    "load_seed": q_load_seed,
    "ingest_table": q_ingest_table,
    "stg_green_dev_limit": q_stg_green_dev_limit,
    "feature_columns": q_feature_columns,
    "ml_feature_table": q_ml_feature_table,
    "feature_info": q_feature_info,
    "auto_split_counts": q_auto_split_counts,
    "tip_regression_one_feature": q_tip_regression_one_feature,
    "evaluate_fixed_model": q_evaluate_fixed_model,
    "explain_fixed_model": q_explain_fixed_model,
    "read_instances": q_read_instances,
    "tip_model_predict": q_tip_model_predict,
    "tip_model_evaluate": q_tip_model_evaluate,
    "tip_model_explain": q_tip_model_explain,
    "tip_model_residuals": q_tip_model_residuals,
    "tip_model_trials": q_tip_model_trials,
    "tip_model_certificate": q_tip_model_certificate,
    "tip_model_certificate_fine": q_tip_model_certificate_fine,
    "tip_model_tuned": q_tip_model_tuned,
    "score_instances": q_score_instances,
    "stream_scores": q_stream_scores,
    "stream_months": q_stream_months,
}
