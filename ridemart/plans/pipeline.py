"""Pipeline-level operators: monthly load, backfill, model build.

Each step is a distributed Spark job; the driver only loops over calendar
months (a bounded, ordered list) and over the declared checks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import day_of
from ridemart.operators import checks as Q
from ridemart.operators import ledger
from ridemart.operators.models import dim_zones, fact_trips, monthly_zone_revenue
from ridemart.operators.staging import stage_trips
from ridemart.operators.tables import (
    day_column,
    ensure_table,
    evaluated,
    merge_new,
    read_target,
    stamp_rows,
    target_name,
    truncate,
    with_comments,
    write_target,
)
from ridemart.sources.files import copy_in, raw_month_path, read_trips_csv, read_trips_parquet
from ridemart.specs import CODE_COLUMNS, COUNT_COLUMNS, TARGETS, Config, ServiceSpec


def target_schema(spec: ServiceSpec, variant: str = "typed") -> T.StructType:
    """Load target: row id and file name in front of the raw columns, plus the pickup day.

    ``variant`` names the declared types (``specs.TARGETS``): as delivered
    with a hex row id, NUMERIC amounts with text codes and a BYTES row id, or
    text codes with double amounts.
    """
    kind = TARGETS[variant]

    def declared(f: T.StructField) -> T.StructField:
        amount = isinstance(f.dataType, T.DoubleType) and f.name not in COUNT_COLUMNS
        new = kind.code if f.name in CODE_COLUMNS else kind.count if f.name in COUNT_COLUMNS else kind.amount if amount else None
        return T.StructField(f.name, new or f.dataType, True)

    head = [T.StructField("unique_row_id", kind.row_id, True), T.StructField("filename", T.StringType(), True)]
    tail = [T.StructField(day_column(spec.pickup), T.DateType(), True)]
    return with_comments(T.StructType(head + [declared(f) for f in spec.raw_schema.fields] + tail), spec.comments)


def _as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Hard casts to the target's types; further columns are kept."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def _from_first_month(batch: DataFrame, day: str) -> DataFrame:
    """A row id that occurs in several months of a batch stays with the earliest, with all its copies there.

    ``batch`` lies in scratch. Usually no id does, and the batch is returned as it is.
    Equal row ids imply equal pickups unless one side's pickup is NULL (see
    ``tables.merge_new``): without such trips only the ids of days that occur in
    several months are compared.
    """
    spans = batch.groupBy(day).agg(F.min("_month").alias("_first"), F.max("_month").alias("_last"))
    days = [r[0] for r in spans.where(F.col("_first") < F.col("_last")).select(day)
            .unionByName(spans.where(F.col(day).isNull()).select(day)).collect()]       # a row a calendar day
    if not days:
        return batch
    near = batch if None in days else batch.where(F.col(day).isin(days))
    seen = (near.groupBy("unique_row_id").agg(F.min("_month").alias("_first"), F.max("_month").alias("_last"))
            .where("_first < _last").select("unique_row_id", "_first"))
    seen = evaluated(seen, "repeated_ids")
    if seen.isEmpty():
        return batch
    later = batch.join(seen, "unique_row_id", "left")       # AQE broadcasts the few ids, or splits a hot one
    return later.where("_first is null or _month = _first").drop("_first")


#: The month that a raw-zone folder is named by.
MONTH_IN_PATH = r"/month=([0-9]{4}-[0-9]{2})/"


def read_month(spark: SparkSession, spec: ServiceSpec, src: str | list[str], fmt: str = "parquet", keep: Column | None = None) -> DataFrame:
    return read_trips_csv(spark, src, spec, keep=keep) if fmt == "csv" else read_trips_parquet(spark, src, spec, keep=keep)


def _of_month(values: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("_month"))


def read_months(spark: SparkSession, spec: ServiceSpec, sources: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """The raw trips of some months with their month in ``_month``: one scan if the folders are named by month.

    A plan with a scan for each of many months costs more to prepare than the months to read.
    """
    if len(sources) > 1 and all(re.search(rf"/month={m}/?$", src) for m, src in sources.items()):
        month = F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_PATH, 1).alias("_month")
        return read_month(spark, spec, [sources[m] for m in sorted(sources)], fmt, keep=month)
    parts = [read_month(spark, spec, sources[m], fmt).withColumn("_month", F.lit(m)) for m in sorted(sources)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def load_month(spark: SparkSession, spec: ServiceSpec, month: str, src: str, target: str,
               fmt: str = "parquet", filename: str | None = None) -> int:
    """Scan one month, stamp row id + file name, insert-only merge into the target.

    The target is day-partitioned on pickup, so the merge reads only the key
    column of the batch's days. Re-running a month inserts zero rows.
    Returns the number of rows inserted.
    """
    return load_months(spark, spec, {month: src}, target, fmt, filename)[month]


def load_months(spark: SparkSession, spec: ServiceSpec, sources: dict[str, str], target: str,
                fmt: str = "parquet", filename: str | None = None, variant: str = "typed") -> dict[str, int]:
    """Load some months (month -> folder or file) with one merge; the result is that of loading them in order.

    A row id that occurs in several of the months is taken from the earliest
    one only, with all its copies there, as separate loads would have it.
    A load that lost its driver or its files before is undone first, and loaded
    again (``operators.ledger``). Returns the rows inserted for each month.
    """
    day = day_column(spec.pickup)
    schema = target_schema(spec, variant)
    ensure_table(spark, target, schema, partition_by=[day])
    months = sorted(sources)
    about = {"sources": sources, "fmt": fmt, "filename": filename, "variant": variant}
    for load in ledger.settle(spark, target, months):       # finished, but some files are gone: load it again first
        load_months(spark, spec, load.about["sources"], target, load.about["fmt"], load.about["filename"], load.about["variant"])
    as_bytes = isinstance(schema["unique_row_id"].dataType, T.BinaryType)
    raw = read_months(spark, spec, sources, fmt)
    name = _of_month({m: filename or spec.file_name(m, fmt) for m in months})
    batch = stamp_rows(raw, spec, name, as_bytes=as_bytes, columns=[*spec.raw_columns, "_month"]).withColumn(day, day_of(spec.pickup))
    batch = evaluated(_as_declared(batch, schema), "load_batch")
    if len(months) > 1:
        batch = _from_first_month(batch, day)
    return merge_new(spark, target, batch, prune=(spec.pickup, day), partition_by=[day], schema=schema,
                     count_by=("_month", months), about=about, in_scratch=True)


def staging_schema(spec: ServiceSpec) -> T.StructType:
    """Staging table of the database flow: row id and file name, then the raw columns (no day)."""
    head = [T.StructField("unique_row_id", T.StringType(), True), T.StructField("filename", T.StringType(), True)]
    return T.StructType(head + list(spec.raw_schema.fields))


def load_month_staged(spark: SparkSession, spec: ServiceSpec, month: str, src_csv: str, staging: str,
                      target: str) -> int:
    """Database-style monthly load (N1, T7, S2, T8, T9), see :func:`load_months_staged`."""
    return load_months_staged(spark, spec, {month: src_csv}, staging, target)[month]


def load_months_staged(spark: SparkSession, spec: ServiceSpec, sources: dict[str, str], staging: str,
                       target: str, buckets: int = 0, location: str | None = None) -> dict[str, int]:
    """Database-style load of some months (month -> CSV) through one staging table.

    Truncate the staging table, COPY each month's CSV into it by column list
    (other columns NULL, the file name set), stamp every staging row with the
    seven-part row id, then insert-only merge into the target. The single
    staging table means loads run one at a time, as in the flow this follows.
    With ``buckets`` the target is a catalog table (at ``location``) without day
    folders, as that flow's table is, bucketed on the row id: merges into it
    shuffle the batch only. Returns the rows inserted for each month.
    """
    day = day_column(spec.pickup)
    ensure_table(spark, staging, staging_schema(spec))
    if buckets:
        ensure_table(spark, target, target_schema(spec), location=location, bucket_by="unique_row_id", buckets=buckets)
    else:
        ensure_table(spark, target, target_schema(spec), partition_by=[day])
    for load in ledger.settle(spark, target, sorted(sources)):
        load_months_staged(spark, spec, load.about["sources"], staging, target, buckets, location)
    truncate(spark, staging)
    names = {m: spec.file_name(m, "csv") for m in sorted(sources)}
    copied = None
    for m, name in names.items():
        part = copy_in(spark, sources[m], spec.raw_columns, staging_schema(spec)).withColumn("filename", F.lit(name))
        copied = part if copied is None else copied.unionByName(part)
    write_target(copied, staging)
    staged = read_target(spark, staging, staging_schema(spec))
    batch = stamp_rows(staged, spec, F.col("filename"), "database", columns=spec.raw_columns).withColumn(day, day_of(spec.pickup))
    month = F.element_at(F.create_map(*[F.lit(x) for m, name in names.items() for x in (name, m)]), F.col("filename"))
    batch = _from_first_month(evaluated(batch.withColumn("_month", month), "load_batch"), day)
    return merge_new(spark, target, batch, prune=None if buckets else (spec.pickup, day), partition_by=None if buckets else [day],
                     schema=target_schema(spec), count_by=("_month", list(names)), about={"sources": sources}, in_scratch=True)


def months_between(start: str, end: str) -> list[str]:
    """Inclusive list of ``yyyy-MM`` months."""
    y, m = int(start[:4]), int(start[5:7])
    ey, em = int(end[:4]), int(end[5:7])
    out = []
    while (y, m) <= (ey, em):
        out.append(date(y, m, 1).strftime("%Y-%m"))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def backfill(spark: SparkSession, spec: ServiceSpec, start: str, end: str, raw_root: str, target: str,
             fmt: str = "parquet", per: str | None = None, months_per_load: int = 48) -> dict[str, int]:
    """Load a month range in order from the raw zone.

    One writer per target. Up to ``months_per_load`` months share one merge
    (:func:`load_months`, whose result does not depend on that number). With
    ``per='year'`` (or ``'month'``) ``target`` is a root folder and each month
    goes to the consolidated table named from it, e.g. ``<root>/yellow_1996``.
    """
    out = {}
    todo: list[tuple[str, list[str]]] = []
    for m in months_between(start, end):
        dest = f"{target.rstrip('/')}/{target_name(spec, m, per)}" if per else target
        if not todo or todo[-1][0] != dest or len(todo[-1][1]) >= months_per_load:
            todo.append((dest, []))
        todo[-1][1].append(m)
    for dest, months in todo:
        out.update(load_months(spark, spec, {m: raw_month_path(raw_root, spec, m) for m in months}, dest, fmt))
    return out


@dataclass
class Build:
    staging: dict[str, DataFrame]
    zones: DataFrame
    fact: DataFrame
    mart: DataFrame
    checks: DataFrame


def build(spark: SparkSession, sources: dict[ServiceSpec, DataFrame], seed: DataFrame, out_root: str,
          config: Config = Config(), raise_on_error: bool = True) -> Build:
    """Build all models and run their checks.

    Staging, dimension, fact and mart are written as tables under
    ``out_root``, then the checks run on the written tables: one scan of a
    staging table serves all of its checks.
    """
    root = out_root.rstrip("/")
    staged = {}
    for spec, raw in sources.items():
        path = f"{root}/stg_{spec.name}_tripdata"
        write_target(stage_trips(raw, spec, config), path)
        staged[spec.label] = spark.read.parquet(path)
    write_target(dim_zones(seed), f"{root}/dim_zones")
    zones = spark.read.parquet(f"{root}/dim_zones")
    write_target(fact_trips(staged, zones), f"{root}/fact_trips")
    fact = spark.read.parquet(f"{root}/fact_trips")
    write_target(monthly_zone_revenue(fact), f"{root}/dm_monthly_zone_revenue")
    mart = spark.read.parquet(f"{root}/dm_monthly_zone_revenue")
    checks = model_checks(staged, seed, mart, config)
    return Build(staged, zones, fact, mart, Q.run_checks(checks, raise_on_error))


def model_checks(staged: dict[str, DataFrame], seed: DataFrame, mart: DataFrame, config: Config) -> list[DataFrame]:
    """The declared tests: green staging carries Q1-Q4, the mart total must not be NULL."""
    out = []
    if "Green" in staged:
        g, m = staged["Green"], "stg_green_tripdata"
        out.append(Q.table_checks(
            g, m, unique={"tripid": "warn"}, not_null={"tripid": "warn"},
            accepted={"payment_type": (list(config.payment_type_values), "warn")},
            relationships={c: (seed, "locationid", "warn") for c in ("pickup_locationid", "dropoff_locationid")}))
    out.append(Q.check_not_null(mart, "revenue_monthly_total_amount", "dm_monthly_zone_revenue", "error"))
    return out
