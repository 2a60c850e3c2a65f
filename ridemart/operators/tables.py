"""Table definition and change: create, materialise with layout, truncate, stamp, insert-only merge.

A *target* is either a path (anything containing '/' or ':', e.g. a folder
under the shared ``spark.checkpoint.dir``) or a catalog table name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import day_of, month_label, row_id
from ridemart.operators import ledger
from ridemart.session import scratch_path
from ridemart.specs import ServiceSpec


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def read_target(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a target; with ``schema`` an empty (just created) path target reads as zero rows.

    A reader beside a running load leaves its files out with ``ledger.finished``.
    """
    if not is_path(target):
        return spark.table(target)
    return spark.read.schema(schema).parquet(target) if schema is not None else spark.read.parquet(target)


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None):
    w = df.write.mode(mode).format("parquet")
    return w.partitionBy(*partition_by) if partition_by else w


def write_target(df: DataFrame, target: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = _writer(df, mode, partition_by)
    if is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


def with_comments(schema: T.StructType, comments: dict[str, str]) -> T.StructType:
    """Attach column descriptions as field metadata."""
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable,
                      dict(f.metadata or {}, **({"comment": comments[f.name]} if f.name in comments else {})))
        for f in schema.fields
    ])


def ensure_table(spark: SparkSession, target: str, schema: T.StructType,
                 partition_by: list[str] | None = None, location: str | None = None,
                 bucket_by: str | None = None, buckets: int = 0) -> None:
    """Create an empty typed table if it does not exist yet (T1). Existing data is kept.

    A catalog table may be bucketed on the merge key (``bucket_by``, ``buckets``;
    rows are sorted by it within a bucket file): a merge then reads the target's
    keys bucket by bucket, without shuffling them.

    A catalog table (``target`` without '/') may be given a ``location``, e.g. a
    folder under the shared ``spark.checkpoint.dir``; its day partitions are
    then tracked by the catalog, so a day-restricted read (the merge) lists
    only the selected day folders instead of the whole table.
    """
    empty = spark.createDataFrame([], schema)
    if is_path(target):
        if buckets:
            raise ValueError("only a catalog table can be bucketed")
        if not ledger.Files(spark, target).exists(""):
            _writer(empty, "ignore", partition_by).save(target)
        return
    w = _writer(empty, "ignore", partition_by)
    if buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(target)


def truncate(spark: SparkSession, target: str, partition_by: list[str] | None = None) -> None:
    """Remove all rows, keep the schema (T7); ``partition_by`` names a path target's partition columns."""
    if is_path(target):
        schema = spark.read.parquet(target).schema
        _writer(spark.createDataFrame([], schema), "overwrite", partition_by).save(target)
    else:
        spark.sql(f"TRUNCATE TABLE {target}")


def register_external(df: DataFrame, name: str) -> DataFrame:
    """Register / replace a named, file-backed view."""
    df.createOrReplaceTempView(name)
    return df


as_view = register_external


def day_column(ts_col: str) -> str:
    """Name of the derived day-partition column for ``ts_col``."""
    return f"{ts_col}_day"


#: Bytes of the plan's size estimate for one range of a clustered write, and the most ranges.
RANGE_BYTES = 256 << 20
MAX_RANGES = 200_000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the frame (file sizes scaled by its projections); 0 where it knows nothing."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def layout_frame(df: DataFrame, day_of_col: str | None = None, cluster_by: list[str] | None = None,
                 num_partitions: int | None = None) -> tuple[DataFrame, str | None]:
    """The frame ``materialize`` writes, with its derived day column (or None).

    * ``day_of_col``: a timestamp column; a ``<col>_day`` DATE column is added
      and used as the directory partition, so date filters prune directories.
      Without clustering the rows go through a ``REBALANCE`` on the day: AQE
      cuts the shuffle output into advisory-sized tasks, so a hot day is split
      over several tasks and small days share one.
    * ``cluster_by``: columns to cluster within each day. Rows are
      range-partitioned on (day, cluster..., row hash) into ``num_partitions``
      ranges (default: the plan's size estimate / ``RANGE_BYTES``, at least
      ``spark.sql.shuffle.partitions``) and sorted the same way inside each
      task, so each file and row group covers a narrow range of the cluster
      columns and Parquet min/max statistics skip the rest.

    The trailing row hash lets the range partitioner split a hot (day,
    cluster) group across tasks; it is a function of the row, so a task rerun
    after a lost executor sends every row where it went before. Rows equal in
    every column share a range.
    """
    day = None
    if day_of_col:
        day = day_column(day_of_col)
        df = df.withColumn(day, day_of(day_of_col))
    order = ([day] if day else []) + list(cluster_by or [])
    if cluster_by:
        keys: list[Column] = [F.col(c) for c in order] + [F.xxhash64(*[F.col(c) for c in df.columns])]
        # an explicit count: AQE would otherwise merge neighbouring ranges of a small
        # table into a couple of tasks, each writing thousands of day folders serially
        n = num_partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                  min(estimated_bytes(df) // RANGE_BYTES, MAX_RANGES))
        df = df.repartitionByRange(n, *keys)
        df = df.sortWithinPartitions(*order)
    elif day:
        df = df.hint("rebalance", day).sortWithinPartitions(day)
    return df, day


def materialize(df: DataFrame, target: str, day_of_col: str | None = None,
                cluster_by: list[str] | None = None, num_partitions: int | None = None) -> str | None:
    """Create-or-replace a table from ``df`` (T3), partitioned by day (T4), clustered (T5).

    The layout is ``layout_frame``'s. Returns the derived day column name (or None).
    """
    out, day = layout_frame(df, day_of_col, cluster_by, num_partitions)
    write_target(out, target, "overwrite", [day] if day else None)
    return day


def partition_stats(df: DataFrame, partition_col: str, table_name: str) -> DataFrame:
    """Rows per partition, largest first (T10, A9, L1): table_name, partition_id, total_rows."""
    return (df.groupBy(F.col(partition_col).alias("_p")).agg(F.count(F.lit(1)).alias("total_rows"))
              .select(F.lit(table_name).alias("table_name"),
                      F.date_format(F.col("_p"), "yyyyMMdd").alias("partition_id"),
                      "total_rows")
              .orderBy(F.col("total_rows").desc(), F.col("partition_id")))


def stamp_rows(df: DataFrame, spec: ServiceSpec, filename: str | Column, variant: str = "warehouse",
               as_bytes: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Put ``unique_row_id`` and ``filename`` in front of every row.

    ``variant='warehouse'`` hashes five parts, ``'database'`` seven.
    ``filename`` is a constant or a per-row column; ``columns`` (default: all of
    ``df``) are the data columns kept after the two stamps.
    """
    parts = spec.warehouse_id_columns if variant == "warehouse" else spec.database_id_columns
    name = F.lit(filename) if isinstance(filename, str) else filename
    return df.select(row_id(parts, as_bytes).alias("unique_row_id"), name.alias("filename"),
                     *(columns or df.columns))


def evaluated(df: DataFrame, name: str) -> DataFrame:
    """The frame written to shared scratch and read back: one evaluation, whatever reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_rows(spark: SparkSession, target: str, batch: DataFrame, key: str = "unique_row_id",
             prune: tuple[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The batch rows whose key is not in the target (J2), see :func:`merge_new`."""
    if ledger.is_empty(spark, target):
        return batch
    existing = read_target(spark, target, schema)
    table = ledger.described(spark, target)
    if table.buckets and table.bucket_by == [key]:
        # the batch moves into the target's buckets; the target's keys stay where they are
        return (batch.repartition(table.buckets, key)
                .join(existing.select(key).hint("merge"), on=key, how="left_anti"))
    if prune is None:
        return batch.join(existing.select(key), on=key, how="left_anti")
    ts_col, day_col = prune
    days = [r[0] for r in batch.select(day_of(ts_col)).distinct().collect()]
    held = ledger.Files(spark, table.root).names()
    if None not in days and not held & {f"{day_col}={d}" for d in (*days, "__HIVE_DEFAULT_PARTITION__")}:
        return batch            # days the target has no folder for: nothing to compare with
    near = existing.where(F.col(day_col).isin([d for d in days if d is not None]) | F.col(day_col).isNull())
    out = batch.where(F.col(ts_col).isNotNull()).join(near.select(key), on=key, how="left_anti")
    if None in days:
        out = out.unionByName(batch.where(F.col(ts_col).isNull()).join(existing.select(key), on=key, how="left_anti"))
    return out


def merge_new(spark: SparkSession, target: str, batch: DataFrame, key: str = "unique_row_id",
              prune: tuple[str, str] | None = None, partition_by: list[str] | None = None,
              schema: T.StructType | None = None, count_by: tuple[str, list[str]] | None = None,
              about: dict | None = None, in_scratch: bool = False) -> int | dict[str, int]:
    """Insert-only MERGE: append the batch rows whose key is not in the target.

    Existing rows are never changed; duplicates inside the batch are all
    inserted when their key is new (no dedup of the batch); running the same
    batch twice inserts nothing. Only the key column of the target is read,
    and nothing of a target that is still empty.
    The batch must carry the target's columns (derived partition columns
    included); it is evaluated once, into shared scratch (``in_scratch``: it
    is there already).

    ``prune=(batch_ts_col, target_day_col)``: the target is day-partitioned on
    the pickup timestamp. Equal row ids imply equal pickup text unless one
    side's pickup is NULL, so timed batch rows are compared with the batch's
    own days (a list of calendar days; a stray day adds that day only) plus
    NULL-day rows, and directory pruning skips every other day. Batch rows
    without a pickup are compared apart, with the whole target. Like the row
    ids themselves (timestamp text), this assumes every load runs in the same
    session time zone (UTC here).

    A target bucketed on the key is compared bucket by bucket instead: only the
    batch is shuffled.

    The rows are appended through the load ledger (``ledger``): a driver lost
    on the way leaves nothing that the next merge doesn't find and undo.
    ``about`` is kept with the load's record.

    Returns the number of rows inserted, or with ``count_by=(column, values)``
    that number for each of these values of a batch column.
    """
    batch = batch if in_scratch else evaluated(batch, "merge_batch")
    months = count_by[1] if count_by else []
    for load in ledger.settle(spark, target, months):
        raise ledger.Damaged(load)
    table = ledger.described(spark, target)
    rows = new_rows(spark, target, batch, key, prune, schema)
    obs = Observation()
    counts = [F.count(F.lit(1)).alias("inserted")]
    if count_by:
        counts = [F.count_if(F.col(count_by[0]) == v).alias(v) for v in count_by[1]]
    if partition_by and not table.buckets:
        # one writer per day instead of every task writing into every day it saw;
        # AQE still splits a hot day into several advisory-sized tasks
        rows = rows.hint("rebalance", *partition_by)
    elif table.buckets and ledger.is_empty(spark, target):
        rows = rows.repartition(table.buckets, *table.bucket_by)       # a file a bucket, not one a task and bucket
    columns = read_target(spark, target, schema).columns if not (is_path(target) and schema is not None) else schema.fieldNames()
    # above the shuffle: AQE drops an empty stage together with a metric inside it
    rows = rows.observe(obs, *counts).select(*columns)

    def counted() -> dict[str, int]:
        got = obs.get
        return {v: int(got.get(v, 0)) for v in (count_by[1] if count_by else ["inserted"])}

    inserted = ledger.append(spark, target, rows, partition_by, months, about or {}, counted)
    return inserted if count_by else inserted["inserted"]


def target_name(spec: ServiceSpec, month: str, per: str = "year") -> str:
    """Consolidated target name, e.g. ``green_2019`` per year or ``green_tripdata`` for all."""
    if per == "year":
        return f"{spec.name}_{month_label(month, 'yyyy')}"
    if per == "month":
        return f"{spec.name}_taxi_{month_label(month, 'yyyy_MM')}"
    return f"{spec.name}_tripdata"
