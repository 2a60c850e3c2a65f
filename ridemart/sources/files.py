"""Scans, sinks and conversions for trip files.

Every reader is a plain ``spark.read`` over files (globs and lists of globs
included), so the scan is split across tasks. gzip CSV is not splittable:
each file is one task, which is why ``read_trips_csv`` can repartition after
the scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import month_label, to_ts
from ridemart.operators.ledger import Files
from ridemart.session import scratch_path
from ridemart.specs import ZONE_SEED, ServiceSpec

CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
Paths = str | list[str]
_CORRUPT = "_corrupt_record"


def _as_text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _cast_to(df: DataFrame, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Hard casts (ANSI): a value that does not parse fails the job instead of turning NULL."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *keep)


def values_in_line(line: Column, escape: str = "\\") -> Column:
    """Number of values in a raw CSV line, read character by character as the parser does.

    A value that begins with a quote runs to the closing one; delimiters in it
    do not count. ``escape`` makes the next character of a quoted value plain;
    with the quote itself as escape a doubled quote stands for one. After a
    quote that neither closes the value nor is escaped, the value runs to the
    next delimiter.
    """
    begin, plain, quoted, quote, escaped = range(5)
    doubled = escape == '"'

    def step(state: Column, c: Column) -> Column:
        at = state["at"]
        cut = (c == ",") & at.isin(begin, plain, quote)
        next_ = (F.when(cut, begin)
                 .when(at == begin, F.when(c == '"', quoted).otherwise(plain))
                 .when(at == plain, plain)
                 .when(at == escaped, quoted)
                 .when(at == quoted, F.when(c == '"', quote).when(F.lit(not doubled) & (c == escape), escaped).otherwise(quoted))
                 .when((c == '"') & F.lit(doubled), quoted)
                 .when(c.isin(" ", "\t"), quote)
                 .otherwise(plain))
        return F.struct((state["n"] + cut.cast("int")).alias("n"), next_.cast("int").alias("at"))

    start = F.struct(F.lit(1).alias("n"), F.lit(begin).alias("at"))
    return F.aggregate(F.split(line, ""), start, step, lambda s: s["n"])


def read_trips_csv(spark: SparkSession, path: Paths, spec: ServiceSpec,
                   repartition: int | str | None = "auto", escape: str = "\\", keep: Column | None = None) -> DataFrame:
    """CSV scan with the declared raw schema.

    Columns map by position, one header row is skipped, extra trailing
    values are dropped, values are cast with ANSI casts. A row with fewer
    values than columns fails the job: PERMISSIVE mode hands rows of another
    width over in ``_corrupt_record``, and :func:`values_in_line` counts the
    values of those alone, quotes and escapes observed; this needs whole rows
    parsed, so column pruning is off in the parser. ``escape`` is the character
    that escapes a quote in a quoted value (the quote itself: doubled quotes).
    ``path`` may be a file, a glob or a list of globs; ``.csv.gz`` is read
    through the codec picked from the extension. A gzip file cannot be
    split, so one large file is one scan task; with ``repartition='auto'``
    input that holds gzip files (as the scan lists them) is rebalanced right
    after the scan (a ``REBALANCE`` that AQE cuts into advisory-sized
    partitions), so every later stage runs wide. ``keep`` adds a column, e.g.
    one of the scan's ``_metadata``.
    """
    schema = T.StructType([*_as_text_schema(spec.raw_schema).fields, T.StructField(_CORRUPT, T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", escape)
          .option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False).csv(path))
    need = len(spec.raw_columns)
    # (Spark refuses a query over the corrupt column alone, as a plain count would be: a data column comes along)
    short = F.when(F.col(_CORRUPT).isNotNull(), values_in_line(F.col(_CORRUPT), escape) < need).otherwise(F.lit(False))
    short = short & (F.coalesce(F.length(spec.raw_columns[0]), F.lit(0)) >= 0)
    df = df.where(F.when(short, F.raise_error(F.concat(F.lit(f"fewer than {need} values: "), F.col(_CORRUPT))).cast("boolean"))
                  .otherwise(F.lit(True)))
    packed = repartition == "auto" and any(f.endswith(".gz") for f in df.inputFiles())
    if keep is not None:
        df = df.select("*", keep)       # (a scan's metadata has to be taken before an exchange)
    if packed:
        df = df.hint("rebalance")
    elif repartition and repartition != "auto":
        df = df.repartition(int(repartition))
    return _cast_to(df, spec.raw_schema, [c for c in df.columns if c not in schema.fieldNames()])


def copy_in(spark: SparkSession, path: Paths, columns: list[str], target_schema: T.StructType) -> DataFrame:
    """COPY-style load (S2): the file holds ``columns`` in that order; other target columns are NULL.

    FAILFAST: a row with a missing or extra value aborts the load, as COPY does.
    """
    types = {f.name.lower(): f.dataType for f in target_schema.fields}
    file_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = spark.read.schema(file_schema).option("header", True).option("mode", "FAILFAST").csv(path)
    by_lower = {c.lower(): c for c in columns}
    out = []
    for f in target_schema.fields:
        src = by_lower.get(f.name.lower())
        out.append((F.col(src).cast(f.dataType) if src else F.lit(None).cast(types[f.name.lower()])).alias(f.name))
    return df.select(*out)


def read_csv_inferred(spark: SparkSession, path: Paths) -> DataFrame:
    """CSV scan with header and inferred types (S4). Inference costs one extra pass."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_trips_parquet(spark: SparkSession, path: Paths, spec: ServiceSpec, keep: Column | None = None) -> DataFrame:
    """Parquet scan (single file, glob or list of globs) with the declared raw schema.

    The schema is declared, not taken from a footer: a file that lacks a
    column gives NULL for its own rows only, and a file whose type cannot be
    read as the declared one fails the scan. ``keep`` adds a column.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.schema(spec.raw_schema).parquet(*paths)
    return df if keep is None else df.select(*spec.raw_columns, keep)


def load_seed(spark: SparkSession, path: str, schema: T.StructType = ZONE_SEED) -> DataFrame:
    """Lookup CSV (quoted fields) -> typed table."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)


def write_csv(df: DataFrame, path: str, gzip: bool = False, mode: str = "overwrite") -> None:
    """CSV sink with a header row and taxi-style timestamps."""
    w = (df.write.mode(mode).option("header", True).option("timestampFormat", CSV_TS_FORMAT)
         .option("timestampNTZFormat", CSV_TS_FORMAT))
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)


def csv_to_parquet(spark: SparkSession, src: Paths, dst: str,
                   force_double: tuple[str, ...] = ("ehail_fee",)) -> DataFrame:
    """CSV (inferred types) -> Parquet; listed columns forced to DOUBLE when present.

    An all-empty column infers as STRING; forcing it keeps the Parquet type numeric.
    """
    df = read_csv_inferred(spark, src)
    for c in force_double:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(T.DoubleType()))
    df.write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def parquet_to_csv(spark: SparkSession, src: Paths, dst: str) -> DataFrame:
    """Parquet -> CSV with header, no index column."""
    paths = [src] if isinstance(src, str) else list(src)
    write_csv(spark.read.parquet(*paths), dst)
    return spark.read.option("header", True).csv(dst)


def raw_month_path(root: str, spec: ServiceSpec, month: str) -> str:
    return f"{root.rstrip('/')}/{spec.name}/month={month_label(month)}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    jvm = spark._jvm.org.apache.hadoop.fs
    p = jvm.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def land_raw(df: DataFrame, root: str, spec: ServiceSpec, month: str | None = None,
             fmt: str = "parquet") -> str:
    """Land trips in the raw zone under service/month.

    With ``month`` the frame is that month's delivery, whatever its pickup
    times say: a stray trip or one without a pickup time stays in the month
    that delivered it, and only that month's folder is overwritten.

    Without it the frame is a history of several months, split by the pickup
    month in one job; trips without a pickup time go to the earliest month.
    Such a landing only creates months: if one of them has a folder already
    nothing is landed and ``FileExistsError`` names it. The frame is evaluated
    once: its rows are written aside, and the months they turn out to hold are
    then moved into the raw zone.
    """
    spark = df.sparkSession
    base = f"{root.rstrip('/')}/{spec.name}"
    if month is not None:
        path = raw_month_path(root, spec, month)
        sized = df.hint("rebalance")  # file count follows the data size, not the input splits
        if fmt == "csv":
            write_csv(sized, path)
        else:
            sized.write.mode("overwrite").parquet(path)
        return path
    x = df.withColumn("month", F.date_format(F.col(spec.pickup), "yyyy-MM"))
    # REBALANCE: AQE sizes the write tasks from real data, splitting a hot
    # month over several tasks and packing small months into one file.
    w = x.hint("rebalance", "month").write.partitionBy("month")
    files, aside = Files(spark, root), f"_landing_{spec.name}_{uuid.uuid4().hex[:12]}"
    try:
        if fmt == "csv":
            w.option("header", True).option("timestampFormat", CSV_TS_FORMAT).csv(f"{files.root}/{aside}")
        else:
            w.parquet(f"{files.root}/{aside}")
        undated = f"{aside}/month=__HIVE_DEFAULT_PARTITION__"
        months = sorted(n for n in files.names(aside) if n.startswith("month=") and not undated.endswith(n))
        if not months:
            raise ValueError("no pickup time in the whole frame: name the month it was delivered for")
        taken = [m.removeprefix("month=") for m in months if files.exists(f"{spec.name}/{m}")]
        if taken:
            raise FileExistsError(f"months landed before: {', '.join(taken)}; land each file as its month instead")
        for n in sorted(files.names(undated)):      # a task names its files alike in every folder
            if n.startswith("part-"):
                files.move(f"{undated}/{n}", f"{aside}/{months[0]}/{n.replace('part-', 'part-undated-', 1)}")
        files.make(spec.name)
        files.each(lambda m: files.move(f"{aside}/{m}", f"{spec.name}/{m}"), months)
    finally:
        files.delete(aside)
    return base


def ingest_table(df: DataFrame, target: str, ts_cols: tuple[str, ...] = (), mode: str = "overwrite",
                 jdbc_properties: dict[str, str] | None = None) -> DataFrame:
    """Bulk table load (S15, F3): parse timestamp columns, write all chunks in one job.

    The schema-only create and the chunk appends of a row-by-row sink are one
    distributed write here; Spark's scan splits are the chunks. A ``jdbc:``
    target ``"jdbc:...url...#table"`` is written with ``DataFrameWriter.jdbc``
    in batches of 100,000 rows from every task in parallel.
    """
    for c in ts_cols:
        if c in df.columns and not isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(c, to_ts(c))
    if target.startswith("jdbc:"):
        url, table = target.rsplit("#", 1)
        props = {"batchsize": "100000", **(jdbc_properties or {})}
        df.write.jdbc(url, table, mode=mode, properties=props)
        return df
    w = df.write.mode(mode).format("parquet")
    if "/" in target or ":" in target:
        w.save(target)
    else:
        w.saveAsTable(target)
    return df


def with_row_index(df: DataFrame, order_by: list[str] | None = None, name: str = "index") -> DataFrame:
    """Add a 0-based row index in ``order_by`` order, or in scan order when None.

    Distributed: rows are range-partitioned and sorted (or taken as they come)
    and written once to shared scratch with their partition and place in it;
    a running sum over the partitions' counts gives each its offset. Counts
    and rows come from those files, so both see the same evaluation of the
    input. No single task ever sees all rows.
    """
    spark = df.sparkSession
    x = df
    if order_by:
        rest = [c for c in df.columns if c not in order_by]
        # hash, then a per-row id: identical rows (a hot "key" of raw duplicates) still spread out
        x = x.withColumn("_spread", F.monotonically_increasing_id())
        x = (x.repartitionByRange(*[F.col(c) for c in order_by], F.xxhash64(*[F.col(c) for c in df.columns]),
                                  F.col("_spread"))
              .sortWithinPartitions(*order_by, *rest).drop("_spread"))
    x = x.withColumn("_mid", F.monotonically_increasing_id())
    path = scratch_path(spark, "row_index")
    x.write.parquet(path)
    x = spark.read.schema(x.schema).parquet(path).withColumn("_pid", F.shiftright("_mid", 33))
    counts = x.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = x.join(F.broadcast(offsets), "_pid")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return out.select((F.col("_off") + pos).alias(name), *df.columns)


def schema_ddl(df: DataFrame) -> str:
    """Schema as DDL text."""
    return df.schema.toDDL()


def read_instances(df: DataFrame, col: str, feature_schema: T.StructType) -> DataFrame:
    """Score requests ``{"instances": [{...}, ...]}`` -> one row per instance."""
    req = T.StructType([T.StructField("instances", T.ArrayType(feature_schema), True)])
    return df.select(F.inline(F.from_json(F.col(col), req)["instances"]))
