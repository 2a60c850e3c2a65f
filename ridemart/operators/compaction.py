"""Compaction of day folders: many small folders of old days become few, sorted by a cluster column (T4, T5).

A table for this is partitioned by ``<time column>_bin``: the first day that a
folder holds. A new day is a bin of its own; :func:`compact` packs
consecutive old bins into ones of about ``bin_rows`` rows, sorted by the
cluster columns, in row groups of ``row_group_rows``, so that a filter on the
cluster column skips most row groups even where a single day would not fill
one. Date filters find the bins they need by the folder names
(``plans.pruning``).

The swap is recorded like a load (``ledger``): the new files are written
aside, listed in a record together with the files they replace, and moved
into place; a marker then makes them count, and only then are the old ones
removed. At any time :func:`hidden_files` names the files that do not count,
and :func:`read_bins` leaves them out: a reader sees the old folders or the
new ones, never both. What a lost driver leaves is undone, or finished if the
marker is there, by the next call.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.functions import day_of
from ridemart.operators.ledger import FOLDER, Files, Table, stage
from ridemart.plans.footers import footers
from ridemart.plans.joins import maybe_broadcast
from ridemart.plans.pruning import bin_column

BIN_ROWS = 4_000_000
ROW_GROUP_ROWS = 250_000


def write_bins(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> None:
    """Write rows with every day as a bin of its own."""
    name = bin_column(ts_col)
    (df.withColumn(name, day_of(ts_col)).hint("rebalance", name).sortWithinPartitions(name)
     .write.mode(mode).partitionBy(name).parquet(path))


def packed(counts: list[tuple[date, int]], bin_rows: int, before: date | None = None) -> list[list[date]]:
    """Consecutive bins that together hold ``bin_rows`` rows at most (one bin may hold more), in order."""
    out, rows = [], 0
    for day, n in sorted(counts):
        if before is not None and day >= before:
            break
        if not out or rows + n > bin_rows:
            out.append([])
            rows = 0
        out[-1].append(day)
        rows += n
    return out


def _records(files: Files) -> list[tuple[str, dict, bool]]:
    names = files.names(FOLDER)
    return [(n[:-5], json.loads(files.read(f"{FOLDER}/{n}")), f"{n[:-5]}.done" in names) for n in sorted(names) if n.startswith("compact_") and n.endswith(".json")]


def hidden_files(spark: SparkSession, path: str) -> list[str]:
    """Files (folder and name) that do not count: new ones before the marker of their compaction, replaced ones after it."""
    return [f for _, r, done in _records(Files(spark, path)) for f in r["replaces" if done else "files"]]


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows, also while a compaction is going on or has been cut short."""
    df = spark.read.parquet(path)
    hidden = hidden_files(spark, path)
    return df.where(~F.substring_index("_metadata.file_path", "/", -2).isin(hidden)) if hidden else df


def _finish(files: Files, name: str, record: dict) -> None:
    """Remove what a marked compaction has replaced, then its record."""
    kept = {f.rpartition("/")[0] for f in record["files"]}
    files.each(files.delete, {f if (folder := f.rpartition("/")[0]) in kept else folder for f in record["replaces"]})
    files.delete(f"{FOLDER}/{name}")
    files.delete(f"{FOLDER}/{name}.json")
    files.delete(f"{FOLDER}/{name}.done")


def settle(spark: SparkSession, path: str) -> None:
    """Undo compactions without their marker, finish those that have it."""
    files = Files(spark, path)
    for name, record, done in _records(files):
        if done:
            _finish(files, name, record)
        else:
            for f in record["files"]:
                files.delete(f)
            files.delete(f"{FOLDER}/{name}")
            files.delete(f"{FOLDER}/{name}.json")
    for n in files.names(FOLDER):
        if n.startswith("compact_"):
            files.delete(f"{FOLDER}/{n}")


def compact(spark: SparkSession, path: str, ts_col: str, cluster_by: list[str], bin_rows: int = BIN_ROWS,
            row_group_rows: int = ROW_GROUP_ROWS, before: date | None = None) -> dict[date, list[date]]:
    """Pack the bins that begin before ``before`` (default: all) and swap them in; new bin -> the bins it replaces.

    Bins that stay alone are left as they are. Rows per bin come from the
    footers; the driver handles a row per folder. The bins packed are read
    and written once, each by as many tasks as its size asks for.
    """
    settle(spark, path)
    name = bin_column(ts_col)
    counts = footers(spark, path).groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col(name).isNotNull()).collect()
    groups = {g[0]: g for g in packed([(r[0], r.n) for r in counts], bin_rows, before) if len(g) > 1}
    if not groups:
        return {}
    old = spark.read.parquet(path)
    first = spark.createDataFrame([(d, k) for k, g in groups.items() for d in g], f"{name} date, _first date")
    rows = old.where(F.col(name).isin([d for g in groups.values() for d in g]))
    root = path.rstrip("/")
    gone = {f"{name}={d}" for g in groups.values() for d in g}
    replaces = [f for f in (_relative(f, name) for f in old.inputFiles()) if f.split("/")[0] in gone]
    new = (rows.join(maybe_broadcast(first), name).drop(name).withColumnRenamed("_first", name).select(*old.columns)
           .hint("rebalance", name).sortWithinPartitions(name, *cluster_by, ts_col))
    load_id = f"compact_{uuid.uuid4().hex[:12]}"
    made = stage(spark, Table(root), new, load_id, [name], {"parquet.block.row.count.limit": str(row_group_rows)})
    files = Files(spark, root)
    files.write(f"{FOLDER}/{load_id}.json", json.dumps({"files": made, "replaces": replaces}))
    for f in made:
        files.move(f"{FOLDER}/{load_id}/rows/{f}", f)           # into the folder of the bin's first day
    files.write(f"{FOLDER}/{load_id}.done", "")
    _finish(files, load_id, {"files": made, "replaces": replaces})
    return groups


def _relative(uri: str, name: str) -> str:
    folder, _, file = uri.rpartition("/")
    return f"{folder[folder.rindex(name + '='):]}/{file}"
