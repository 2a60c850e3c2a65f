"""Spark-side helpers shared by the operators: documents in, intermediate tables, Arrow output."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import ridemart
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.session import scratch_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(ridemart.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="ridemart-py-")) / "ridemart.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: one evaluation, no lineage to lose."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slim(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), whatever other columns the frame has; ready for Python tasks."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def task_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(id, th): what tells rows apart; a null doc_id has an id of its own."""
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("id"),
            F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("th")]


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, th): every row as a struct beside its key, so that no column name can clash."""
    return docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, doc_id, text): rows that agree on (id, th) are repeated rows and get equal results."""
    return slim(docs, id_col, text_col).select(*row_key(), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
