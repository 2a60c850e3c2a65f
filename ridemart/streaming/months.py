"""Incremental pick-up of landed month files.

A Structured Streaming file source watches the raw zone of one service. The
unit of loading is the month: a micro-batch only tells which months have new
files, and each of these months is loaded from its whole folder with the same
merge as the batch load. So the number of files a trigger takes changes the
number of micro-batches, not the rows: copies of a trip in two files of one
month are both inserted, as :func:`load_months` inserts them. Land a month
completely before its folder shows up in the raw zone (a write job does).

The stream's checkpoint records which files are done, so a restart continues
where it stopped, and a month loaded again inserts nothing. Appends go through
the load ledger: if the driver dies while a load's files are being committed,
the repeated micro-batch finds the unfinished load, undoes it and loads the
month anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators.tables import day_column, ensure_table
from ridemart.plans.pipeline import load_months, target_schema
from ridemart.sources.files import raw_month_path
from ridemart.specs import ServiceSpec

MONTH_IN_PATH = r"month=([0-9]{4}-[0-9]{2})"


def stream_months(spark: SparkSession, spec: ServiceSpec, raw_root: str, target: str, checkpoint: str,
                  files_per_trigger: int = 1, available_now: bool = True):
    """Start the stream; with ``available_now`` it drains all landed files and stops.

    Returns the ``StreamingQuery`` (call ``awaitTermination()`` to wait).
    """
    day = day_column(spec.pickup)
    schema = target_schema(spec)
    ensure_table(spark, target, schema, partition_by=[day])
    src = (spark.readStream.schema(spec.raw_schema).option("maxFilesPerTrigger", files_per_trigger)
           .option("recursiveFileLookup", True).parquet(f"{raw_root.rstrip('/')}/{spec.name}"))
    src = src.withColumn("_month", F.regexp_extract(F.input_file_name(), MONTH_IN_PATH, 1))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        months = sorted(r[0] for r in batch.select("_month").distinct().collect())      # a row a calendar month
        if "" in months:
            raise ValueError(f"files outside a month folder under {raw_root}")
        if months:
            load_months(batch.sparkSession, spec, {m: raw_month_path(raw_root, spec, m) for m in months}, target)

    w = src.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
