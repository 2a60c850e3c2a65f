"""Files that tasks write themselves: one address for the driver and all executors.

A folder without a scheme belongs to Hadoop's default file system, as it does
for Spark's own writers; tasks then open it through pyarrow. Hadoop's names of
object stores are mapped to pyarrow's (``s3a`` and ``s3n`` to ``s3``).
"""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import SparkSession

_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme (and authority) that Spark's writers would use."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).makeQualified(path).toUri().toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified address."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/*(.*)", uri, re.S)
    if not m:
        raise ValueError(f"{uri} has no scheme; qualify it first")
    scheme, rest = m[1].lower(), m[2]
    if scheme == "file":
        return fs.LocalFileSystem(), f"/{rest}"
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
