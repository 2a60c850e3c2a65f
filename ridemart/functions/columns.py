"""Column functions.

All of these return ``Column`` expressions built from ``pyspark.sql.functions``,
so they stay JVM-side inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.specs import (
    MONEY,
    PAYMENT_TYPE_DESCRIPTIONS,
    PAYMENT_TYPE_OTHER,
    SURROGATE_NULL,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: ColumnOrName, source_type: T.DataType | None = None) -> Column:
    """Safe cast to BIGINT: NULL instead of an error (F1).

    Numbers are rounded half away from zero first (2.5 -> 3), as the warehouse
    does; text is cast directly, so ``'2.0'`` is NULL.
    """
    c = _col(c)
    if isinstance(source_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        c = F.round(c)
    return c.try_cast(T.LongType())


def safe_int_of(df: DataFrame, name: str) -> Column:
    """``safe_int`` with the source type read from ``df``'s schema."""
    return safe_int(df[name], df.schema[name].dataType)


def num(c: ColumnOrName) -> Column:
    """Cast to the warehouse NUMERIC, ``DECIMAL(38,9)``."""
    return _col(c).cast(MONEY)


def to_ts(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Parse text to a timestamp on ingest."""
    return F.to_timestamp(_col(c), fmt) if fmt else F.to_timestamp(_col(c))


def as_text(c: ColumnOrName) -> Column:
    """Cast to STRING."""
    return _col(c).cast(T.StringType())


def payment_type_description(c: ColumnOrName = "payment_type", source_type: T.DataType | None = None) -> Column:
    """Payment code -> text; NULL, 0 and unlisted codes give 'EMPTY' (F8/U1)."""
    code = safe_int(c, source_type)
    expr = None
    for k, v in PAYMENT_TYPE_DESCRIPTIONS.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr.otherwise(PAYMENT_TYPE_OTHER)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the payment-type macro to SQL users as a temporary SQL function."""
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_TYPE_DESCRIPTIONS.items())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION payment_type_description(code BIGINT) "
        f"RETURNS STRING RETURN CASE code {cases} ELSE '{PAYMENT_TYPE_OTHER}' END"
    )


def _concat_parts(parts: list[ColumnOrName]) -> Column:
    # No separator between the parts, as in the load jobs: parity over collision-safety.
    return F.concat(*[F.coalesce(as_text(p), F.lit("")) for p in parts])


def row_id(parts: list[ColumnOrName], as_bytes: bool = False) -> Column:
    """MD5 row id over the given parts, NULL parts as '' (F10-F12).

    Hex text by default; ``as_bytes`` gives the 16-byte digest the warehouse stores.
    """
    h = F.md5(_concat_parts(parts))
    return F.unhex(h) if as_bytes else h


def surrogate_key(*cols: ColumnOrName) -> Column:
    """dbt_utils-style surrogate key: md5 of '-'-joined text, NULLs as a marker."""
    parts = [F.coalesce(as_text(c), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def month_start(c: ColumnOrName) -> Column:
    """Truncate a timestamp to its month; returns TIMESTAMP."""
    return F.date_trunc("month", _col(c))


def day_of(c: ColumnOrName) -> Column:
    """``DATE(ts)``."""
    return F.to_date(_col(c))


def month_label(month: str | date, fmt: str = "yyyy-MM") -> str:
    """Format a month for file and table names: yyyy-MM, yyyy_MM or yyyy (F16)."""
    d = date.fromisoformat(month + "-01") if isinstance(month, str) and len(month) == 7 else month
    if isinstance(d, str):
        d = date.fromisoformat(d)
    py = fmt.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d")
    return d.strftime(py)
