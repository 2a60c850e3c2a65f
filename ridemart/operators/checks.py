"""Declared data-quality checks.

Each check is one distributed aggregate returning a single row
``(model, column_name, check_name, severity, failures)``; ``run_checks``
unions them into one result and raises when an ``error`` check fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


RESULT_SCHEMA = "model string, column_name string, check_name string, severity string, failures bigint"


class CheckFailed(RuntimeError):
    pass


def _row(failures_df: DataFrame, model: str, column: str, check: str, severity: str) -> DataFrame:
    return failures_df.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                              F.lit(check).alias("check_name"), F.lit(severity).alias("severity"),
                              F.col("failures").cast(T.LongType()).alias("failures"))


def check_unique(df: DataFrame, col: str, model: str, severity: str = "warn") -> DataFrame:
    """Number of non-NULL values that occur more than once (Q1, A10)."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _row(dup.agg(F.count(F.lit(1)).alias("failures")), model, col, "unique", severity)


def check_not_null(df: DataFrame, col: str, model: str, severity: str = "warn") -> DataFrame:
    """Number of NULL values (Q2)."""
    return _row(df.agg(F.count_if(F.col(col).isNull()).alias("failures")), model, col, "not_null", severity)


def check_relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str, model: str,
                        severity: str = "warn") -> DataFrame:
    """Number of non-NULL child rows whose key is absent from the parent."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()     # AQE broadcasts it when it turns out small
    orphans = df.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_pk"), "left_anti")
    return _row(orphans.agg(F.count(F.lit(1)).alias("failures")), model, col, "relationships", severity)


def check_accepted_values(df: DataFrame, col: str, values: list, model: str, severity: str = "warn") -> DataFrame:
    """Number of distinct non-NULL values outside ``values`` (Q4)."""
    bad = df.where(~F.col(col).isin(list(values))).select(col).distinct()
    return _row(bad.agg(F.count(F.lit(1)).alias("failures")), model, col, "accepted_values", severity)


def column_checks(df: DataFrame, model: str, not_null: dict[str, str] | None = None,
                  accepted: dict[str, tuple[list, str]] | None = None) -> DataFrame:
    """Not-null (column -> severity) and accepted-value (column -> values, severity) checks in one scan (Q2, Q4).

    Value checks beyond the first cost an extra row per input row (several
    distinct counts), so give columns with few bad values only.
    """
    aggs, rows = [], []
    for c, severity in (not_null or {}).items():
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"f{len(aggs)}"))
        rows.append((c, "not_null", severity))
    for c, (values, severity) in (accepted or {}).items():
        aggs.append(F.count_distinct(F.when(~F.col(c).isin(list(values)), F.col(c))).alias(f"f{len(aggs)}"))
        rows.append((c, "accepted_values", severity))
    parts = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"),
                      F.lit(severity).alias("severity"), F.col(f"f{i}").cast(T.LongType()).alias("failures"))
             for i, (c, kind, severity) in enumerate(rows)]
    return df.agg(*aggs).select(F.inline(F.array(*parts)))


def table_checks(df: DataFrame, model: str, unique: dict[str, str] | None = None, not_null: dict[str, str] | None = None,
                 accepted: dict[str, tuple[list, str]] | None = None,
                 relationships: dict[str, tuple[DataFrame, str, str]] | None = None) -> DataFrame:
    """All declared checks of a table from one scan (Q1-Q4).

    Column -> severity; for ``accepted`` (values, severity), for
    ``relationships`` (parent, parent column, severity). Every checked column
    is a grouping set of one aggregate, which yields each of its values with a
    count. These are folded on the spot to what the checks ask for: a row for
    the unique columns, and the different values of the others, which alone
    meet the parents.
    """
    unique, not_null, accepted, relationships = unique or {}, not_null or {}, accepted or {}, relationships or {}
    names = list(dict.fromkeys([*unique, *not_null, *accepted, *relationships]))
    sets = df.select(*names).groupingSets([[F.col(c)] for c in names], *[F.col(c) for c in names]).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))
    # in grouping_id a bit is set for every column that is not in the set, the first column's highest
    of = {c: F.col("_g") == (1 << len(names)) - 1 - (1 << (len(names) - 1 - i)) for i, c in enumerate(names)}
    keep = [c for c in names if c in accepted or c in relationships]
    values = [F.when(of[c], F.col(c)).alias(c) for c in keep]
    which = F.coalesce(*[F.when(of[c], F.lit(i)) for i, c in enumerate(names)]).alias("_c")
    folded = sets.groupBy(which, *values).agg(
        F.sum("_n").alias("_n"),
        F.count_if(F.coalesce(*[F.when(of[c], F.col(c)) for c in unique], F.lit(None)).isNotNull() & (F.col("_n") > 1)).alias("_twice")
        if unique else F.lit(0).alias("_twice"),
        F.sum(F.when(F.coalesce(*[F.when(of[c], F.col(c).isNull()) for c in names]), F.col("_n"))).alias("_nulls"))
    at = {c: F.col("_c") == i for i, c in enumerate(names)}
    for c, (parent, parent_col, _) in relationships.items():
        keys = parent.select(F.col(parent_col).alias(f"_pk_{c}")).distinct().withColumn(f"_known_{c}", F.lit(True))
        folded = folded.join(keys, F.col(c) == F.col(f"_pk_{c}"), "left")
    aggs, rows = [], []

    def declare(c: str, check: str, severity: str, failures) -> None:
        aggs.append(F.coalesce(failures, F.lit(0)).alias(f"f{len(aggs)}"))
        rows.append((c, check, severity))

    for c, severity in unique.items():
        declare(c, "unique", severity, F.sum(F.when(at[c], F.col("_twice"))))
    for c, severity in not_null.items():
        declare(c, "not_null", severity, F.sum(F.when(at[c], F.col("_nulls"))))
    for c, (vals, severity) in accepted.items():
        declare(c, "accepted_values", severity, F.count_if(at[c] & ~F.col(c).isin(list(vals))))
    for c, (_, _, severity) in relationships.items():
        declare(c, "relationships", severity, F.sum(F.when(at[c] & F.col(c).isNotNull() & F.col(f"_known_{c}").isNull(), F.col("_n"))))
    parts = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"),
                      F.lit(severity).alias("severity"), F.col(f"f{i}").cast(T.LongType()).alias("failures"))
             for i, (c, kind, severity) in enumerate(rows)]
    return folded.agg(*aggs).select(F.inline(F.array(*parts)))


def run_checks(checks: list[DataFrame], raise_on_error: bool = True) -> DataFrame:
    """Union check rows (Q5). Raises ``CheckFailed`` if an ``error`` check has failures.

    The union is one job; only the handful of result rows reach the driver.
    """
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    if not raise_on_error:
        return out
    rows = out.collect()  # one row per declared check
    bad = [r for r in rows if r.severity == "error" and r.failures > 0]
    if bad:
        raise CheckFailed("; ".join(f"{r.model}.{r.column_name} {r.check_name}: {r.failures}" for r in bad))
    return out.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
