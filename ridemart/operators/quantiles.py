"""Exact quantiles of columns of any size by distributed selection (M4, M5).

A first pass estimates two values that enclose the wanted rank closely. A
second counts the rows below them and between them, exactly, and the rank is
then wanted among the rows between only. As soon as few different values are
left between the two, their counts are fetched and the value at the rank is
read off; until then the enclosing is repeated on what is left. Each round
keeps about 4 / ``ACCURACY`` of the rows, so two rounds do for anything up to
some hundred million rows with different values, three beyond. Memory is that
of the estimate, whatever the distribution: a value that repeats is one value
with a count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.session import scratch_path

ACCURACY = 10_000       # of the estimate: rank error at most rows / ACCURACY
MAX_VALUES = 20_000     # different values fetched at most, a column


@dataclass
class _Search:
    """Rows with lo <= x <= hi hold the value; ``below`` rows are smaller than lo, ``inside`` lie between."""
    rank: int
    inside: int
    below: int = 0
    lo: float | None = None
    hi: float | None = None
    value: float | None = None

    def within(self, x: Column) -> Column:
        bounds = F.lit(True)
        if self.lo is not None:
            bounds = bounds & (x >= self.lo)
        if self.hi is not None:
            bounds = bounds & (x <= self.hi)
        return bounds


def _place(q: float, n: int) -> int:
    """1-based rank of the discrete quantile: the first value with at least q of the rows up to it."""
    return max(1, math.ceil(q * n - 1e-9))


def exact_quantiles(df: DataFrame, columns: dict[str, Column], q: float = 0.5, accuracy: int = ACCURACY,
                    max_values: int = MAX_VALUES) -> dict[str, float | None]:
    """The discrete ``q``-quantile of every named column over its non-NULL values; None where there are none.

    NaN counts as larger than every number. All columns share the passes.
    """
    names = list(columns)
    x = df.select(*[columns[c].cast("double").alias(c) for c in names])
    counted = x.agg(*[F.count(c).alias(c) for c in names],
                    *[F.count_if(F.isnan(c)).alias(f"{c}__nan") for c in names]).first()
    out: dict[str, float | None] = dict.fromkeys(names)
    open_: dict[str, _Search] = {}
    for c in names:
        n, nan = counted[c], counted[f"{c}__nan"]
        if n and _place(q, n) > n - nan:
            out[c] = math.nan
        elif n:
            open_[c] = _Search(_place(q, n), n - nan)
    x = x.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) for c in names])
    while open_:
        for c in _fetched(x, open_, max_values):
            out[c] = open_.pop(c).value
        if open_:
            _enclose(x, open_, accuracy)
    return out


def _enclose(x: DataFrame, searches: dict[str, _Search], accuracy: int) -> None:
    """Narrow every search to the rows between two estimated values around its rank."""
    def around(s: _Search) -> list[float]:
        p = (s.rank - s.below) / s.inside
        return [max(0.0, p - 2 / accuracy), min(1.0, p + 2 / accuracy)]

    guess = x.agg(*[F.percentile_approx(F.when(s.within(F.col(c)), F.col(c)), around(s), accuracy).alias(c) for c, s in searches.items()]).first()
    counts = []
    for i, (c, s) in enumerate(searches.items()):
        lo, hi = guess[c]
        v, inside = F.col(c), s.within(F.col(c))
        counts += [F.count_if(inside & (v < lo)).alias(f"b{i}"), F.count_if(inside & (v >= lo) & (v <= hi)).alias(f"n{i}")]
    row = x.agg(*counts).first()
    for i, (c, s) in enumerate(searches.items()):
        lo, hi = guess[c]
        below, n = s.below + row[f"b{i}"], row[f"n{i}"]
        if below < s.rank <= below + n:
            s.lo, s.hi, s.below, s.inside = lo, hi, below, n
        elif s.rank <= below:                       # the estimate missed: the side it lies on is smaller all the same
            s.hi, s.inside = math.nextafter(lo, -math.inf), row[f"b{i}"]
        else:
            s.lo, s.below, s.inside = math.nextafter(hi, math.inf), below + n, s.inside - row[f"b{i}"] - n


def _fetched(x: DataFrame, searches: dict[str, _Search], max_values: int) -> list[str]:
    """Columns whose remaining values are few (or one): their value at the rank is set."""
    done = [c for c, s in searches.items() if s.lo is not None and s.lo == s.hi]
    for c in done:
        searches[c].value = searches[c].lo
    rest = {c: s for c, s in searches.items() if c not in done and s.lo is not None}
    if not rest:
        return done
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.when(s.within(F.col(c)), F.col(c)).alias("v")) for c, s in rest.items()]))
    path = scratch_path(x.sparkSession, "quantile_values")
    x.select(each.alias("x")).select("x.*").where("v is not null").groupBy("c", "v").count().write.parquet(path)
    values = x.sparkSession.read.schema("c string, v double, count long").parquet(path)
    # a column with more values than that is narrowed again; at most max_values + 1 rows of each are fetched
    got = values.groupBy("c").agg(F.count("*").alias("k")).collect()
    few = [r.c for r in got if r.k <= max_values]
    if not few:
        return done
    for c in few:
        s, seen = rest[c], rest[c].below
        for r in sorted((r.v, r["count"]) for r in values.where(F.col("c") == c).select("v", "count").collect()):
            seen += r[1]
            if seen >= s.rank:
                s.value = r[0]
                break
    return done + few
