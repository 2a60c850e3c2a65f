"""Compaction: packing, same rows, fewer files and bytes, swaps cut short at any point."""

import os
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ridemart.operators import compaction as C
from ridemart.operators import ledger
from ridemart.operators.warehouse import count_trips, distinct_vendors
from ridemart.plans.pruning import trips_between
from ridemart.session import local_dir
from ridemart.specs import YELLOW

P = YELLOW.pickup
BIN = f"{P}_bin"


def daily(spark, path, days=40, per_day=50):
    rows = spark.range(days * per_day).select(
        (F.col("id") % 7 + 1).alias("VendorID"), F.timestamp_seconds(F.lit(1546300800) + F.col("id") / per_day * 86400).alias(P), F.col("id").cast("string").alias("s"))
    C.write_bins(rows.union(spark.createDataFrame([(1, None, "no time")], "VendorID long, t timestamp, s string")), path, P)
    return sorted(str(tuple(r)) for r in rows_of(spark, path))


def rows_of(spark, path):
    return C.read_bins(spark, path).select("VendorID", P, "s").collect()


def same(spark, path, want):
    return sorted(str(tuple(r)) for r in rows_of(spark, path)) == want


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(local_dir(path)) if ledger.FOLDER not in d for f in names if f.startswith("part-")]


def test_packing():
    d = [date(2019, 1, 1) + timedelta(days=i) for i in range(6)]
    assert C.packed([(d[i], n) for i, n in enumerate([5, 5, 5, 30, 1, 1])], 10) == [[d[0], d[1]], [d[2]], [d[3]], [d[4], d[5]]]
    assert C.packed([(x, 1) for x in d], 10, before=d[2]) == [d[:2]]
    assert C.packed([], 10) == []


def test_same_rows_in_fewer_files_that_skip_row_groups(spark, scratch):
    path = scratch("bins")
    want = daily(spark, path)
    before = len(files(path))
    groups = C.compact(spark, path, P, ["VendorID"], bin_rows=700, row_group_rows=100, before=date(2019, 2, 5))
    assert same(spark, path, want)
    assert len(groups) == 3 and len(files(path)) <= before - 30
    left = {n for n in os.listdir(local_dir(path)) if n.startswith(BIN)}
    assert f"{BIN}=2019-02-06" in left and f"{BIN}=2019-01-03" not in left and f"{BIN}=__HIVE_DEFAULT_PARTITION__" in left
    packed = [f for f in files(path) if f"{BIN}=2019-01-01" in f]
    meta = pq.ParquetFile(packed[0]).metadata
    ranges = [(s.min, s.max) for s in (meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups))]
    assert len(ranges) >= 5 and sum(lo <= 1 <= hi for lo, hi in ranges) * 1.27 <= len(ranges)
    # packing again adds nothing new to finished bins, and takes in days that have grown old
    assert C.compact(spark, path, P, ["VendorID"], bin_rows=700, row_group_rows=100, before=date(2019, 2, 5)) == {}
    assert C.compact(spark, path, P, ["VendorID"], bin_rows=700, row_group_rows=100)
    assert same(spark, path, want)


def test_date_filters_find_their_bins(spark, scratch):
    path = scratch("bins")
    daily(spark, path)
    plain = spark.read.parquet(path).drop(BIN)
    spans = [("2019-01-01", "2019-01-01"), ("2019-01-09", "2019-01-20"), ("2018-01-01", "2019-01-02"), ("2019-02-01", "2030-01-01"), ("2017-01-01", "2017-02-01")]
    want = [count_trips(plain, P, *s, vendor=1).first().trips for s in spans]
    vendors = sorted(r[0] for r in distinct_vendors(plain, P, *spans[0]).collect())
    C.compact(spark, path, P, ["VendorID"], bin_rows=700)
    df = C.read_bins(spark, path)
    assert [count_trips(df, P, *s, vendor=1).first().trips for s in spans] == want
    assert sorted(r[0] for r in distinct_vendors(df, P, *spans[0]).collect()) == vendors
    part = trips_between(df, P, *spans[1])
    assert {f.split(f"{BIN}=")[1][:10] for f in [r[0] for r in part.select("_metadata.file_path").distinct().collect()]} == {"2019-01-01", "2019-01-15"}


@pytest.mark.parametrize("moves, marked", [(0, False), (2, False), (3, True)])
def test_swap_cut_short(spark, scratch, monkeypatch, moves, marked):
    path = scratch("bins")
    want = daily(spark, path)
    n_files, done, move = len(files(path)), [], ledger.Files.move

    def dies(self, src, dst):
        if "/rows/" in src:
            if len(done) >= moves:
                raise KeyboardInterrupt("the driver is lost")
            done.append(dst)
        return move(self, src, dst)

    monkeypatch.setattr(ledger.Files, "move", dies)
    if marked:          # all is moved and marked, nothing replaced is removed yet
        monkeypatch.setattr(C, "_finish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt("the driver is lost")))
    with pytest.raises(KeyboardInterrupt):
        C.compact(spark, path, P, ["VendorID"], bin_rows=700)
    monkeypatch.undo()
    assert same(spark, path, want)                      # a reader sees one version of every row all the time
    C.settle(spark, path)
    assert same(spark, path, want) and C.hidden_files(spark, path) == []
    assert (len(files(path)) < n_files) == marked
    C.compact(spark, path, P, ["VendorID"], bin_rows=700)
    assert same(spark, path, want) and len(files(path)) <= 5


def test_nothing_to_pack(spark, scratch):
    path = scratch("bins")
    C.write_bins(spark.createDataFrame([(1, datetime(2019, 1, 1))], f"VendorID long, {P} timestamp"), path, P)
    assert C.compact(spark, path, P, ["VendorID"]) == {} and C.read_bins(spark, path).count() == 1
