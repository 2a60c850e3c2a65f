"""Load ledger: a driver lost at any point of a load, files lost later, bucketed targets."""

import os
from datetime import datetime

import pytest

from ridemart.operators import ledger
from ridemart.operators.tables import day_column, ensure_table, merge_new, new_rows, read_target
from ridemart.plans.pipeline import load_months, load_months_staged, target_schema
from ridemart.session import local_dir
from ridemart.sources import files as io
from ridemart.specs import YELLOW
from ridemart.streaming.months import stream_months
from tests.test_models import raw
from tests.test_tables import _batch

DAY = day_column(YELLOW.pickup)
MONTHS = ["2019-01", "2019-02", "2019-03"]


@pytest.fixture()
def landed(spark, scratch):
    """Three months, every trip twice, one trip in two months, one without a pickup time."""
    rows = [dict(fare_amount=float(i), **{YELLOW.pickup: datetime(2019, m, 1 + i), YELLOW.dropoff: datetime(2019, m, 2 + i)})
            for m in (1, 2, 3) for i in range(6)] * 2
    root = scratch("raw")
    for m in (1, 2, 3):
        own = [r for r in rows if r[YELLOW.pickup].month == m] + [rows[0]] * (m == 2) + [{YELLOW.pickup: None, YELLOW.dropoff: datetime(2019, m, 9)}]
        io.land_raw(raw(spark, YELLOW, own), root, YELLOW, f"2019-0{m}")
    return root, {m: io.raw_month_path(root, YELLOW, m) for m in MONTHS}


def rows_of(spark, target):
    df = read_target(spark, target, target_schema(YELLOW))
    return sorted(str(tuple(r)) for r in df.collect())


def parts(target):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(local_dir(target)) if ledger.FOLDER not in d for f in names if f.startswith("part-"))


def lost(*_):
    raise KeyboardInterrupt("the driver is lost")


@pytest.mark.parametrize("moves", [0, 7])
def test_driver_lost_while_files_are_moved(spark, scratch, landed, monkeypatch, moves):
    _, sources = landed
    want, target = scratch("want"), scratch("target")
    load_months(spark, YELLOW, sources, want)
    first = {m: sources[m] for m in MONTHS[:1]}
    load_months(spark, YELLOW, first, target)
    load_months(spark, YELLOW, first, want)
    done, move = [], ledger.Files.move

    def dies(self, src, dst):
        if "/rows/" in src:
            if len(done) >= moves:
                lost()
            done.append(dst)
        return move(self, src, dst)

    monkeypatch.setattr(ledger.Files, "move", dies)
    monkeypatch.setattr(ledger.Files, "each", lambda self, do, items: [do(x) for x in items])
    with pytest.raises(KeyboardInterrupt):
        load_months(spark, YELLOW, sources, target)
    monkeypatch.undo()
    assert [d for _, d in ledger.loads(spark, target)] == [True, False]
    # a careful reader sees the finished load only
    seen = ledger.finished(spark, target, read_target(spark, target, target_schema(YELLOW)))
    assert {r.filename for r in seen.collect()} == {"yellow_tripdata_2019-01.parquet"}
    got = load_months(spark, YELLOW, sources, target)
    assert got == {"2019-01": 0, "2019-02": 13, "2019-03": 13}
    assert rows_of(spark, target) == rows_of(spark, want)
    assert all(done for _, done in ledger.loads(spark, target))
    assert load_months(spark, YELLOW, sources, target) == dict.fromkeys(MONTHS, 0)


def test_driver_lost_before_the_record(spark, scratch, landed, monkeypatch):
    _, sources = landed
    want, target = scratch("want"), scratch("target")
    load_months(spark, YELLOW, sources, want)
    monkeypatch.setattr(ledger, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        load_months(spark, YELLOW, sources, target)
    monkeypatch.undo()
    assert parts(target) == []
    load_months(spark, YELLOW, sources, target)
    assert rows_of(spark, target) == rows_of(spark, want)
    assert [n for n in os.listdir(f"{local_dir(target)}/{ledger.FOLDER}") if not n.endswith((".json", ".done", ".crc"))] == []


def test_lost_files_of_a_finished_load(spark, scratch, landed):
    """Some committed files are gone: the load is undone and made again from the sources it names."""
    _, sources = landed
    want, target = scratch("want"), scratch("target")
    load_months(spark, YELLOW, sources, want)
    load_months(spark, YELLOW, sources, target)
    for f in parts(target)[::2]:
        os.remove(f)
    assert len(rows_of(spark, target)) < len(rows_of(spark, want))
    # asking for one of its months brings all of them back
    assert load_months(spark, YELLOW, {"2019-02": sources["2019-02"]}, target) == {"2019-02": 0}
    assert rows_of(spark, target) == rows_of(spark, want)


def test_the_same_through_the_stream(spark, scratch, landed, monkeypatch):
    root, sources = landed
    want, target, ckpt = scratch("want"), scratch("target"), scratch("ckpt")
    load_months(spark, YELLOW, sources, want)
    move, done = ledger.Files.move, []

    def dies(self, src, dst):
        if "/rows/" in src:
            done.append(dst)
            if len(done) > 8:
                raise RuntimeError("the driver is lost")
        return move(self, src, dst)

    monkeypatch.setattr(ledger.Files, "move", dies)
    monkeypatch.setattr(ledger.Files, "each", lambda self, do, items: [do(x) for x in items])
    query = stream_months(spark, YELLOW, root, target, ckpt)
    with pytest.raises(Exception, match="driver is lost"):
        query.awaitTermination()
    monkeypatch.undo()
    assert parts(target)
    stream_months(spark, YELLOW, root, target, ckpt).awaitTermination()
    assert rows_of(spark, target) == rows_of(spark, want)


def test_staged_flow_recovers(spark, scratch, landed, monkeypatch):
    root = scratch("csv")
    rows = [dict(fare_amount=float(i), **{YELLOW.pickup: datetime(2019, m, 1 + i)}) for m in (1, 2) for i in range(5)]
    io.land_raw(raw(spark, YELLOW, rows), root, YELLOW, fmt="csv")
    sources = {m: f"{root}/yellow/month={m}" for m in MONTHS[:2]}
    name, where = "staged_recovers", scratch("t")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    monkeypatch.setattr(ledger, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        load_months_staged(spark, YELLOW, sources, scratch("s"), name, buckets=4, location=where)
    monkeypatch.undo()
    assert load_months_staged(spark, YELLOW, sources, scratch("s"), name, buckets=4, location=where) == {"2019-01": 5, "2019-02": 5}
    assert load_months_staged(spark, YELLOW, sources, scratch("s"), name, buckets=4, location=where) == {"2019-01": 0, "2019-02": 0}
    assert spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_bucketed_target_is_not_shuffled(spark, scratch):
    name = "bucketed_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, target_schema(YELLOW), location=scratch("b"), bucket_by="unique_row_id", buckets=8)
    schema = target_schema(YELLOW)
    rows = [{YELLOW.pickup: datetime(2019, 6, 1 + d % 20), "PULocationID": d} for d in range(60)]
    assert merge_new(spark, name, _batch(spark, rows + rows[:5]), schema=schema) == 65
    more = _batch(spark, rows[30:] + [{YELLOW.pickup: datetime(2019, 7, 1), "PULocationID": 1}] * 2)
    plan = new_rows(spark, name, more, schema=schema)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    join = plan.index("SortMergeJoin")
    left, right = plan[join:].split("FileScan parquet spark_catalog.default.bucketed_target")[0], plan[plan.index("FileScan parquet spark_catalog.default.bucketed_target"):]
    assert "Bucketed: true" in right
    assert left.count("Exchange hashpartitioning") == 1         # the batch; the target's side has none
    assert merge_new(spark, name, more, schema=schema) == 2
    assert merge_new(spark, name, more, schema=schema) == 0
    assert spark.table(name).count() == 67
    counts = spark.table(name).groupBy("unique_row_id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.where("count > 1").count() == 6
    files = [f for f in os.listdir(local_dir(ledger.described(spark, name).root)) if f.startswith("part-")]
    assert len(files) <= 16
    spark.sql(f"DROP TABLE {name}")
