import hashlib
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import (
    month_label,
    month_start,
    payment_type_description,
    register_sql_functions,
    row_id,
    safe_int,
    surrogate_key,
)
from ridemart.specs import SURROGATE_NULL


def test_safe_int_text_and_numbers(spark):
    s = spark.createDataFrame([("2",), ("2.0",), ("x",), (None,)], "v string")
    got = [r[0] for r in s.select(safe_int("v", T.StringType())).collect()]
    assert got == [2, None, None, None]
    d = spark.createDataFrame([(2.5,), (1.5,), (-2.5,), (2.4,), (1e30,)], "v double")
    got = [r[0] for r in d.select(safe_int("v", T.DoubleType())).collect()]
    assert got == [3, 2, -3, 2, None]  # half away from zero; overflow -> NULL


def test_payment_type_description(spark):
    df = spark.createDataFrame([(None,), ("0",), ("9",), ("x",), ("1",), ("6",)], "p string")
    got = [r[0] for r in df.select(payment_type_description("p", T.StringType())).collect()]
    assert got == ["EMPTY", "EMPTY", "EMPTY", "EMPTY", "Credit card", "Voided trip"]


def test_sql_function(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT payment_type_description(2) AS d").first().d == "Cash"


def test_row_id_nulls_and_collisions(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (1, None, None, 1, 23), (1, None, None, 12, 3)],
                               "v long, pu_t timestamp, do_t timestamp, pu long, do long")
    ids = [r[0] for r in df.select(row_id(["v", "pu_t", "do_t", "pu", "do"])).collect()]
    assert ids[0] == hashlib.md5(b"").hexdigest()
    assert ids[1] == ids[2]  # no separator: parity with the load jobs
    b = df.select(row_id(["v"], as_bytes=True)).first()[0]
    assert len(b) == 16


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, datetime(2019, 1, 1)), (None, None)], "v long, t timestamp")
    got = [r[0] for r in df.select(surrogate_key("v", "t")).collect()]
    assert got[0] == hashlib.md5(b"1-2019-01-01 00:00:00").hexdigest()
    assert got[1] == hashlib.md5(f"{SURROGATE_NULL}-{SURROGATE_NULL}".encode()).hexdigest()


def test_month_helpers(spark):
    df = spark.createDataFrame([(datetime(2019, 3, 17, 5, 6, 7),)], "t timestamp")
    assert df.select(month_start("t")).first()[0] == datetime(2019, 3, 1)
    assert month_label("2019-03") == "2019-03"
    assert month_label("2019-03", "yyyy_MM") == "2019_03"
    assert month_label("2019-03", "yyyy") == "2019"
    assert df.select(F.to_date("t")).first()[0].isoformat() == "2019-03-17"
