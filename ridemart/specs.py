"""Service specs: one description per taxi service, so every operator is written once.

A spec names the service, its pickup/dropoff columns, its raw column order and
types (the warehouse schema), the columns that make up the row ids, and the
column comments carried into table definitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)  # warehouse NUMERIC: precision 38, scale 9

# Fixed values that must equal the original pipeline's for right results.
# Payment type codes and their descriptions; anything else (NULL, 0, unknown) is 'EMPTY'.
PAYMENT_TYPE_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPE_OTHER = "EMPTY"
# Accepted payment type values (run variable default).
PAYMENT_TYPE_VALUES = [1, 2, 3, 4, 5, 6]
# Null marker used by the surrogate-key macro of the public dbt_utils package.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Borough of the zones that the fact table removes.
UNKNOWN_BOROUGH = "Unknown"
# Development row limit applied when is_test_run is on.
DEV_LIMIT = 100


def _schema(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


_L, _D, _S, _TS = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()

# passenger_count is DOUBLE: newer monthly files carry it as a float ("1.0");
# staging safe-casts it to an integer.

YELLOW_RAW = _schema([
    ("VendorID", _L), ("tpep_pickup_datetime", _TS), ("tpep_dropoff_datetime", _TS),
    ("passenger_count", _D), ("trip_distance", _D), ("RatecodeID", _L), ("store_and_fwd_flag", _S),
    ("PULocationID", _L), ("DOLocationID", _L), ("payment_type", _L), ("fare_amount", _D),
    ("extra", _D), ("mta_tax", _D), ("tip_amount", _D), ("tolls_amount", _D),
    ("improvement_surcharge", _D), ("total_amount", _D), ("congestion_surcharge", _D),
])

GREEN_RAW = _schema([
    ("VendorID", _L), ("lpep_pickup_datetime", _TS), ("lpep_dropoff_datetime", _TS),
    ("store_and_fwd_flag", _S), ("RatecodeID", _L), ("PULocationID", _L), ("DOLocationID", _L),
    ("passenger_count", _D), ("trip_distance", _D), ("fare_amount", _D), ("extra", _D),
    ("mta_tax", _D), ("tip_amount", _D), ("tolls_amount", _D), ("ehail_fee", _D),
    ("improvement_surcharge", _D), ("total_amount", _D), ("payment_type", _L), ("trip_type", _L),
    ("congestion_surcharge", _D),
])

ZONE_SEED = _schema([
    ("locationid", T.IntegerType()), ("borough", _S), ("zone", _S), ("service_zone", _S),
])

# Conformed staging schema (column order of the staging models).
STAGING_COLUMNS = [
    "tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
    "payment_type_description",
]

FACT_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid", "pickup_borough",
    "pickup_zone", "dropoff_locationid", "dropoff_borough", "dropoff_zone", "pickup_datetime",
    "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "payment_type_description",
]

REVENUE_SUMS = [
    ("fare_amount", "revenue_monthly_fare"),
    ("extra", "revenue_monthly_extra"),
    ("mta_tax", "revenue_monthly_mta_tax"),
    ("tip_amount", "revenue_monthly_tip_amount"),
    ("tolls_amount", "revenue_monthly_tolls_amount"),
    ("ehail_fee", "revenue_monthly_ehail_fee"),
    ("improvement_surcharge", "revenue_monthly_improvement_surcharge"),
    ("total_amount", "revenue_monthly_total_amount"),
]


@dataclass(frozen=True)
class TargetTypes:
    """Declared types of a load target (T1): the same columns are loaded into three kinds of table."""
    row_id: T.DataType             # hex text, or the 16 bytes of the hash
    code: T.DataType | None        # vendor, rate, zone and trip-type codes; None: as delivered
    amount: T.DataType | None      # distance and money
    count: T.DataType | None       # passenger_count and payment_type


CODE_COLUMNS = ("VendorID", "RatecodeID", "PULocationID", "DOLocationID", "trip_type")
COUNT_COLUMNS = ("passenger_count", "payment_type")
TARGETS = {
    "typed": TargetTypes(_S, None, None, None),
    "numeric": TargetTypes(T.BinaryType(), _S, MONEY, _L),
    "text": TargetTypes(_S, _S, _D, T.IntegerType()),
}


@dataclass(frozen=True, eq=False)
class ServiceSpec:
    name: str                      # lower-case service name: "green" / "yellow"
    label: str                     # service_type value in the fact table
    pickup: str
    dropoff: str
    raw_schema: T.StructType
    comments: dict[str, str] = field(default_factory=dict)

    @property
    def raw_columns(self) -> list[str]:
        return [f.name for f in self.raw_schema.fields]

    @property
    def warehouse_id_columns(self) -> list[str]:
        """Five parts of the warehouse row id (MD5 bytes in the warehouse)."""
        return ["VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID"]

    @property
    def database_id_columns(self) -> list[str]:
        """Seven parts of the database row id (adds fare and distance)."""
        return self.warehouse_id_columns + ["fare_amount", "trip_distance"]

    def file_name(self, month: str, ext: str = "csv") -> str:
        """Monthly file name, e.g. ``green_tripdata_2019-01.csv``."""
        return f"{self.name}_tripdata_{month}.{ext}"


# What the engine does with each column, for table definitions.
_COMMON_COMMENTS = {
    "unique_row_id": "Hex MD5 over the row-id columns; the insert-only merge compares this value.",
    "filename": "Monthly delivery this row was loaded from, one value per load.",
    "VendorID": "Provider code; cluster column of the clustered layout and first part of every row id.",
    "store_and_fwd_flag": "Y or N text, passed through unchanged.",
    "RatecodeID": "Rate code as delivered; staging casts it to an integer.",
    "PULocationID": "Pickup zone number, joined to the zone lookup by the fact model.",
    "DOLocationID": "Dropoff zone number, joined to the zone lookup by the fact model.",
    "passenger_count": "Delivered as a float in newer files; staging rounds it to an integer.",
    "trip_distance": "Miles; an input of the tip regression and a part of the seven-part row id.",
    "payment_type": "Code 1 to 6, spelled out by payment_type_description; other codes count as EMPTY.",
    "fare_amount": "Metered fare in dollars; zero-fare trips are left out of the feature table.",
    "extra": "Further charges in dollars; summed by the monthly mart.",
    "mta_tax": "Transit tax in dollars; summed by the monthly mart.",
    "tip_amount": "Recorded tip in dollars; label of the tip regression.",
    "tolls_amount": "Tolls in dollars; an input of the tip regression.",
    "improvement_surcharge": "Surcharge per trip in dollars; summed by the monthly mart.",
    "total_amount": "Amount billed in dollars; the mart's total must never be NULL.",
    "congestion_surcharge": "Congestion charge in dollars; NULL in files from before it existed.",
}


def _service_comments(pickup: str, dropoff: str, **more: str) -> dict[str, str]:
    return dict(_COMMON_COMMENTS, **{pickup: "Start of the trip; its date partitions the table.",
                                     dropoff: "End of the trip."}, **more)


YELLOW = ServiceSpec("yellow", "Yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", YELLOW_RAW,
                     _service_comments("tpep_pickup_datetime", "tpep_dropoff_datetime"))
GREEN = ServiceSpec("green", "Green", "lpep_pickup_datetime", "lpep_dropoff_datetime", GREEN_RAW,
                    _service_comments("lpep_pickup_datetime", "lpep_dropoff_datetime",
                                      trip_type="Code 1 (hailed) or 2 (dispatched).",
                                      ehail_fee="Fee of app-hailed trips; empty in most files, kept numeric."))

SPECS = {"yellow": YELLOW, "green": GREEN}


def spec(name: str) -> ServiceSpec:
    """Dispatch by service name."""
    try:
        return SPECS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown service {name!r}; expected one of {sorted(SPECS)}") from None


@dataclass(frozen=True)
class Config:
    """Run variables with their defaults."""
    is_test_run: bool = False    # opt in: development runs keep dev_limit rows a model
    payment_type_values: tuple[int, ...] = tuple(PAYMENT_TYPE_VALUES)
    dev_limit: int = DEV_LIMIT
