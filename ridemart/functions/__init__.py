from ridemart.functions.columns import (  # noqa: F401
    as_text,
    day_of,
    month_label,
    month_start,
    num,
    payment_type_description,
    register_sql_functions,
    row_id,
    safe_int,
    safe_int_of,
    surrogate_key,
    to_ts,
)
