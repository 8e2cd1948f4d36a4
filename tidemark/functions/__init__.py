from tidemark.functions.expr import (  # noqa: F401
    anchored,
    as_ts,
    bit,
    bucket,
    epoch_micros,
    epoch_seconds,
    hex_from_bits,
    inf_to_null,
    instrument_id,
    nan_to_null,
    round_all,
    safe_div,
    seconds_to_ts,
    split_instrument,
    week_of_year_sunday,
    yyyymmdd,
)
