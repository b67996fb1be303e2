from ledgerlake.functions.columns import (  # noqa: F401
    as_date, as_double, as_timestamp, decode_envelope, encode_envelope,
    is_missing,
)
