"""Column-level helpers. All are built-in Spark expressions (JVM-side,
inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns: what ``dropna`` removes."""
    c = F.col(name)
    if isinstance(_dtype(df, name), _FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def as_double(df: DataFrame, name: str) -> Column:
    """Value as double; unparsable text becomes NULL instead of failing
    (ANSI mode makes a plain cast raise)."""
    if isinstance(_dtype(df, name), T.DoubleType):
        return F.col(name)
    return F.col(name).try_cast("double")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Value as timestamp; text is parsed with the default ISO pattern
    (both naive and UTC-offset forms), unparsable text becomes NULL.
    Columns that already hold a timestamp are left as they are."""
    dt = _dtype(df, name)
    if isinstance(dt, _TIMES):
        return F.col(name)
    if isinstance(dt, T.DateType):
        return F.col(name).cast("timestamp")
    return F.try_to_timestamp(F.col(name).cast("string"))


def as_date(df: DataFrame, name: str) -> Column:
    dt = _dtype(df, name)
    if isinstance(dt, T.DateType):
        return F.col(name)
    if isinstance(dt, _TIMES):
        return F.to_date(F.col(name))
    return F.to_date(F.try_to_timestamp(F.col(name).cast("string")))


def decode_envelope(data: Column, schema: T.StructType) -> Column:
    """base64 text → JSON text → struct. Broken base64 or JSON gives NULL
    fields rather than an error."""
    text = F.try_to_binary(data, F.lit("base64")).cast("string")
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def encode_envelope(*cols: str) -> Column:
    """Struct → JSON text → base64 text: the batch-envelope layout."""
    return F.base64(F.to_json(F.struct(*cols)).cast("binary"))
