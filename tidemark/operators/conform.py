"""Schema conform and strict malformed-row detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _exact(value: Column, name: str, have: T.DataType, want: T.DataType) -> Column:
    """A cast that changes no value: ANSI mode refuses overflow and bad text, this a cut-off fraction."""
    if isinstance(have, _FRACTIONAL) and isinstance(want, _INTEGRAL):
        whole = value.isNull() | (value == F.floor(value))
        value = F.when(whole, value).otherwise(F.raise_error(F.lit(f"column {name!r}: a fraction does not go into {want.simpleString()}")))
    return value.cast(want)


def _required(value: Column, name: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(f"column {name!r} is required: it holds a null")))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the shape of ``schema``: its columns by name, in its order, in its types.

    A column too many or too few raises at once.  A value that does not fit its type, and a null in a
    column that the schema requires, raise when the rows are read.  A column that fits already is
    passed on as it is.
    """
    want, have = {f.name: f for f in schema.fields}, {f.name: f for f in df.schema.fields}
    if df.schema == schema:
        return df
    if want.keys() != have.keys():
        raise ValueError(f"conform: not in the table schema: {sorted(have.keys() - want.keys())}; missing: {sorted(want.keys() - have.keys())}")
    columns = []
    for name, field in want.items():
        value = F.col(name) if field.dataType == have[name].dataType else _exact(F.col(name), name, have[name].dataType, field.dataType)
        columns.append((value if field.nullable or not have[name].nullable else _required(value, name)).alias(name))
    return df.select(*columns)


def bad_row_flag(required: Sequence[Column]) -> Column:
    """True when any required parsed value is null (a failed ``try_cast``/missing field)."""
    flag = F.lit(False)
    for c in required:
        flag = flag | c.isNull()
    return flag


def no_bad_rows(df: DataFrame, flag: str = "_bad") -> DataFrame:
    """``df`` without its flag column; the first flagged row that is met aborts whatever reads it."""
    others = [c for c in df.columns if c != flag]
    said = F.concat(F.lit("Invalid payload: "), F.to_json(F.struct(*others)))
    return df.filter(F.when(F.col(flag), F.raise_error(said).cast("boolean")).otherwise(F.lit(True))).drop(flag)
