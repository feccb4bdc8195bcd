"""Date helpers built from Spark's built-in expressions (no UDFs).

Every "today" in the source jobs becomes an explicit ``as_of`` date so that a
run is reproducible and can be compared with an oracle.
"""

from __future__ import annotations

import datetime as _dt
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C

AsOf = Union[str, _dt.date, Column, None]


def as_of_date(as_of: AsOf = None) -> Column:
    """``as_of`` as a DATE column; ``None`` means ``current_date()``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def yesterday(as_of: AsOf = None) -> Column:
    return F.date_sub(as_of_date(as_of), 1)


def date_part_columns(ts: Column, padded: bool = False) -> dict[str, Column]:
    """year / month / day strings of ``ts``.

    ``padded`` gives two-digit month and day (the bronze CDC layout); the
    silver and gold layers use unpadded parts.
    """
    year = F.year(ts).cast("string")
    month = F.month(ts).cast("string")
    day = F.dayofmonth(ts).cast("string")
    if padded:
        month = F.lpad(month, 2, "0")
        day = F.lpad(day, 2, "0")
    return {C.YEAR: year, C.MONTH: month, C.DAY: day}


def with_date_parts(df: DataFrame, source: Union[str, Column], padded: bool = False) -> DataFrame:
    """Add (or replace) year/month/day derived from a date or timestamp column."""
    ts = F.col(source) if isinstance(source, str) else source
    return df.withColumns(date_part_columns(ts, padded))


def with_load_date(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Stamp year/month/day of the load date (``as_of``), unpadded."""
    return df.withColumns(date_part_columns(as_of_date(as_of)))


def parse_timestamp(df: DataFrame, name: str, fmt: str = C.DATETIME_FORMAT) -> Column:
    """Column ``name`` as a timestamp.

    Timestamp and date inputs pass through unchanged (parsing a timestamp is an
    identity), text is parsed with ``fmt`` and text that does not match becomes
    null instead of failing the job under ANSI mode.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp")
    return F.try_to_timestamp(col.cast("string"), F.lit(fmt))


def timestamp_literal(text: str, like: T.DataType) -> Column:
    """A timestamp literal of the same flavour (LTZ / NTZ) as ``like``."""
    target = "timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp"
    return F.lit(text).cast(target)
