"""Promotion between layers: new rows, changed rows, history and date windows.

The high-water mark of the target is a scalar subquery (``DataFrame.scalar``):
Spark runs the one-row aggregate once (partial max/count per task, then a
single-row final) and uses the value as a constant in the filter.  Nothing is
collected to the driver and the plan stays lazy.

Frames read with their layout from a table in ``dated`` folders
(``sources.partitioned.read_with_layout``) are pruned by folder: a bound on the
timestamp becomes a bound on the folder's day or month.  Restamped rows are
found too, as they lie in the folder of their new timestamp.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.functions.dates import AsOf, parse_timestamp, timestamp_literal, yesterday


def _from(df: DataFrame, bound: Column, column: str, always: Optional[Column] = None) -> DataFrame:
    """Of a frame read with its ``dated`` layout, the folders that can hold
    rows at or after ``bound`` (all of them where ``always`` holds).  Whole
    folders are skipped; the caller still compares the rows.  Other frames
    pass unchanged."""
    for unit, period in C.PERIODS.items():
        if period not in df.columns:
            continue
        # the date of a zoned timestamp depends on the zone of the session that wrote it
        slack = 1 if isinstance(df.schema[column].dataType, T.TimestampType) else 0
        first = F.date_trunc(unit, F.date_sub(bound.cast("date"), slack)).cast("date")
        held = F.try_to_date(F.col(period), "yyyy-MM-dd") >= first
        df = df.where(held if always is None else always | held).drop(period)
    return df


def high_water_mark(df: DataFrame, column: str, fmt: str = C.DATETIME_FORMAT) -> DataFrame:
    """One row: newest parsed timestamp (``mark``) and row count (``n``)."""
    return df.agg(F.max(parse_timestamp(df, column, fmt)).alias("mark"),
                  F.count(F.lit(1)).alias("n"))


def newer_than(source: DataFrame, target: DataFrame, column: str,
               fmt: str = C.DATETIME_FORMAT, inclusive: bool = False) -> DataFrame:
    """Source rows strictly newer than the target's newest ``column``.

    An empty target promotes every row; a target whose timestamps are all null
    promotes none; rows equal to the mark are skipped unless ``inclusive``.
    The column is parsed on both sides, so the output has one schema whether
    or not the target was empty.
    """
    mark = high_water_mark(target, column, fmt).select(F.struct("mark", "n")).scalar()
    source = _from(source, mark.getField("mark"), column, mark.getField("n") == 0)
    parsed = source.withColumn(column, parse_timestamp(source, column, fmt))
    ts = F.col(column)
    newer = ts >= mark.getField("mark") if inclusive else ts > mark.getField("mark")
    return parsed.where((mark.getField("n") == 0) | newer)


def since(df: DataFrame, column: str, as_of: AsOf = None,
          drop: Sequence[str] = C.DATE_PARTS) -> DataFrame:
    """Rows dated yesterday (relative to ``as_of``) or later, date parts dropped."""
    df = _from(df, yesterday(as_of), column)
    return df.where(F.col(column) >= yesterday(as_of)).drop(*drop)


def history_since(df: DataFrame, column: str, start: str = C.HISTORY_START,
                  fmt: str = C.DATETIME_FORMAT) -> DataFrame:
    """Rows whose parsed ``column`` is at or after ``start`` (text that does
    not parse is dropped, not fatal)."""
    df = _from(df, F.lit(start).cast("timestamp_ntz"), column)
    ts = parse_timestamp(df, column, fmt)
    out = df.withColumn(column, ts)
    return out.where(F.col(column) >= timestamp_literal(start, out.schema[column].dataType))


def changed_rows(current: DataFrame, previous: DataFrame, key: str,
                 compare: Sequence[str] = (C.COMPANY_NAME, C.TAX_ID),
                 null_safe: bool = False) -> DataFrame:
    """Current rows whose key exists in ``previous`` with a different value in
    any ``compare`` column.

    The default comparison is SQL ``<>``: a null on either side is not a
    change.  ``null_safe=True`` counts null vs. value as a change.

    A left-semi join with the difference as its residual condition: each
    current row appears at most once, however many previous rows share its
    key, so no key's rows are paired off into the output.
    """
    old = {c: f"_old_{c}" for c in (key, *compare)}
    prev = previous.select(*[F.col(c).alias(a) for c, a in old.items()])

    def differs(c: str) -> Column:
        if null_safe:
            return ~F.col(c).eqNullSafe(F.col(old[c]))
        return F.col(c) != F.col(old[c])

    cond = reduce(lambda a, b: a | b, [differs(c) for c in compare])
    return current.join(prev, (F.col(key) == F.col(old[key])) & cond, "left_semi")
