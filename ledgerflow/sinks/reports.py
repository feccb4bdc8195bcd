"""Report sinks: CSV reports and full-load tables.

Reports are written by all tasks in parallel (one part file per task); they are
never funnelled through a single task or the driver.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.sources.tables import _fs


def write_report(df: DataFrame, path: str) -> bool:
    """CSV with a header at ``path``; nothing is written for an empty frame.
    Returns whether a report was written.

    The frame is computed once: its rows are counted while they are written to
    a folder beside ``path``, which then replaces the earlier report, or goes
    if it has none.  A failed run leaves the earlier report as it was."""
    spark, seen = df.sparkSession, Observation()
    pending = f"{path.rstrip('/')}.pending-{uuid.uuid4().hex}"
    fs, new, jvm = _fs(spark, pending)
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("header", True).csv(pending)
        if not seen.get["n"]:
            return False
        final = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        fs.delete(final, True)
        if not fs.rename(new, final):
            raise OSError(f"could not publish the report {path}")
        return True
    finally:
        fs.delete(new, True)


def of_countries(df: DataFrame, column: str = C.COUNTRY, countries: Sequence[str] = C.REGIONS) -> DataFrame:
    """Rows of the listed countries (null is none of them)."""
    return df.where(F.col(column).isin(*countries))


def write_report_by_country(df: DataFrame, path: str, column: str = C.COUNTRY,
                            countries: Sequence[str] = C.REGIONS) -> None:
    """One report folder per listed country (``<path>/report_country=MX/...``)
    in a single pass.  The files keep the country column; a listed country
    without rows keeps its earlier report, unlisted ones (null included) are
    dropped."""
    listed = of_countries(df, column, countries)
    (listed.withColumn(f"report_{column}", F.col(column)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("header", True)
     .partitionBy(f"report_{column}").csv(path))


def write_full_load(df: DataFrame, path: str) -> None:
    """Replace a full-load table in place, partitioned by its load date parts.
    The jobs use a snapshot version instead (``sources.tables.write_snapshot``),
    which never exposes a half-written table."""
    df.write.mode("overwrite").partitionBy(*C.DATE_PARTS).parquet(path)
