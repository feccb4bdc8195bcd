"""Report-shaped projections of the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.functions.dates import AsOf, with_load_date
from ledgerflow.operators.ledger import classify


def country_of_client(client: str = C.ID_CLIENT):
    """Country code: the first two characters of the client key."""
    return F.substring(F.col(client), 1, 2)


def unmapped_invoices(unmapped_df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Distinct (invoice, type, country, posting class) of unmapped
    transactions, stamped with the report date.

    ``distinct`` is a hash aggregate with map-side partial aggregation, so the
    shuffle carries at most one row per combination per task.
    """
    out = (classify(unmapped_df)
           .withColumn(C.COUNTRY, country_of_client())
           .select(*C.INVOICE_REPORT_COLUMNS)
           .distinct())
    return with_load_date(out, as_of)
