"""Conform per-region source tables to one schema and union them.

The source system keeps one table per country and per transaction source.
``conform_*`` turns one such table into the shared layout; ``union_regions``
combines any number of them by name (never by position).  When several
regions already sit in one table, pass the region as a column instead of a
literal and skip the union: one scan instead of one per region.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import config as C

Region = Union[str, Column]


def _region(region: Region) -> Column:
    return F.lit(region) if isinstance(region, str) else region


def client_key(region: Region, contract: Column) -> Column:
    """``<region>-<contract>``; null when the contract is null."""
    return F.concat(_region(region), F.lit("-"), contract)


def conform_transactions(df: DataFrame, spec: C.TransactionSpec, region: Region) -> DataFrame:
    """One transaction source in the conformed layout plus its signed amount.

    Renames the pass-through columns, prefixes the id so operation and concept
    ids cannot collide, tags the register type and derives the client key.
    """
    s = spec.source
    return df.select(
        F.col(s(C.INSERT_DATE)).alias(C.INSERT_DATE),
        F.concat(F.lit(spec.uuid_prefix), F.col(s(C.UUID))).alias(C.UUID),
        F.col(s(C.DATE)).alias(C.DATE),
        F.col(s(C.ACCOUNTING_DATE)).alias(C.ACCOUNTING_DATE),
        F.col(s(C.INVOICE)).alias(C.INVOICE),
        F.col(s(C.INVOICE_DESCRIPTION)).alias(C.INVOICE_DESCRIPTION),
        F.lit(spec.type_value).alias(C.TYPE),
        client_key(region, F.col(spec.contract)).alias(C.ID_CLIENT),
        F.col(spec.amount).alias(C.AMOUNT),
    )


def active_companies(df: DataFrame, spec: C.ClientSpec = C.ClientSpec()) -> DataFrame:
    """Companies with status '0' and a contract id."""
    return df.where(F.col(spec.status) == F.lit(C.ACTIVE_STATUS)).na.drop(subset=[spec.contract])


def conform_clients(df: DataFrame, spec: C.ClientSpec, region: Region) -> DataFrame:
    """Companies in the client layout: created_at, company_name, tax_id,
    client_id, country."""
    return df.select(
        F.col(spec.created_at).alias(C.CREATED_AT),
        F.col(spec.company_name).alias(C.COMPANY_NAME),
        F.col(spec.tax_id).alias(C.TAX_ID),
        client_key(region, F.col(spec.contract)).alias(C.CLIENT_ID),
        _region(region).alias(C.COUNTRY),
    )


def union_regions(frames: Mapping[str, DataFrame],
                  conform: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Conform each region's frame with its region code and union by name."""
    if not frames:
        raise ValueError("no regions given")
    parts = [conform(df, region) for region, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
