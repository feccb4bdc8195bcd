"""Silver-layer frames composed from the operators (lazy, no I/O).

These are the building blocks the jobs and the registered queries share:
conformed transactions, the newest mapping, the ledger, unmapped entries and
active clients.
"""

from __future__ import annotations

from typing import Mapping, Optional, Union

from pyspark.sql import Column, DataFrame

from ledgerflow import config as C
from ledgerflow.functions.dates import with_date_parts
from ledgerflow.operators.conform import (active_companies, conform_clients,
                                          conform_transactions, union_regions)
from ledgerflow.operators.ledger import (latest_snapshot, post_ledger, sign_split,
                                         unmapped)

Region = Union[str, Column]
Sources = Union[DataFrame, Mapping[str, DataFrame]]


def _conformed(sources: Sources, spec: C.TransactionSpec, region: Optional[Region]) -> DataFrame:
    if isinstance(sources, DataFrame):
        if region is None:
            raise ValueError("a single frame needs its region (literal or column)")
        return conform_transactions(sources, spec, region)
    return union_regions(sources, lambda df, r: conform_transactions(df, spec, r))


def transactions(operations: Sources, concepts: Sources,
                 operations_spec: C.TransactionSpec = C.OPERATIONS,
                 concepts_spec: C.TransactionSpec = C.CONCEPTS,
                 region: Optional[Region] = None) -> DataFrame:
    """Operations and economic-concept transactions of every region, sign
    split, with unpadded year/month/day of the insert date.

    Each source is either one frame per region (``{"MX": df, ...}``) or one
    frame holding all regions, with ``region`` naming its region column.
    """
    ops = _conformed(operations, operations_spec, region)
    ecs = _conformed(concepts, concepts_spec, region)
    return with_date_parts(sign_split(ops.unionByName(ecs)), C.INSERT_DATE)


def newest_mapping(mapping: DataFrame, spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                   order: str = "calendar") -> DataFrame:
    return latest_snapshot(mapping, spec, order=order)


def ledger(tx: DataFrame, mapping: DataFrame, spec: C.ConceptMapSpec = C.ConceptMapSpec(),
           order: str = "calendar") -> DataFrame:
    """Posted ledger entries of ``tx`` under the newest mapping."""
    return post_ledger(tx, newest_mapping(mapping, spec, order), spec)


def unmapped_transactions(tx: DataFrame, mapping: DataFrame,
                          spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                          order: str = "calendar") -> DataFrame:
    return unmapped(tx, newest_mapping(mapping, spec, order), spec)


def active_clients(companies: Sources, spec: C.ClientSpec = C.ClientSpec(),
                   region: Optional[Region] = None) -> DataFrame:
    """Active companies of every region in the client layout, with unpadded
    year/month/day of ``created_at``."""
    if isinstance(companies, DataFrame):
        if region is None:
            raise ValueError("a single frame needs its region (literal or column)")
        clients = conform_clients(active_companies(companies, spec), spec, region)
    else:
        clients = union_regions(
            companies, lambda df, r: conform_clients(active_companies(df, spec), spec, r))
    return with_date_parts(clients, C.CREATED_AT)
