"""Posting-class expressions (Normal / Correctora) over debit and credit amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import config as C


def class_of(value: Column) -> Column:
    """Posting class implied by the sign of one amount: zero counts as Normal,
    a null amount has no class."""
    return F.when(value >= 0, F.lit(C.NORMAL)).when(value < 0, F.lit(C.CORRECTING))


def is_normal(debit: Column, credit: Column) -> Column:
    """Either side non-negative; three-valued, so two nulls do not qualify."""
    return (debit >= 0) | (credit >= 0)


def is_correcting(debit: Column, credit: Column) -> Column:
    return (debit < 0) | (credit < 0)


def class_labels(debit: Column, credit: Column) -> Column:
    """Two-slot array of the classes a row belongs to (Normal, Correctora);
    a slot is null when the row is not of that class.  Explode it and drop
    the nulls (a plain filter keeps the stage in whole-stage codegen, unlike
    ``array_compact``'s lambda)."""
    return F.array(
        F.when(F.coalesce(is_normal(debit, credit), F.lit(False)), F.lit(C.NORMAL)),
        F.when(F.coalesce(is_correcting(debit, credit), F.lit(False)), F.lit(C.CORRECTING)),
    )
