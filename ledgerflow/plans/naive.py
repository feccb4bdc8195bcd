"""Naive plan shapes of the original jobs, kept only as benchmark baselines.

They compute the same rows as the library operators but the way the source
jobs wrote them: sign split, mirror and posting by unions of filtered copies,
unmapped rows by left join plus null test, newest rows by a window ``max``,
the high-water mark by sort + ``first()`` on the driver.  Do not use them in
pipelines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.operators.ledger import normalise_map

_TX = list(C.TRANSACTION_COLUMNS)


def sign_split(df: DataFrame) -> DataFrame:
    a = F.col(C.AMOUNT)
    pos = df.where(a >= 0).select(*_TX, a.alias(C.AMOUNT_D), F.lit(None).cast("double").alias(C.AMOUNT_C))
    neg = df.where(a < 0).select(*_TX, F.lit(None).cast("double").alias(C.AMOUNT_D), a.alias(C.AMOUNT_C))
    return pos.union(neg)


def mirror(df: DataFrame) -> DataFrame:
    swapped = df.select(*[F.col(C.AMOUNT_C).alias(C.AMOUNT_D) if c == C.AMOUNT_D
                          else F.col(C.AMOUNT_D).alias(C.AMOUNT_C) if c == C.AMOUNT_C
                          else F.col(c) for c in df.columns])
    return df.union(swapped)


def post_ledger(tx: DataFrame, mapping: DataFrame, spec: C.ConceptMapSpec) -> DataFrame:
    m = normalise_map(mapping, spec)
    # The source jobs wrote a cross join plus a filter; Catalyst plans both as
    # this equi-join, so the baseline states the condition directly.
    j = mirror(tx).join(m, (F.col(C.INVOICE) == F.col("map_code")) & (F.col(C.TYPE) == F.col("map_type")))
    base = [F.col("map_description").alias(c) if c == C.INVOICE_DESCRIPTION else F.col(c) for c in _TX]

    def branch(side: str, cond, cls: str, acct: str) -> DataFrame:
        return j.where(cond & (F.col("map_class") == cls)).select(
            *base, F.col("map_class").alias(C.POSTING_CLASS), F.abs(C.AMOUNT_D).alias(C.AMOUNT_D),
            F.abs(C.AMOUNT_C).alias(C.AMOUNT_C), F.col(acct).alias(C.ACCOUNT_ID), *C.DATE_PARTS)

    d, c = F.col(C.AMOUNT_D), F.col(C.AMOUNT_C)
    parts = [branch("D", d >= 0, C.NORMAL, "map_debit_account"),
             branch("C", c >= 0, C.NORMAL, "map_credit_account"),
             branch("D", d < 0, C.CORRECTING, "map_debit_account"),
             branch("C", c < 0, C.CORRECTING, "map_credit_account")]
    out = reduce(DataFrame.union, parts)
    return out.where(~F.col(C.ACCOUNT_ID).isin(*C.NO_POSTING_ACCOUNTS)).na.drop(subset=[C.ACCOUNT_ID])


def unmapped(tx: DataFrame, mapping: DataFrame, spec: C.ConceptMapSpec) -> DataFrame:
    m = normalise_map(mapping, spec)
    d, c = F.col(C.AMOUNT_D), F.col(C.AMOUNT_C)

    def half(rows: DataFrame, cls: str) -> DataFrame:
        mm = m.where(F.col("map_class") == cls)
        return (rows.join(mm, (rows[C.INVOICE] == mm["map_code"]) & (rows[C.TYPE] == mm["map_type"]), "left")
                .where(F.col("map_code").isNull() & F.col("map_type").isNull())
                .select(*[c for c in C.UNMAPPED_COLUMNS]))

    return half(tx.where((d >= 0) | (c >= 0)), C.NORMAL).union(
        half(tx.where((d < 0) | (c < 0)), C.CORRECTING))


def latest_by_key(df: DataFrame, keys, sequence: str) -> DataFrame:
    w = Window.partitionBy(*keys)
    return (df.withColumn("_mx", F.max(sequence).over(w))
            .where(F.col(sequence) == F.col("_mx")).drop("_mx", sequence))


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    if target.isEmpty():
        return source
    mark = target.select(column).sort(F.col(column).desc()).first()[0]
    return source.where(F.col(column) > F.lit(mark))
