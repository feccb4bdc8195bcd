"""Double-entry posting of signed transactions through a concept mapping.

The step-by-step operators (``sign_split``, ``mirror``, ``map_concepts``,
``post``, ``absolute``, ``drop_no_posting``) each keep the exact semantics of
one step of the original jobs and are usable on their own.  ``post_ledger`` and
``unmapped`` compute the same rows in a single pass: every entry a source row
can produce is generated with ``inline`` (a ``Generate`` node, no union and no
second scan), tagged with the posting class its sign implies, and matched to
the mapping with one equi-join on (code, type, class).  The mapping side is
broadcast only after its size is checked.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.functions.postings import class_labels, class_of
from ledgerflow.operators.joins import bounded_broadcast, sized_join

# Internal names of the normalised mapping columns (kept distinct from the
# transaction columns so joins need no aliasing).
M_CODE = "map_code"
M_CLASS = "map_class"
M_TYPE = "map_type"
M_DESCRIPTION = "map_description"
M_DEBIT = "map_debit_account"
M_CREDIT = "map_credit_account"
MAP_COLUMNS = (M_CODE, M_CLASS, M_TYPE, M_DESCRIPTION, M_DEBIT, M_CREDIT)

# Internal names used while generating entries.
_SIDE = "_side"
_KEY_AMOUNT = "_key_amount"
_ENTRY_CLASS = "_entry_class"


# ---------------------------------------------------------------------------
# Mapping sheet
# ---------------------------------------------------------------------------

def snapshot_date(spec: C.ConceptMapSpec, order: str = "calendar") -> Column:
    """Orderable load date of a mapping row from its year/month/day texts.

    ``calendar`` builds a real date (bad parts give null, which never wins).
    ``concat`` reproduces the legacy key: the unpadded parts concatenated and
    read as an integer, under which 2023-1-15 and 2023-11-5 collide.
    """
    y, m, d = F.col(spec.year), F.col(spec.month), F.col(spec.day)
    if order == "calendar":
        return F.try_to_date(F.concat_ws("-", y, m, d), "y-M-d")
    if order == "concat":
        return F.concat(y, m, d).try_cast("int")
    raise ValueError(f"unknown snapshot order {order!r}")


def latest_snapshot(mapping: DataFrame, spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                    keys: Optional[tuple[str, ...]] = None,
                    order: str = "calendar") -> DataFrame:
    """Newest mapping rows per (code, posting class); ties on the newest date
    are all kept, exact duplicates collapse, date parts are dropped.

    The partition deliberately leaves out the register type (as the source job
    does); pass ``keys`` to choose another partition.
    """
    keys = keys or (spec.code, spec.posting_class)
    seq = "_snapshot_seq"
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(F.col(seq).desc())
    parts = [spec.year, spec.month, spec.day]
    return (mapping
            .withColumn(seq, snapshot_date(spec, order))
            .where(F.col(seq).isNotNull())
            .withColumn("_rank", F.rank().over(w))
            .where(F.col("_rank") == 1)
            .drop("_rank", seq)
            .distinct()
            .drop(*parts))


def normalise_map(mapping: DataFrame, spec: C.ConceptMapSpec = C.ConceptMapSpec()) -> DataFrame:
    """Mapping rows with the internal column names used by the joins."""
    return mapping.select(
        F.col(f"`{spec.code}`").alias(M_CODE),
        F.col(f"`{spec.posting_class}`").alias(M_CLASS),
        F.col(f"`{spec.register_type}`").alias(M_TYPE),
        F.col(f"`{spec.description}`").alias(M_DESCRIPTION),
        F.col(f"`{spec.debit_account}`").alias(M_DEBIT),
        F.col(f"`{spec.credit_account}`").alias(M_CREDIT),
    )


# ---------------------------------------------------------------------------
# Step-by-step operators
# ---------------------------------------------------------------------------

def sign_split(df: DataFrame, amount: str = C.AMOUNT) -> DataFrame:
    """One signed amount to two one-sided columns in one pass: non-negative
    to ``amount_d``, negative to ``amount_c``; rows without an amount drop."""
    a = F.col(amount)
    cols = [c for c in df.columns if c != amount]
    return (df.where(a.isNotNull())
            .select(*cols, F.when(a >= 0, a).alias(C.AMOUNT_D),
                    F.when(a < 0, a).alias(C.AMOUNT_C)))


def mirror(df: DataFrame) -> DataFrame:
    """Each row plus a copy with debit and credit swapped (double entry)."""
    d, c = F.col(C.AMOUNT_D), F.col(C.AMOUNT_C)
    others = [x for x in df.columns if x not in (C.AMOUNT_D, C.AMOUNT_C)]
    pairs = F.array(F.struct(d.alias(C.AMOUNT_D), c.alias(C.AMOUNT_C)),
                    F.struct(c.alias(C.AMOUNT_D), d.alias(C.AMOUNT_C)))
    return df.select(*others, F.inline(pairs)).select(*df.columns)


def map_concepts(df: DataFrame, mapping: DataFrame,
                 spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                 broadcast: Optional[bool] = None) -> DataFrame:
    """Transactions joined to every mapping row of their (code, type).

    The mapping's description replaces the transaction's and its posting class
    and both accounts are added.
    """
    joined = sized_join(df, normalise_map(mapping, spec), [(C.INVOICE, M_CODE), (C.TYPE, M_TYPE)], force=broadcast)
    parts = [c for c in C.DATE_PARTS if c in df.columns]
    return joined.select(
        *[F.col(M_DESCRIPTION).alias(c) if c == C.INVOICE_DESCRIPTION else F.col(c)
          for c in df.columns if c not in parts],
        F.col(M_CLASS).alias(C.POSTING_CLASS),
        F.col(M_DEBIT).alias(C.DEBIT_ACCOUNT),
        F.col(M_CREDIT).alias(C.CREDIT_ACCOUNT),
        *parts,
    )


def post(df: DataFrame, posting_class: str) -> DataFrame:
    """Rows of one posting class with their account: a debit amount of the
    class's sign posts to the debit account, a credit amount to the credit
    account (a row with both posts twice).  Output has ``account_id`` in place
    of the two account columns."""
    cls = F.col(C.POSTING_CLASS)
    if posting_class == C.NORMAL:
        d_ok, c_ok = F.col(C.AMOUNT_D) >= 0, F.col(C.AMOUNT_C) >= 0
    elif posting_class == C.CORRECTING:
        d_ok, c_ok = F.col(C.AMOUNT_D) < 0, F.col(C.AMOUNT_C) < 0
    else:
        raise ValueError(f"unknown posting class {posting_class!r}")
    base = [c for c in df.columns if c not in (C.DEBIT_ACCOUNT, C.CREDIT_ACCOUNT) + C.DATE_PARTS]
    parts = [c for c in C.DATE_PARTS if c in df.columns]
    entries = F.array(
        F.struct(F.lit("D").alias(_SIDE), F.coalesce(d_ok, F.lit(False)).alias("_ok")),
        F.struct(F.lit("C").alias(_SIDE), F.coalesce(c_ok, F.lit(False)).alias("_ok")))
    return (df.where(cls == F.lit(posting_class))
            .select("*", F.inline(entries))
            .where(F.col("_ok"))
            .select(*base,
                    F.when(F.col(_SIDE) == "D", F.col(C.DEBIT_ACCOUNT))
                    .otherwise(F.col(C.CREDIT_ACCOUNT)).alias(C.ACCOUNT_ID),
                    *parts))


def absolute(df: DataFrame) -> DataFrame:
    """Absolute amounts, in the ledger column order."""
    out = df.withColumns({C.AMOUNT_D: F.abs(C.AMOUNT_D), C.AMOUNT_C: F.abs(C.AMOUNT_C)})
    return out.select(*[c for c in C.LEDGER_COLUMNS if c in out.columns])


def drop_no_posting(df: DataFrame, column: str = C.ACCOUNT_ID) -> DataFrame:
    """Drop entries whose account is a no-posting marker or null."""
    acct = F.col(column)
    return df.where(acct.isNotNull() & ~acct.isin(*C.NO_POSTING_ACCOUNTS))


def post_ledger_stepwise(df: DataFrame, mapping: DataFrame,
                         spec: C.ConceptMapSpec = C.ConceptMapSpec()) -> DataFrame:
    """The ledger as the original step sequence (mirror, join, post each
    class, absolute, drop markers).  Reference shape for tests and benchmarks;
    use ``post_ledger``."""
    joined = map_concepts(mirror(df), mapping, spec)
    posted = post(joined, C.NORMAL).unionByName(post(joined, C.CORRECTING))
    return drop_no_posting(absolute(posted))


# ---------------------------------------------------------------------------
# Single-pass operators
# ---------------------------------------------------------------------------

def _entries(df: DataFrame) -> DataFrame:
    """Every ledger entry a row can produce, before the mapping is known.

    Mirroring a row (d, c) and posting both copies yields at most four
    entries; each is decided by the sign of one amount, which fixes its class:

        debit side  of the row    : amounts (d, c), decided by d
        credit side of the row    : amounts (d, c), decided by c
        debit side  of the mirror : amounts (c, d), decided by c
        credit side of the mirror : amounts (c, d), decided by d

    Entries whose deciding amount is null can never post and are dropped here.
    """
    d, c = F.col(C.AMOUNT_D), F.col(C.AMOUNT_C)

    def entry(side: str, first: Column, second: Column, key: Column) -> Column:
        return F.struct(first.alias(C.AMOUNT_D), second.alias(C.AMOUNT_C),
                        F.lit(side).alias(_SIDE), key.alias(_KEY_AMOUNT))

    others = [x for x in df.columns if x not in (C.AMOUNT_D, C.AMOUNT_C)]
    four = F.array(entry("D", d, c, d), entry("C", d, c, c),
                   entry("D", c, d, c), entry("C", c, d, d))
    return (df.select(*others, F.inline(four))
            .where(F.col(_KEY_AMOUNT).isNotNull())
            .withColumn(_ENTRY_CLASS, class_of(F.col(_KEY_AMOUNT))))


def post_ledger(df: DataFrame, mapping: DataFrame,
                spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                broadcast: Optional[bool] = None) -> DataFrame:
    """Ledger entries of sign-split transactions (with date parts): equal, row
    for row, to ``post_ledger_stepwise``, in one scan and one join."""
    return post_normalised(df, normalise_map(mapping, spec), broadcast)


def post_normalised(df: DataFrame, mapping: DataFrame, broadcast: Optional[bool] = None) -> DataFrame:
    """``post_ledger`` with a mapping that has ``normalise_map``'s columns."""
    on = [(C.INVOICE, M_CODE), (C.TYPE, M_TYPE), (_ENTRY_CLASS, M_CLASS)]
    posted = sized_join(_entries(df), mapping, on, force=broadcast).select(
        *[F.col(M_DESCRIPTION).alias(c) if c == C.INVOICE_DESCRIPTION else F.col(c)
          for c in C.TRANSACTION_COLUMNS],
        F.col(M_CLASS).alias(C.POSTING_CLASS),
        F.abs(C.AMOUNT_D).alias(C.AMOUNT_D),
        F.abs(C.AMOUNT_C).alias(C.AMOUNT_C),
        F.when(F.col(_SIDE) == "D", F.col(M_DEBIT)).otherwise(F.col(M_CREDIT)).alias(C.ACCOUNT_ID),
        *C.DATE_PARTS,
    )
    return drop_no_posting(posted)


def classify(df: DataFrame) -> DataFrame:
    """Each row labelled with its posting class(es) in ``normal_correctora``:
    Normal if either side is >= 0, Correctora if either is < 0.  A row with both
    kinds of side appears once per class, a row with no amount not at all."""
    labels = class_labels(F.col(C.AMOUNT_D), F.col(C.AMOUNT_C))
    cols = [c for c in df.columns if c != C.POSTING_CLASS]
    return (df.select(*cols, F.explode(labels).alias(C.POSTING_CLASS))
            .where(F.col(C.POSTING_CLASS).isNotNull()))


def unmapped(df: DataFrame, mapping: DataFrame,
             spec: C.ConceptMapSpec = C.ConceptMapSpec(),
             broadcast: Optional[bool] = None) -> DataFrame:
    """Transactions with no mapping row of their (code, type, class): rows of
    each class anti-joined against that class's mapping rows.  A row with sides
    of both classes is tested for each (and can appear twice)."""
    m = normalise_map(mapping, spec).select(M_CODE, M_TYPE, M_CLASS)
    on = [(C.INVOICE, M_CODE), (C.TYPE, M_TYPE), (C.POSTING_CLASS, M_CLASS)]
    cols = [c for c in C.UNMAPPED_COLUMNS if c in df.columns]
    return sized_join(classify(df), m, on, "left_anti", broadcast).select(*cols)


def unmapped_class(df: DataFrame, mapping: DataFrame, posting_class: str,
                   spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                   broadcast: Optional[bool] = None) -> DataFrame:
    """``unmapped`` for one posting class only."""
    rows = classify(df).where(F.col(C.POSTING_CLASS) == posting_class).drop(C.POSTING_CLASS)
    m = normalise_map(mapping, spec).where(F.col(M_CLASS) == posting_class).select(M_CODE, M_TYPE)
    cols = [c for c in C.UNMAPPED_COLUMNS if c in df.columns]
    return sized_join(rows, m, [(C.INVOICE, M_CODE), (C.TYPE, M_TYPE)], "left_anti", broadcast).select(*cols)


# ---------------------------------------------------------------------------
# Incremental posting
# ---------------------------------------------------------------------------

def changed_codes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(code, type) of every mapping row that one of two mappings (with the
    columns of ``normalise_map``) has more often than the other."""
    differ = before.exceptAll(after).unionByName(after.exceptAll(before))
    return differ.select(M_CODE, M_TYPE).distinct()


def due_transactions(df: DataFrame, codes: DataFrame, mark: Optional[Column]) -> DataFrame:
    """Transactions that an incremental run has to post: inserted at or after
    ``mark`` (or at no known time; all without a mark), or of a changed code.

    One scan: the few changed codes are joined as a flag, so both reasons are
    one filter and no row comes twice.
    """
    if mark is None:
        return df
    flag = "_due"
    due = bounded_broadcast(codes.select(M_CODE, M_TYPE).distinct().withColumn(flag, F.lit(True)))
    joined = df.join(due, (F.col(C.INVOICE) == F.col(M_CODE)) & (F.col(C.TYPE) == F.col(M_TYPE)), "left")
    return joined.where(F.coalesce(F.col(flag), F.lit(False)) | F.col(C.INSERT_DATE).isNull()
                        | (F.col(C.INSERT_DATE) >= mark)).select(*df.columns)


# ---------------------------------------------------------------------------
# Reprocessing
# ---------------------------------------------------------------------------

def matching_rows(df: DataFrame, other: DataFrame, cutoff: Optional[str] = C.REPROCESS_CUTOFF_DATE,
                  keys: tuple[str, ...] = (C.UUID, C.INVOICE), few: bool = False) -> DataFrame:
    """Rows of ``df`` whose (uuid, invoice) also occurs in ``other`` and whose
    business date is strictly after ``cutoff``: a timestamp is compared with
    the cut-off's midnight, a date with the date, text is parsed first (never
    compared as text; text that does not parse never passes).

    ``other``'s keys are de-duplicated before the shuffle (partial aggregation
    collapses hot keys map-side), then a left-semi join keeps each row of
    ``df`` at most once.  With ``few`` (``df`` is small beside ``other``)
    ``other`` is first reduced to the keys of ``df``, so a large ledger is not
    aggregated for a handful of pending rows.
    """
    key_rows = other.select(*keys)
    if few:
        key_rows = key_rows.join(df.select(*keys).distinct(), list(keys), "left_semi")
    key_rows = key_rows.distinct()
    out = df.join(key_rows, list(keys), "left_semi")
    if cutoff is not None:
        out = out.where(_after(df, C.DATE, cutoff))
    return out.select(*df.columns)


def _after(df: DataFrame, column: str, cutoff: str) -> Column:
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column) > F.lit(cutoff).cast(dtype.simpleString())
    return F.col(column).try_cast("timestamp") > F.lit(cutoff).cast("timestamp")


def reprocess_candidates(ledger: DataFrame, unmapped_df: DataFrame, as_of=None,
                         cutoff: Optional[str] = C.REPROCESS_CUTOFF_DATE,
                         restamp_parts: bool = False) -> DataFrame:
    """Ledger rows that were unmapped before, restamped to yesterday so the
    incremental reports pick them up again."""
    from ledgerflow.functions.dates import with_date_parts, yesterday

    rows = matching_rows(ledger, unmapped_df, cutoff)
    dtype = ledger.schema[C.INSERT_DATE].dataType.simpleString()
    out = rows.withColumn(C.INSERT_DATE, yesterday(as_of).cast(dtype))
    if restamp_parts:
        out = with_date_parts(out, C.INSERT_DATE)
    return out
