"""The user-visible jobs: bronze ingestion, silver tables, gold promotion and
reports.  Each job reads fixed snapshots, composes lazy operators and ends in
one sink per output table; no operator collects data to the driver.

Silver and gold tables are versioned (``ledgerflow.sources.tables``); those of
clients and transactions lie in ``dated`` folders, and a merge rewrites only the
folders it touches (``ledgerflow.sources.partitioned``).  Reports are CSV folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.functions.dates import AsOf, with_load_date
from ledgerflow.operators.changes import upsert
from ledgerflow.operators.ledger import (M_CODE, M_TYPE, changed_codes, due_transactions, matching_rows,
                                         normalise_map, post_normalised, reprocess_candidates)
from ledgerflow.operators.promote import changed_rows, history_since, newer_than, since
from ledgerflow.operators.reports import unmapped_invoices
from ledgerflow.plans import silver
from ledgerflow.sinks.reports import write_report, write_report_by_country
from ledgerflow.operators.joins import estimated_bytes
from ledgerflow.session import size_shuffle_partitions
from ledgerflow.sources.partitioned import (Layout, dated, delete_from_partitions, read_newest, read_with_layout, rows_of_keys,
                                            table_state, upsert_partitions)
from ledgerflow.sources.tables import (committed_versions, discard, latest_version, materialise, read_at,
                                       read_if_exists, read_landing_csv, read_landing_split, read_table,
                                       read_version_or_empty, upsert_table, version_path, write_snapshot)
from ledgerflow.streaming.ingest import ingest_available_now, merge_batch

Sources = Union[DataFrame, Mapping[str, DataFrame]]


@dataclass(frozen=True)
class Tables:
    """Where the silver and gold tables and the reports live."""

    silver: str
    gold: str
    reports: str
    #: What one folder of the dated tables holds: a day, or a month.
    unit: str = "day"

    def silver_table(self, name: str) -> str:
        return f"{self.silver.rstrip('/')}/{name}"

    def gold_table(self, name: str) -> str:
        return f"{self.gold.rstrip('/')}/{name}"

    def report(self, name: str) -> str:
        return f"{self.reports.rstrip('/')}/{name}"


ACTIVE_CLIENTS = "active_clients"
TRANSACTIONS = "transactions"
UNMAPPED = "transactions_out_of_report"
INVOICES_NOT_MAPPED = "invoices_not_mapped"
APPLIED_MAPPING = "transactions_mapping"


# --- bronze -----------------------------------------------------------------

def ingest_changes(spark: SparkSession, source_path: str, schema: T.StructType,
                   target_path: str, spec: C.ChangeFeedSpec, secret: Optional[str] = None,
                   pseudonymise_columns: Sequence[str] = (),
                   checkpoint: Optional[str] = None,
                   max_files_per_trigger: Optional[int] = None):
    """PIP-1: new change files since the last run, merged into bronze.

    ``max_files_per_trigger`` bounds each batch; it does not change what is
    stored (see ``streaming.ingest``).  Read the table with
    ``streaming.ingest.read_bronze``."""
    return ingest_available_now(spark, source_path, schema, target_path, spec, checkpoint,
                                pseudonymise_columns, secret,
                                max_files_per_trigger=max_files_per_trigger)


def ingest_changes_batch(spark: SparkSession, changes: DataFrame, target_path: str,
                         spec: C.ChangeFeedSpec, secret: Optional[str] = None,
                         pseudonymise_columns: Sequence[str] = ()):
    """PIP-1 on an explicit batch of changes (no bookmark)."""
    return merge_batch(spark, changes, target_path, spec, pseudonymise_columns, secret)


def load_sheet(spark: SparkSession, csv_path: str, target_path: str, as_of: AsOf = None,
               schema: Optional[T.StructType] = None, quarantine: Optional[str] = None) -> bool:
    """PIP-2: CSV landing file to a full-load table stamped with the load date;
    a missing or empty file is no data.

    With ``quarantine`` (a table path) malformed lines are kept there, stamped
    with the load date, and only whole rows are loaded.  Each load is a new snapshot version (partitioned by the load date parts),
    so a failed load never leaves the table missing or half written."""
    if read_if_exists(spark, csv_path, "text") is None:
        return False
    if quarantine is None:
        df = read_landing_csv(spark, csv_path, schema)
    else:
        df, bad = read_landing_split(spark, csv_path, schema)
        if not bad.isEmpty():
            kept, base = read_version_or_empty(spark, quarantine, with_load_date(bad, as_of).schema)
            write_snapshot(kept.unionByName(with_load_date(bad, as_of)), quarantine, base=base)
    if df.isEmpty():
        return False
    write_snapshot(with_load_date(df, as_of), target_path, partition_by=C.DATE_PARTS)
    return True


# --- silver -----------------------------------------------------------------

def _size(spark: SparkSession, *inputs: Sources) -> None:
    """Raise the session's shuffle partitions to what the inputs need (inputs
    whose size the planner does not know count nothing)."""
    frames = [f for x in inputs for f in (x.values() if isinstance(x, Mapping) else [x])]
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str(1 << 62)))
    size_shuffle_partitions(spark, sum(n for n in map(estimated_bytes, frames) if n < min(unknown, 1 << 60)))


def build_active_clients(spark: SparkSession, companies: Sources, tables: Tables,
                         spec: C.ClientSpec = C.ClientSpec(),
                         region: Optional[Union[str, Column]] = None) -> str:
    """PIP-3: active clients of every region, upserted by client id."""
    _size(spark, companies)
    clients = silver.active_clients(companies, spec, region)
    return _merge(spark, tables.silver_table(ACTIVE_CLIENTS), clients, C.CLIENT_KEY,
                  dated(C.CREATED_AT, tables.unit))


def build_unmapped(spark: SparkSession, operations: Sources, concepts: Sources,
                   mapping: DataFrame, tables: Tables,
                   operations_spec: C.TransactionSpec = C.OPERATIONS,
                   concepts_spec: C.TransactionSpec = C.CONCEPTS,
                   map_spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                   region: Optional[Union[str, Column]] = None) -> str:
    """PIP-5: transactions with no mapping row of their class, upserted by uuid."""
    _size(spark, operations, concepts)
    tx = silver.transactions(operations, concepts, operations_spec, concepts_spec, region)
    rows = silver.unmapped_transactions(tx, mapping, map_spec)
    return _merge(spark, tables.silver_table(UNMAPPED), rows, C.UNMAPPED_KEY, dated(C.INSERT_DATE, tables.unit))


def _merge(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], layout: Layout) -> str:
    """Upsert ``rows`` (computed once) into the table at ``path``; no rows, no
    new version."""
    rows = materialise(rows)
    try:
        return _merge_staged(spark, path, rows, keys, layout, {})
    finally:
        discard(rows)


def _merge_staged(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], layout: Layout,
                  state: Mapping[str, object]) -> str:
    version = latest_version(spark, path)
    if version and rows.isEmpty() and table_state(spark, path).items() >= state.items():
        return version_path(path, version)
    return upsert_partitions(spark, path, rows, keys, layout, state)


def build_ledger(spark: SparkSession, operations: Sources, concepts: Sources,
                 mapping: DataFrame, tables: Tables, as_of: AsOf = None,
                 operations_spec: C.TransactionSpec = C.OPERATIONS,
                 concepts_spec: C.TransactionSpec = C.CONCEPTS,
                 map_spec: C.ConceptMapSpec = C.ConceptMapSpec(),
                 region: Optional[Union[str, Column]] = None, full: bool = False) -> str:
    """PIP-4 and PIP-6: post the ledger, upsert it by (uuid, account_id) and
    restamp entries that sat in the unmapped table, in one write of the ledger;
    then delete those unmapped rows.

    A run records with its ledger version which mapping it applied and the
    newest insert date it saw.  The next run posts only what can differ from
    the stored entries: transactions inserted at that date or later, those of
    codes whose mapping rows changed, and those of codes with entries restamped
    since (posting again gives these their own date back, as posting everything
    does).  The ledger is the same as with ``full``, which
    posts everything; only a transaction that is changed without a newer insert
    date needs a full run.
    """
    _size(spark, operations, concepts)
    path, layout = tables.silver_table(TRANSACTIONS), dated(C.INSERT_DATE, tables.unit)
    tx = silver.transactions(operations, concepts, operations_spec, concepts_spec, region)
    newest = materialise(normalise_map(silver.newest_mapping(mapping, map_spec), map_spec))
    staged = [newest]
    try:
        mark = tx.agg(F.max(C.INSERT_DATE).cast("string")).first()[0]
        due, applied = tx, _applied(spark, tables)
        changed = None if applied is None else changed_codes(applied[1], newest)
        if applied is not None and not full:
            seen = None if applied[0] is None else F.lit(applied[0]).cast(tx.schema[C.INSERT_DATE].dataType)
            due = due_transactions(tx, changed.unionByName(_restamped_codes(spark, path)), seen)
        posted = materialise(post_normalised(due, newest))
        staged.append(posted)
        rows, pending, days = posted, _pending(spark, tables), []
        if pending is not None:
            again = materialise(reprocess_candidates(_known(spark, path, posted, pending), pending, as_of))
            staged.append(again)
            if not again.isEmpty():
                days = [str(again.select(F.col(C.INSERT_DATE).cast("date")).first()[0])]
                rows = materialise(upsert(posted, again, C.LEDGER_KEY))
                staged.append(rows)
        same = changed is not None and changed.isEmpty()
        version = applied[2] if same else _save_mapping(spark, tables, newest)
        written = _merge_staged(spark, path, rows, C.LEDGER_KEY, layout,
                                {"mark": mark, "mapping": version, "restamped": days})
        if pending is not None:
            _delete_posted(spark, tables, pending)
        return written
    finally:
        for frame in staged:
            discard(frame)


def _applied(spark: SparkSession, tables: Tables) -> Optional[tuple[Optional[str], DataFrame, int]]:
    """(mark, mapping, mapping version) of the run that wrote the ledger."""
    state = table_state(spark, tables.silver_table(TRANSACTIONS))
    if "mapping" not in state:
        return None
    path = tables.silver_table(APPLIED_MAPPING)
    if state["mapping"] not in committed_versions(spark, path):
        return None
    return state["mark"], read_at(spark, path, state["mapping"]), state["mapping"]


def _save_mapping(spark: SparkSession, tables: Tables, newest: DataFrame) -> int:
    path = tables.silver_table(APPLIED_MAPPING)
    base = latest_version(spark, path)
    write_snapshot(newest, path, base=base)
    return base + 1


def _restamped_codes(spark: SparkSession, path: str) -> DataFrame:
    """(code, type) of the entries that runs since the last posting restamped:
    only the folders of the days they were given are read."""
    ledger = read_with_layout(spark, path)
    codes = [F.col(C.INVOICE).alias(M_CODE), F.col(C.TYPE).alias(M_TYPE)]
    found = ledger.where(F.lit(False)).select(*codes)
    for day in table_state(spark, path).get("restamped", []):
        found = found.unionByName(history_since(ledger, C.INSERT_DATE, f"{day} 00:00:00").where(
            F.col(C.INSERT_DATE) == F.lit(day).cast(ledger.schema[C.INSERT_DATE].dataType)).select(*codes))
    return found.distinct()


def _known(spark: SparkSession, path: str, posted: DataFrame, pending: DataFrame) -> DataFrame:
    """Entries that may have to be restamped: ``posted``, and stored entries of
    pending uuids that are not posted anew (the rest of the ledger is not read
    beyond its uuids)."""
    if not latest_version(spark, path):
        return posted
    return upsert(rows_of_keys(read_table(spark, path), pending, [C.UUID]), posted, C.LEDGER_KEY)


def _pending(spark: SparkSession, tables: Tables) -> Optional[DataFrame]:
    """The unmapped table, if it has rows."""
    try:
        found = read_table(spark, tables.silver_table(UNMAPPED))
    except FileNotFoundError:
        return None
    return None if found.isEmpty() else found


def _delete_posted(spark: SparkSession, tables: Tables, pending: DataFrame) -> None:
    """Delete unmapped rows that the committed ledger now holds; of the ledger
    only entries of pending uuids are read."""
    ledger = rows_of_keys(read_table(spark, tables.silver_table(TRANSACTIONS)), pending, [C.UUID])
    gone = materialise(matching_rows(pending, ledger))
    try:
        if not gone.isEmpty():
            delete_from_partitions(spark, tables.silver_table(UNMAPPED), gone, C.UNMAPPED_KEY, dated(C.INSERT_DATE, tables.unit))
    finally:
        discard(gone)


def reprocess(spark: SparkSession, tables: Tables, as_of: AsOf = None,
              restamp_parts: bool = False) -> bool:
    """PIP-6 alone: ledger rows whose (uuid, invoice) sat in the unmapped table
    are restamped to yesterday; then those unmapped rows are deleted.

    Both steps read fixed versions: the ledger upsert is committed before the
    delete set is computed from the new ledger version.  Without candidates
    nothing is written.
    """
    path = tables.silver_table(TRANSACTIONS)
    if not latest_version(spark, path):
        return False
    pending = _pending(spark, tables)
    if pending is None:
        return False
    stored = rows_of_keys(read_table(spark, path), pending, [C.UUID])
    again = materialise(reprocess_candidates(stored, pending, as_of, restamp_parts=restamp_parts))
    try:
        if not again.isEmpty():
            day = str(again.select(F.col(C.INSERT_DATE).cast("date")).first()[0])
            days = sorted({*table_state(spark, path).get("restamped", []), day})
            upsert_partitions(spark, path, again, C.LEDGER_KEY, dated(C.INSERT_DATE, tables.unit), {"restamped": days})
    finally:
        discard(again)
    _delete_posted(spark, tables, pending)
    return True


# --- gold -------------------------------------------------------------------

def _gold(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return read_table(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], like.schema).drop(*C.PERIODS.values())


def _newest_gold(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return read_newest(spark, path)
    except FileNotFoundError:
        return _gold(spark, path, like)


def _promote_new(spark: SparkSession, tables: Tables, name: str, column: str,
                 keys: Sequence[str]) -> DataFrame:
    """Merge silver rows newer than gold's newest into gold; returns gold with
    its layout.  Silver folders of earlier days are not read, and of gold only
    its newest folder is."""
    current = read_with_layout(spark, tables.silver_table(name))
    gold_path = tables.gold_table(name)
    _merge(spark, gold_path, newer_than(current, _newest_gold(spark, gold_path, current), column), keys, dated(column, tables.unit))
    return read_with_layout(spark, gold_path)


def incoming_clients(spark: SparkSession, tables: Tables, as_of: AsOf = None) -> bool:
    """PIP-7 (clients): promote clients newer than gold's newest, report
    yesterday's."""
    gold = _promote_new(spark, tables, ACTIVE_CLIENTS, C.CREATED_AT, C.CLIENT_KEY)
    return write_report(since(gold, C.CREATED_AT, as_of), tables.report("incoming_clients"))


def incoming_transactions(spark: SparkSession, tables: Tables, as_of: AsOf = None) -> bool:
    """PIP-7 (transactions)."""
    gold = _promote_new(spark, tables, TRANSACTIONS, C.INSERT_DATE, C.LEDGER_KEY)
    return write_report(since(gold, C.INSERT_DATE, as_of), tables.report("incoming_transactions"))


def updated_clients(spark: SparkSession, tables: Tables) -> bool:
    """PIP-8: report clients whose name or tax id changed, then save them to
    gold (the report is written first, or the difference would be gone)."""
    current = read_table(spark, tables.silver_table(ACTIVE_CLIENTS))
    gold_path = tables.gold_table(ACTIVE_CLIENTS)
    changed = materialise(changed_rows(current, _gold(spark, gold_path, current), C.CLIENT_ID))
    try:
        written = write_report(changed.drop(*C.DATE_PARTS), tables.report("updated_clients"))
        _merge(spark, gold_path, changed, C.CLIENT_KEY, dated(C.CREATED_AT, tables.unit))
        return written
    finally:
        discard(changed)


def invoices_not_mapped(spark: SparkSession, tables: Tables, as_of: AsOf = None) -> None:
    """PIP-9: distinct unmapped invoices, saved to gold; the report per country
    holds those that are unmapped now, not all that gold has ever held."""
    invoices = materialise(unmapped_invoices(read_table(spark, tables.silver_table(UNMAPPED)), as_of))
    try:
        upsert_table(spark, tables.gold_table(INVOICES_NOT_MAPPED), invoices, C.INVOICE_REPORT_KEY,
                     materialise_source=False)
        write_report_by_country(invoices, tables.report("invoices_not_mapped"))
    finally:
        discard(invoices)


def historical_clients(spark: SparkSession, tables: Tables,
                       start: str = C.HISTORY_START) -> bool:
    """PIP-10 (clients): save updated clients to gold, report the history."""
    current = read_with_layout(spark, tables.silver_table(ACTIVE_CLIENTS))
    gold_path = tables.gold_table(ACTIVE_CLIENTS)
    changed = changed_rows(current.drop(*C.PERIODS.values()), _gold(spark, gold_path, current), C.CLIENT_ID)
    _merge(spark, gold_path, changed, C.CLIENT_KEY, dated(C.CREATED_AT, tables.unit))
    return write_report(history_since(current, C.CREATED_AT, start), tables.report("incoming_clients"))


def historical_transactions(spark: SparkSession, tables: Tables,
                            start: str = C.HISTORY_START) -> bool:
    """PIP-10 (transactions): save new transactions to gold, report the history."""
    current = read_with_layout(spark, tables.silver_table(TRANSACTIONS))
    _promote_new(spark, tables, TRANSACTIONS, C.INSERT_DATE, C.LEDGER_KEY)
    return write_report(history_since(current, C.INSERT_DATE, start),
                        tables.report("incoming_transactions"))
