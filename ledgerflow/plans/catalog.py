"""Registered queries: every operator and job of the library over the driver's
test tables (through ``ledgerflow.sources.fixtures``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole
tables.  ``ledgerflow.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import uuid
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.functions.dates import with_date_parts, with_load_date, yesterday
from ledgerflow.functions.privacy import pseudonymise, pseudonymise_keyed
from ledgerflow.operators import changes, ledger as L, promote
from ledgerflow.operators.conform import (active_companies, conform_clients,
                                          conform_transactions, union_regions)
from ledgerflow.operators.reports import unmapped_invoices
from ledgerflow.plans import jobs, silver
from ledgerflow.session import shared_base
from ledgerflow.sinks.reports import of_countries
from ledgerflow.sources import partitioned
from ledgerflow.sources.tables import BAD_LINE, discard, materialise, read_landing_split, read_table
from ledgerflow.streaming.ingest import merge_batch, read_bronze
from ledgerflow.sources.fixtures import (FX_CDC, FX_CLIENTS, FX_CONCEPTS, FX_MAP,
                                         FX_OPERATIONS, Fixtures)

# Parameters of the registered runs (fixed so that the oracle can match them).
AS_OF = "2024-01-31"                 # "today" of the transaction jobs
CLIENTS_AS_OF = "1998-01-01"         # "today" of the client reports
GOLD_TX_BEFORE = "2024-01-20"        # gold ledger holds rows inserted before this
GOLD_CLIENTS_BEFORE = "1996-01-01"   # gold clients hold rows created before this
CLIENT_HISTORY_START = "1996-01-01 00:00:00.000"
SECRET = "fixture-secret"            # test-only pseudonymisation key
PSEUDONYMISED_CDC = ("l_quantity",)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name (a ``_q`` suffix, used where the name
    would shadow an imported operator, is dropped)."""
    QUERIES[fn.__name__.removesuffix("_q")] = fn
    return fn


# --- shared compositions ----------------------------------------------------

def _tx(fx: Fixtures) -> DataFrame:
    return silver.transactions(fx.operations, fx.concepts, FX_OPERATIONS, FX_CONCEPTS,
                               region=F.col("country"))


def _map(fx: Fixtures, order: str = "calendar") -> DataFrame:
    return silver.newest_mapping(fx.concept_map, FX_MAP, order)


def _ledger(fx: Fixtures, order: str = "calendar") -> DataFrame:
    return L.post_ledger(_tx(fx), _map(fx, order), FX_MAP)


def _unmapped(fx: Fixtures) -> DataFrame:
    return L.unmapped(_tx(fx), _map(fx), FX_MAP)


def _unmapped_v1(fx: Fixtures) -> DataFrame:
    return L.unmapped(_tx(fx), silver.newest_mapping(fx.concept_map_v1, FX_MAP), FX_MAP)


def _clients(fx: Fixtures) -> DataFrame:
    return silver.active_clients(fx.companies, FX_CLIENTS, region=F.col("country"))


def _gold_ledger(fx: Fixtures, ledger: Optional[DataFrame] = None) -> DataFrame:
    led = _ledger(fx) if ledger is None else ledger
    return led.where(F.col(C.INSERT_DATE) < F.lit(GOLD_TX_BEFORE).cast("timestamp_ntz"))


def _gold_clients(fx: Fixtures) -> DataFrame:
    cl = _clients(fx)
    return cl.where(F.col(C.CREATED_AT) < F.lit(GOLD_CLIENTS_BEFORE).cast("timestamp_ntz"))


def _prev_clients(fx: Fixtures) -> DataFrame:
    return fx.clients_prev.select(F.col("client_id").alias(C.CLIENT_ID),
                                  F.col("legal_name").alias(C.COMPANY_NAME),
                                  F.col("tax_id").alias(C.TAX_ID))


# --- sources and change capture ---------------------------------------------

@query
def scan_change_feed(spark, sf_dir):
    return Fixtures.of(spark, sf_dir).cdc


@query
def fill_op_code(spark, sf_dir):
    return changes.fill_op(Fixtures.of(spark, sf_dir).cdc, FX_CDC.op)


@query
def latest_by_key(spark, sf_dir):
    return changes.latest_by_key(Fixtures.of(spark, sf_dir).cdc, FX_CDC.keys, FX_CDC.sequence)


@query
def latest_by_key_one(spark, sf_dir):
    return changes.latest_by_key(Fixtures.of(spark, sf_dir).cdc, FX_CDC.keys, FX_CDC.sequence,
                                 ties="one", tie_break=FX_CDC.tie_break)


@query
def date_parts_padded(spark, sf_dir):
    return with_date_parts(Fixtures.of(spark, sf_dir).cdc, FX_CDC.timestamp, padded=True)


@query
def pseudonymise_q(spark, sf_dir):
    return pseudonymise(Fixtures.of(spark, sf_dir).companies, ["legal_name", "tax_id"], SECRET)


@query
def pseudonymise_keyed_q(spark, sf_dir):
    """Keyed pseudonyms (HMAC-SHA256) that name their key's version."""
    return pseudonymise_keyed(Fixtures.of(spark, sf_dir).companies, ["legal_name", "tax_id", "customer_id"],
                              {"k1": "retired", "k2": SECRET}, "k2")


@query
def ingest_changes(spark, sf_dir):
    """Bronze CDC job on one batch: fill, newest per key, pseudonymise,
    padded date parts (delete rows kept as rows, like the source job)."""
    return changes.prepare_changes(Fixtures.of(spark, sf_dir).cdc, FX_CDC,
                                   PSEUDONYMISED_CDC, SECRET)


@query
def apply_changes(spark, sf_dir):
    """Initial full load (null op) as the snapshot, then the U/D changes
    merged onto it with deletes applied."""
    cdc = Fixtures.of(spark, sf_dir).cdc
    base = changes.prepare_changes(cdc.where(F.col("op").isNull()), FX_CDC,
                                   PSEUDONYMISED_CDC, SECRET)
    return changes.apply_changes(base, cdc.where(F.col("op").isNotNull()), FX_CDC,
                                 deletes="apply", pseudonymise_columns=PSEUDONYMISED_CDC,
                                 secret=SECRET)


@query
def apply_changes_out_of_order(spark, sf_dir):
    """Three batches of the versioned feed, the newest changes first, merged
    one after another into a bronze state that keeps its sequence."""
    feed = Fixtures.of(spark, sf_dir).view("fx_cdc_versions")

    def batch(n):
        return changes.prepare_changes(feed.where(F.col("batch") == n).drop("batch"), FX_CDC, drop_sequence=False)

    state = changes.merge_newest(changes.merge_newest(batch(1), batch(2), FX_CDC), batch(3), FX_CDC)
    return changes.live_rows(state, FX_CDC)


@query
def upsert_by_key(spark, sf_dir):
    """A client snapshot upserted with an increment: shared keys change, each
    side has keys of its own, null keys never match."""
    fx = Fixtures.of(spark, sf_dir)
    return changes.upsert(fx.view("fx_upsert_target"), fx.view("fx_upsert_source"), "contract_id")


@query
def upsert_schema_evolution(spark, sf_dir):
    """Previous client snapshot (three columns) upserted with the clients of
    the history window, which bring new columns."""
    fx = Fixtures.of(spark, sf_dir)
    recent = promote.history_since(_clients(fx), C.CREATED_AT, CLIENT_HISTORY_START)
    return changes.upsert(_prev_clients(fx), recent, C.CLIENT_KEY)


@query
def delete_by_key(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return changes.delete_by_key(_unmapped_v1(fx), _ledger(fx), C.UNMAPPED_KEY)


# --- conform ----------------------------------------------------------------

@query
def date_parts(spark, sf_dir):
    return with_date_parts(Fixtures.of(spark, sf_dir).operations, "insert_date")


@query
def stamp_load_date(spark, sf_dir):
    return with_load_date(Fixtures.of(spark, sf_dir).companies, AS_OF)


@query
def conform_clients_q(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return conform_clients(active_companies(fx.companies, FX_CLIENTS), FX_CLIENTS, F.col("country"))


@query
def active_clients(spark, sf_dir):
    return _clients(Fixtures.of(spark, sf_dir))


@query
def union_regions_q(spark, sf_dir):
    """Clients from one frame per region, each conformed with its literal
    region code and unioned by name."""
    fx = Fixtures.of(spark, sf_dir)
    frames = {r: fx.companies.where(F.col("country") == r) for r in C.REGIONS}
    return union_regions(frames, lambda df, r: conform_clients(
        active_companies(df, FX_CLIENTS), FX_CLIENTS, r))


@query
def conform_operations(spark, sf_dir):
    return conform_transactions(Fixtures.of(spark, sf_dir).operations, FX_OPERATIONS, F.col("country"))


@query
def conform_concepts(spark, sf_dir):
    return conform_transactions(Fixtures.of(spark, sf_dir).concepts, FX_CONCEPTS, F.col("country"))


@query
def sign_split(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    ops = conform_transactions(fx.operations, FX_OPERATIONS, F.col("country"))
    ecs = conform_transactions(fx.concepts, FX_CONCEPTS, F.col("country"))
    return L.sign_split(ops.unionByName(ecs))


@query
def all_transactions(spark, sf_dir):
    return _tx(Fixtures.of(spark, sf_dir))


# --- ledger -----------------------------------------------------------------

@query
def latest_snapshot(spark, sf_dir):
    """Newest sheet rows per (code, class) over the whole load history."""
    return L.latest_snapshot(Fixtures.of(spark, sf_dir).sheet_history, FX_MAP)


@query
def latest_snapshot_concat(spark, sf_dir):
    """The same under the legacy concatenated date key (collisions kept)."""
    return L.latest_snapshot(Fixtures.of(spark, sf_dir).sheet_history, FX_MAP, order="concat")


@query
def mirror_entries(spark, sf_dir):
    return L.mirror(_tx(Fixtures.of(spark, sf_dir)))


@query
def map_concepts(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return L.map_concepts(L.mirror(_tx(fx)), _map(fx), FX_MAP)


@query
def post_normal(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return L.post(L.map_concepts(L.mirror(_tx(fx)), _map(fx), FX_MAP), C.NORMAL)


@query
def post_correcting(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return L.post(L.map_concepts(L.mirror(_tx(fx)), _map(fx), FX_MAP), C.CORRECTING)


@query
def absolute_amounts(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    joined = L.map_concepts(L.mirror(_tx(fx)), _map(fx), FX_MAP)
    return L.absolute(L.post(joined, C.NORMAL).unionByName(L.post(joined, C.CORRECTING)))


@query
def drop_na_accounts(spark, sf_dir):
    """The ledger through the step-by-step shape (ends with the marker filter)."""
    fx = Fixtures.of(spark, sf_dir)
    return L.post_ledger_stepwise(_tx(fx), _map(fx), FX_MAP)


@query
def post_ledger(spark, sf_dir):
    """Flagship: the silver ledger in one pass."""
    return _ledger(Fixtures.of(spark, sf_dir))


@query
def post_ledger_split(spark, sf_dir):
    """The ledger with a mapping sheet taken as too large to broadcast: rows of
    hot codes are dealt over all partitions of a shuffled join."""
    fx = Fixtures.of(spark, sf_dir)
    return L.post_ledger(_tx(fx), _map(fx), FX_MAP, broadcast=False)


@query
def unmapped_entries_split(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return L.unmapped(_tx(fx), _map(fx), FX_MAP, broadcast=False)


@query
def post_ledger_concat_key(spark, sf_dir):
    """The ledger under the legacy concatenated snapshot key."""
    return _ledger(Fixtures.of(spark, sf_dir), order="concat")


@query
def classify_posting(spark, sf_dir):
    return L.classify(_tx(Fixtures.of(spark, sf_dir)))


@query
def unmapped_entries(spark, sf_dir):
    return _unmapped(Fixtures.of(spark, sf_dir))


@query
def unmapped_correcting(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return L.unmapped_class(_tx(fx), _map(fx), C.CORRECTING, FX_MAP)


@query
def restamp_yesterday(spark, sf_dir):
    led = _ledger(Fixtures.of(spark, sf_dir))
    return led.withColumn(C.INSERT_DATE, yesterday(AS_OF).cast("timestamp_ntz"))


@query
def reprocess_candidates(spark, sf_dir):
    """Ledger rows (new mapping) that sat in the unmapped table (old mapping),
    after the cut-off, restamped to yesterday."""
    fx = Fixtures.of(spark, sf_dir)
    return L.reprocess_candidates(_ledger(fx), _unmapped_v1(fx), AS_OF)


@query
def reprocess_upsert(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    led = _ledger(fx)
    again = L.reprocess_candidates(led, _unmapped_v1(fx), AS_OF)
    return changes.upsert(led, again, C.LEDGER_KEY)


@query
def reprocess_delete(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    old = _unmapped_v1(fx)
    gone = L.matching_rows(old, _ledger(fx))
    return changes.delete_by_key(old, gone, C.UNMAPPED_KEY)


# --- gold -------------------------------------------------------------------

@query
def unmapped_invoices_q(spark, sf_dir):
    return unmapped_invoices(_unmapped(Fixtures.of(spark, sf_dir)), AS_OF)


@query
def report_by_country(spark, sf_dir):
    """Invoices of the listed countries; the input also holds the same
    invoices of an unlisted country and of none."""
    inv = unmapped_invoices(_unmapped(Fixtures.of(spark, sf_dir)), AS_OF)
    inv = inv.unionByName(inv.withColumn(C.COUNTRY, F.lit("PE"))).unionByName(
        inv.withColumn(C.COUNTRY, F.lit(None).cast("string")))
    return of_countries(inv)


@query
def high_water_mark(spark, sf_dir):
    return promote.high_water_mark(_gold_ledger(Fixtures.of(spark, sf_dir)), C.INSERT_DATE)


@query
def incremental_since(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return promote.newer_than(_ledger(fx), _gold_ledger(fx), C.INSERT_DATE)


@query
def since_yesterday(spark, sf_dir):
    return promote.since(_ledger(Fixtures.of(spark, sf_dir)), C.INSERT_DATE, AS_OF)


@query
def incoming_transactions(spark, sf_dir):
    """Gold job: promote new ledger rows, then report yesterday's."""
    fx = Fixtures.of(spark, sf_dir)
    gold = _gold_ledger(fx)
    gold = changes.upsert(gold, promote.newer_than(_ledger(fx), gold, C.INSERT_DATE), C.LEDGER_KEY)
    return promote.since(gold, C.INSERT_DATE, AS_OF)


@query
def incoming_clients(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    gold = _gold_clients(fx)
    gold = changes.upsert(gold, promote.newer_than(_clients(fx), gold, C.CREATED_AT), C.CLIENT_KEY)
    return promote.since(gold, C.CREATED_AT, CLIENTS_AS_OF)


@query
def changed_clients(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return promote.changed_rows(_clients(fx), _prev_clients(fx), C.CLIENT_ID).drop(*C.DATE_PARTS)


@query
def history_clients(spark, sf_dir):
    return promote.history_since(_clients(Fixtures.of(spark, sf_dir)), C.CREATED_AT,
                                 CLIENT_HISTORY_START)


@query
def history_since_q(spark, sf_dir):
    """Sign-split transactions inserted since the history start."""
    return promote.history_since(_tx(Fixtures.of(spark, sf_dir)), C.INSERT_DATE)


@query
def history_transactions(spark, sf_dir):
    return promote.history_since(_ledger(Fixtures.of(spark, sf_dir)), C.INSERT_DATE)


@query
def newer_than_text(spark, sf_dir):
    """Rows newer than the newest of the urgent ones; timestamps are text, and
    text that is none is never newer."""
    rows = Fixtures.of(spark, sf_dir).view("fx_text_operations")
    urgent = rows.where("code = '1-URGENT' and amount < 0 and inserted < '1998-01-01'")
    return promote.newer_than(rows, urgent, "inserted").withColumn("inserted", F.col("inserted").cast("timestamp_ntz"))


@query
def history_since_text(spark, sf_dir):
    rows = Fixtures.of(spark, sf_dir).view("fx_text_operations")
    return promote.history_since(rows, "inserted", CLIENT_HISTORY_START).withColumn(
        "inserted", F.col("inserted").cast("timestamp_ntz"))


# --- tables -----------------------------------------------------------------
# These write tables in the shared folder and read them back.

def _folder(spark, name: str) -> str:
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


_DATED = partitioned.dated(C.INSERT_DATE, "month")


def _restamped_table(spark, fx: Fixtures, ledger: Optional[DataFrame] = None) -> str:
    """The ledger (a materialised frame of it, if given, is discarded) as a
    table in monthly folders, then its reprocessed entries merged into the
    folders that hold them (and that they move to)."""
    path = _folder(spark, "ledger")
    ledger = materialise(_ledger(fx)) if ledger is None else ledger
    partitioned.upsert_partitions(spark, path, ledger, C.LEDGER_KEY, _DATED)
    again = materialise(L.reprocess_candidates(ledger, _unmapped_v1(fx), AS_OF))
    partitioned.upsert_partitions(spark, path, again, C.LEDGER_KEY, _DATED)
    for frame in (ledger, again):
        discard(frame)
    return path


@query
def upsert_touched_partitions(spark, sf_dir):
    """Reprocessed entries merged into a stored ledger; only folders with rows
    of their keys are rewritten, and the source keys are checked."""
    return read_table(spark, _restamped_table(spark, Fixtures.of(spark, sf_dir)))


@query
def delete_touched_partitions(spark, sf_dir):
    """Unmapped rows that the ledger now holds, deleted from a stored table;
    the doomed keys' range and Bloom filter skip rows in the scan."""
    fx = Fixtures.of(spark, sf_dir)
    path, old = _folder(spark, "unmapped"), materialise(_unmapped_v1(fx))
    partitioned.upsert_partitions(spark, path, old, C.UNMAPPED_KEY, _DATED)
    gone = materialise(L.matching_rows(old, _ledger(fx)))
    partitioned.delete_from_partitions(spark, path, gone, C.UNMAPPED_KEY, _DATED)
    for frame in (old, gone):
        discard(frame)
    return read_table(spark, path)


@query
def merge_key_buckets(spark, sf_dir):
    """The versioned feed merged batch by batch, the newest changes first, into
    a bronze table in key buckets."""
    feed, path = Fixtures.of(spark, sf_dir).view("fx_cdc_versions"), _folder(spark, "bronze")
    for n in (1, 2, 3):
        merge_batch(spark, feed.where(F.col("batch") == n).drop("batch"), path, FX_CDC, buckets=16, epoch=("feed", n))
    merge_batch(spark, feed.where("batch = 2").drop("batch"), path, FX_CDC, buckets=16, epoch=("feed", 2))     # replayed: skipped
    return read_bronze(spark, path, FX_CDC)


@query
def since_yesterday_pruned(spark, sf_dir):
    """Yesterday's rows of a stored ledger, restamped ones among them; folders
    of earlier months are not read."""
    table = partitioned.read_with_layout(spark, _restamped_table(spark, Fixtures.of(spark, sf_dir)))
    return promote.since(table, C.INSERT_DATE, AS_OF)


@query
def incremental_since_pruned(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    table = partitioned.read_with_layout(spark, _restamped_table(spark, fx))
    return promote.newer_than(table, _gold_ledger(fx), C.INSERT_DATE)


@query
def incremental_since_newest_folder(spark, sf_dir):
    """Stored silver rows newer than a stored gold ledger, of which only the
    newest folder is read for the mark."""
    fx, gold = Fixtures.of(spark, sf_dir), _folder(spark, "gold")
    ledger = materialise(_ledger(fx))
    partitioned.upsert_partitions(spark, gold, _gold_ledger(fx, ledger), C.LEDGER_KEY, _DATED)
    table = partitioned.read_with_layout(spark, _restamped_table(spark, fx, ledger))
    return promote.newer_than(table, partitioned.read_newest(spark, gold), C.INSERT_DATE)


@query
def history_transactions_pruned(spark, sf_dir):
    table = partitioned.read_with_layout(spark, _restamped_table(spark, Fixtures.of(spark, sf_dir)))
    return promote.history_since(table, C.INSERT_DATE)


@query
def incremental_ledger(spark, sf_dir):
    """The ledger job twice: transactions inserted before the cut under the old
    mapping, then all under the new one.  The second run posts only rows
    inserted since and rows of codes whose mapping changed."""
    fx, base = Fixtures.of(spark, sf_dir), _folder(spark, "jobs")
    tables = jobs.Tables(f"{base}/silver", f"{base}/gold", f"{base}/reports", unit="month")
    specs = {"operations_spec": FX_OPERATIONS, "concepts_spec": FX_CONCEPTS, "map_spec": FX_MAP, "region": F.col("country")}
    early = [df.where(F.col("insert_date") < F.lit(GOLD_TX_BEFORE).cast("timestamp_ntz")) for df in (fx.operations, fx.concepts)]
    jobs.build_ledger(spark, *early, fx.concept_map_v1, tables, AS_OF, **specs)
    jobs.build_ledger(spark, fx.operations, fx.concepts, fx.concept_map, tables, AS_OF, **specs)
    return read_table(spark, tables.silver_table(jobs.TRANSACTIONS))


@query
def quarantine_landing(spark, sf_dir):
    """Landing lines made of the parts table, some with a field too many, some
    with one too few, some with a size that is no number: good rows and, as
    they stand, bad lines."""
    path, size = _folder(spark, "landing"), F.col("p_size").cast("string")
    fields = [F.col("p_partkey").cast("string"), F.col("p_brand"), size]
    kind = F.col("p_size") % 10
    line = (F.when(kind == 1, F.concat_ws(",", *fields, F.lit("more"))).when(kind == 2, F.concat_ws(",", *fields[:2]))
            .when(kind == 3, F.concat_ws(",", *fields[:2], F.concat(F.lit("n"), size))).otherwise(F.concat_ws(",", *fields)))
    spark.read.parquet(f"{sf_dir}/part.parquet").select(line.alias("value")).write.text(path)
    schema = spark.createDataFrame([], "partkey long, brand string, size int").schema
    good, bad = read_landing_split(spark, path, schema, header=False)
    return good.unionByName(bad.select(F.col(BAD_LINE).alias("bad_line")), allowMissingColumns=True)
