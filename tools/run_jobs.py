"""Run every job end to end over the driver's test tables into a fresh scratch
folder and print what each table and report holds.

    python tools/run_jobs.py [sf_dir] [as_of]

The ERP-shaped inputs come from ``ledgerflow.sources.fixtures``; the bronze
step streams the fixture change feed (initial load, then changes) through the
availableNow ingestion.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerflow.plans import jobs  # noqa: E402
from ledgerflow.session import local_session  # noqa: E402
from ledgerflow.sources.fixtures import (FX_CDC, FX_CLIENTS, FX_CONCEPTS, FX_MAP,  # noqa: E402
                                         FX_OPERATIONS, Fixtures)
from ledgerflow.sources.tables import committed_versions, read_table  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    as_of = sys.argv[2] if len(sys.argv) > 2 else "2024-01-31"
    spark = local_session()
    fx = Fixtures.of(spark, sf_dir)
    root = tempfile.mkdtemp(prefix="ledgerflow-jobs-")
    tables = jobs.Tables(silver=f"{root}/silver", gold=f"{root}/gold", reports=f"{root}/reports")
    common = dict(operations_spec=FX_OPERATIONS, concepts_spec=FX_CONCEPTS, map_spec=FX_MAP,
                  region=F.col("country"))

    def step(name, fn):
        t0 = time.perf_counter()
        out = fn()
        print(f"{name:34s} {time.perf_counter() - t0:6.1f}s  {out}")

    # bronze: the change feed as two files, picked up incrementally
    feed = f"{root}/landing/cdc"
    fx.cdc.where(F.col("op").isNull()).write.parquet(f"{feed}/load")
    time.sleep(1.1)
    fx.cdc.where(F.col("op").isNotNull()).write.parquet(f"{feed}/changes")
    step("bronze: ingest changes", lambda: jobs.ingest_changes(
        spark, f"{feed}/*/*.parquet", fx.cdc.schema, f"{root}/bronze/cdc", FX_CDC,
        secret="demo-secret", pseudonymise_columns=["l_quantity"], max_files_per_trigger=1) and
        committed_versions(spark, f"{root}/bronze/cdc"))

    step("silver: active clients", lambda: jobs.build_active_clients(
        spark, fx.companies, tables, FX_CLIENTS, F.col("country")))
    step("silver: unmapped (old mapping)", lambda: jobs.build_unmapped(
        spark, fx.operations, fx.concepts, fx.concept_map_v1, tables, **common))
    step("silver: ledger + reprocess", lambda: jobs.build_ledger(
        spark, fx.operations, fx.concepts, fx.concept_map, tables, as_of, **common))
    step("gold: incoming transactions", lambda: jobs.incoming_transactions(spark, tables, as_of))
    step("gold: incoming clients", lambda: jobs.incoming_clients(spark, tables, as_of))
    step("gold: updated clients", lambda: jobs.updated_clients(spark, tables))
    step("gold: invoices not mapped", lambda: jobs.invoices_not_mapped(spark, tables, as_of))
    step("gold: history (transactions)", lambda: jobs.historical_transactions(spark, tables))

    print()
    for layer, path in [("bronze", f"{root}/bronze/cdc"),
                        ("silver", tables.silver_table(jobs.ACTIVE_CLIENTS)),
                        ("silver", tables.silver_table(jobs.TRANSACTIONS)),
                        ("silver", tables.silver_table(jobs.UNMAPPED)),
                        ("gold", tables.gold_table(jobs.TRANSACTIONS)),
                        ("gold", tables.gold_table(jobs.INVOICES_NOT_MAPPED))]:
        print(f"{layer:7s} {os.path.basename(path):30s} {read_table(spark, path).count():8d} rows"
              f"  (versions {committed_versions(spark, path)})")
    print("reports:", sorted(os.listdir(tables.reports)))
    print("scratch folder:", root)


if __name__ == "__main__":
    main()
