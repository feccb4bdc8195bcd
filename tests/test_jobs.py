"""The jobs end to end over the sf0.001 fixtures, in a scratch folder."""

import os

from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.plans import jobs
from ledgerflow.sources.fixtures import (FX_CLIENTS, FX_CONCEPTS, FX_MAP, FX_OPERATIONS,
                                         Fixtures)
from ledgerflow.sources.tables import read_table
from tests.conftest import SF_SMALL

AS_OF = "2024-01-31"


def test_silver_and_gold_jobs(spark, scratch):
    fx = Fixtures(spark, SF_SMALL)
    tables = jobs.Tables(silver=os.path.join(scratch, "silver"), gold=os.path.join(scratch, "gold"),
                         reports=os.path.join(scratch, "reports"), unit="month")
    region = F.col("country")
    common = dict(operations_spec=FX_OPERATIONS, concepts_spec=FX_CONCEPTS, map_spec=FX_MAP, region=region)

    # silver: clients, unmapped under the old mapping, then the ledger (which reprocesses)
    jobs.build_active_clients(spark, fx.companies, tables, FX_CLIENTS, region)
    assert read_table(spark, tables.silver_table(jobs.ACTIVE_CLIENTS)).count() == 114
    jobs.build_unmapped(spark, fx.operations, fx.concepts, fx.concept_map_v1, tables, **common)
    assert read_table(spark, tables.silver_table(jobs.UNMAPPED)).count() == 1668
    jobs.build_ledger(spark, fx.operations, fx.concepts, fx.concept_map, tables, AS_OF, **common)
    ledger = read_table(spark, tables.silver_table(jobs.TRANSACTIONS))
    assert ledger.count() == 1978
    restamped = ledger.where(F.col(C.INSERT_DATE) == F.lit("2024-01-30").cast("timestamp_ntz")).count()
    assert restamped == 420
    assert read_table(spark, tables.silver_table(jobs.UNMAPPED)).count() == 1668 - 210

    # gold: first promotion takes everything, the second nothing new
    assert jobs.incoming_transactions(spark, tables, AS_OF) is True
    assert read_table(spark, tables.gold_table(jobs.TRANSACTIONS)).count() == 1978
    report = spark.read.option("header", True).csv(tables.report("incoming_transactions"))
    assert report.count() > 0 and "year" not in report.columns
    jobs.incoming_transactions(spark, tables, AS_OF)
    assert read_table(spark, tables.gold_table(jobs.TRANSACTIONS)).count() == 1978

    assert jobs.updated_clients(spark, tables) is False  # gold empty: nothing changed
    jobs.incoming_clients(spark, tables, "1998-01-01")
    assert read_table(spark, tables.gold_table(jobs.ACTIVE_CLIENTS)).count() == 114

    # a new silver snapshot where three clients changed name: reported, then saved
    from ledgerflow.sources.tables import write_snapshot
    silver_clients = read_table(spark, tables.silver_table(jobs.ACTIVE_CLIENTS))
    renamed = sorted(r.client_id for r in silver_clients.select("client_id").limit(3).collect())
    write_snapshot(silver_clients.withColumn(
        "company_name", F.when(F.col("client_id").isin(*renamed), F.lit("renamed"))
        .otherwise(F.col("company_name"))), tables.silver_table(jobs.ACTIVE_CLIENTS))
    assert jobs.updated_clients(spark, tables) is True
    rep = spark.read.option("header", True).csv(tables.report("updated_clients"))
    assert sorted(r.client_id for r in rep.collect()) == renamed and "year" not in rep.columns
    gold_now = read_table(spark, tables.gold_table(jobs.ACTIVE_CLIENTS))
    assert gold_now.where(F.col("company_name") == "renamed").count() == 3 and gold_now.count() == 114

    jobs.invoices_not_mapped(spark, tables, AS_OF)
    inv = read_table(spark, tables.gold_table(jobs.INVOICES_NOT_MAPPED))
    assert inv.count() > 0
    folders = sorted(d for d in os.listdir(tables.report("invoices_not_mapped")) if d.startswith("report_country="))
    assert folders and set(folders) <= {"report_country=MX", "report_country=BR", "report_country=CO"}

    assert jobs.historical_transactions(spark, tables) is True
    assert jobs.historical_clients(spark, tables, "1996-01-01 00:00:00.000") is True


def test_sheet_load(spark, scratch):
    p = os.path.join(scratch, "sheet.csv")
    with open(p, "w") as f:
        f.write("economic_concept,normal/correctora,registertype\nA,Normal,OP\n")
    out = os.path.join(scratch, "sheet_table")
    assert jobs.load_sheet(spark, p, out, "2024-03-05") is True
    back = read_table(spark, out)
    row = back.first()  # partition discovery reads the parts back as numbers
    assert (str(row["year"]), str(row["month"]), str(row["day"])) == ("2024", "3", "5")


def test_batch_ingest_equals_registered_query(spark, scratch):
    from ledgerflow.plans import catalog as Q
    from ledgerflow.sources.fixtures import FX_CDC
    from ledgerflow.streaming.ingest import read_bronze
    target = os.path.join(scratch, "bronze")
    cdc = Fixtures.of(spark, SF_SMALL).cdc
    jobs.ingest_changes_batch(spark, cdc, target, FX_CDC, secret=Q.SECRET,
                              pseudonymise_columns=Q.PSEUDONYMISED_CDC)
    got = read_bronze(spark, target, FX_CDC, deletes="keep")
    want = Q.QUERIES["ingest_changes"](spark, SF_SMALL)
    assert got.count() == want.count() == 4599
    assert got.exceptAll(want.select(*got.columns)).count() == 0
