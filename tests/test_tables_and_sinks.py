import os

import pytest
from pyspark.sql import functions as F

from ledgerflow.sinks.reports import write_full_load, write_report, write_report_by_country
from ledgerflow.sources import tables as TB


def test_snapshot_versions_and_upsert(spark, scratch):
    path = os.path.join(scratch, "t")
    with pytest.raises(TB.TableNotFound):
        TB.read_table(spark, path)
    src = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    TB.upsert_table(spark, path, src, ["id"])
    TB.upsert_table(spark, path, spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), "id")
    assert TB.committed_versions(spark, path) == [1, 2]
    assert sorted(tuple(r) for r in TB.read_table(spark, path).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    TB.delete_from_table(spark, path, spark.createDataFrame([(1,)], "id int"), ["id"])
    assert sorted(r.id for r in TB.read_table(spark, path).collect()) == [2, 3]


def test_uncommitted_version_is_invisible_and_replaced(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.createDataFrame([(1,)], "id int")
    TB.write_snapshot(df, path)
    os.makedirs(os.path.join(path, "v00000002"))  # a crashed writer's leftovers
    assert TB.committed_versions(spark, path) == [1]
    written = TB.write_snapshot(df, path)
    assert written.endswith("v00000002")
    assert TB.committed_versions(spark, path) == [1, 2]


def test_read_or_empty_and_read_if_exists(spark, scratch):
    schema = "id int, v string"
    assert TB.read_or_empty(spark, os.path.join(scratch, "none"),
                            spark.createDataFrame([], schema).schema).count() == 0
    assert TB.read_if_exists(spark, os.path.join(scratch, "none")) is None


def test_reports(spark, scratch):
    empty = spark.createDataFrame([], "country string, v int")
    assert write_report(empty, os.path.join(scratch, "r0")) is False
    assert not os.path.exists(os.path.join(scratch, "r0"))
    df = spark.createDataFrame([("MX", 1), ("BR", 2), ("US", 3)], "country string, v int")
    assert write_report(df, os.path.join(scratch, "r1")) is True
    back = spark.read.option("header", True).csv(os.path.join(scratch, "r1"))
    assert back.count() == 3
    write_report_by_country(df, os.path.join(scratch, "r2"))
    assert sorted(d for d in os.listdir(os.path.join(scratch, "r2")) if d.startswith("report_country=")) == [
        "report_country=BR", "report_country=MX"]


def test_full_load_is_partitioned_by_load_date(spark, scratch):
    from ledgerflow.functions.dates import with_load_date
    df = with_load_date(spark.createDataFrame([(1,)], "id int"), "2024-03-05")
    write_full_load(df, os.path.join(scratch, "fl"))
    assert os.path.isdir(os.path.join(scratch, "fl", "year=2024", "month=3", "day=5"))


def test_landing_csv(spark, scratch):
    p = os.path.join(scratch, "landing.csv")
    with open(p, "w") as f:
        f.write("economic_concept,normal/correctora,registertype\nA,Normal,OP\nB,,EC\n")
    df = TB.read_landing_csv(spark, p)
    assert df.columns == ["economic_concept", "normal/correctora", "registertype"]
    assert df.where(F.col("`normal/correctora`").isNull()).count() == 1


def test_read_region_tables_feeds_the_silver_union(spark, scratch):
    import datetime as dt

    from ledgerflow import config as C
    from ledgerflow.plans import silver
    t = dt.datetime(2024, 1, 2)
    cols = ("insert_date timestamp, uuid string, invoice_date timestamp, accounting_operation_date timestamp, "
            "invoice_type string, invoice_type_description string, contract_id long, invoice_amount double")
    ecs = ("insert_date timestamp, uuid string, interests_calculation_last_date timestamp, file_date timestamp, "
           "economic_concept_code string, economic_concept_code_description string, contract_id long, "
           "economic_concept_gross_amount double")
    for i, region in enumerate(("mx", "br", "co")):
        spark.createDataFrame([(t, f"{region}1", t, t, "X", "x", i, 10.0 - 20 * i)], cols) \
            .write.parquet(os.path.join(scratch, "ops", region))
        spark.createDataFrame([(t, f"{region}2", t, t, "Y", "y", i, 1.0)], ecs) \
            .write.parquet(os.path.join(scratch, "ecs", region))
    ops = TB.read_region_tables(spark, os.path.join(scratch, "ops", "{region}"))
    ecs_frames = TB.read_region_tables(spark, os.path.join(scratch, "ecs", "{region}"))
    tx = silver.transactions(ops, ecs_frames)
    got = {(r.uuid, r.id_client, r.amount_d, r.amount_c) for r in tx.collect()}
    assert ("op-mx1", "MX-0", 10.0, None) in got and ("op-br1", "BR-1", None, -10.0) in got
    assert ("ec-co2", "CO-2", 1.0, None) in got and len(got) == 6
    assert tx.columns == list(C.SPLIT_COLUMNS) + list(C.DATE_PARTS)


def test_read_if_exists_only_swallows_missing_paths(spark, scratch):
    bad = os.path.join(scratch, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception) as info:
        df = TB.read_if_exists(spark, bad)
        df.collect()  # schema inference or the scan must fail, not return "no data"
    assert info.value is not None
    good = os.path.join(scratch, "good")
    spark.createDataFrame([(1,)], "id int").write.parquet(good)
    assert TB.read_if_exists(spark, good).count() == 1
