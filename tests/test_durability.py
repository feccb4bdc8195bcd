"""Checkpoints, bookmarks, versions and types outlive runs and batches."""

import datetime as dt
import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.operators import changes
from ledgerflow.plans import jobs
from ledgerflow.session import ensure_checkpoint_dir, shared_base
from ledgerflow.sinks.reports import write_report_by_country
from ledgerflow.sources import tables as TB
from ledgerflow.streaming.ingest import default_checkpoint, ingest_available_now, merge_batch, read_bronze

SCHEMA = "id int, seq int, Op string, ts timestamp, name string"
SPEC = C.ChangeFeedSpec(keys=("id",), sequence="seq", op="Op", timestamp="ts", tie_break=("Op", "name"))
T0 = dt.datetime(2024, 1, 2)


def test_checkpoint_path_stays(spark):
    first = (ensure_checkpoint_dir(spark), shared_base(spark))
    for _ in range(300):
        assert (ensure_checkpoint_dir(spark), shared_base(spark)) == first
    frames = [TB.materialise(spark.range(3)) for _ in range(3)]
    assert all(os.path.dirname(f._staged_path) == first[1] for f in frames)
    TB.discard(frames[0])
    assert not os.path.exists(frames[0]._staged_path) and frames[1].count() == 3


_RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from ledgerflow import config as C
from ledgerflow.streaming.ingest import ingest_available_now
from ledgerflow.sources.tables import committed_versions
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {base!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
spec = C.ChangeFeedSpec(keys=("id",), sequence="seq", op="Op", timestamp="ts")
schema = spark.createDataFrame([], {schema!r}).schema
ingest_available_now(spark, {src!r}, schema, {tgt!r}, spec)
print("VERSIONS", committed_versions(spark, {tgt!r}))
"""


def test_default_bookmark_survives_a_new_process(spark, scratch):
    src, tgt, base = (os.path.join(scratch, x) for x in ("src", "tgt", "base"))
    spark.createDataFrame([(1, 1, None, T0, "a")], SCHEMA).coalesce(1).write.parquet(src)
    code = _RUN.format(root=os.getcwd(), base=base, schema=SCHEMA, src=src, tgt=tgt)
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert "VERSIONS [1]" in out.stdout, out.stderr[-2000:]


def test_bookmarks_of_equal_base_names_differ(spark, monkeypatch):
    monkeypatch.setattr("ledgerflow.session.configured_base", lambda s: None)
    with pytest.raises(RuntimeError):
        default_checkpoint(spark, "/in/x", "/t/mx/operations")
    monkeypatch.setattr("ledgerflow.streaming.ingest.durable_base", lambda s: "/base")
    paths = {default_checkpoint(spark, "/in/x", "/t/mx/operations"), default_checkpoint(spark, "/in/x", "/t/br/operations"),
             default_checkpoint(spark, "/in/y", "/t/mx/operations")}
    assert len(paths) == 3 and default_checkpoint(spark, "/in/x/", "/t/mx/operations") in paths


def test_batch_size_and_file_order_do_not_change_the_table(spark, scratch):
    rows = [(1, 9, "U", T0, "newest"), (1, 3, "U", T0, "older"), (2, 5, "D", T0, "gone"), (2, 4, "U", T0, "late"),
            (3, 1, None, T0, "c"), (None, 1, "U", T0, "null key"), (1, 9, "U", T0, "tie"), (4, 2, "D", T0, "x"), (4, 7, "U", T0, "back")]
    found = set()
    for order, limit in ((rows, None), (rows, 1), (rows[::-1], 1), (rows[3:] + rows[:3], 2)):
        where = os.path.join(scratch, f"{len(found)}-{limit}-{order[0][1]}")
        for i, row in enumerate(order):
            path = os.path.join(where, "src", f"f{i}")
            spark.createDataFrame([row], SCHEMA).coalesce(1).write.parquet(path)
            for f in glob.glob(path + "/*.parquet"):
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
        schema = spark.createDataFrame([], SCHEMA).schema
        ingest_available_now(spark, where + "/src/*", schema, where + "/tgt", SPEC, where + "/ckpt", max_files_per_trigger=limit)
        found.add(tuple(sorted((r.id, r.Op, r.name) if r.id else (0, r.Op, r.name) for r in read_bronze(spark, where + "/tgt", SPEC).collect())))
    assert found == {((0, "U", "null key"), (1, "U", "tie"), (3, "C", "c"), (4, "U", "back"))}


def test_merging_a_batch_twice_changes_nothing(spark, scratch):
    batch = spark.createDataFrame([(None, 1, "U", T0, "n"), (1, 2, "U", T0, "a"), (2, 2, "D", T0, "b")], SCHEMA)
    states = []
    for _ in range(2):
        merge_batch(spark, batch, scratch + "/t", SPEC)
        states.append(sorted(map(str, TB.read_table(spark, scratch + "/t").collect())))
    assert states[0] == states[1] and len(states[0]) == 3


def test_missing_source_is_no_data(spark, scratch):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert ingest_available_now(spark, scratch + "/none", schema, scratch + "/t", SPEC, scratch + "/c") is None
    assert jobs.load_sheet(spark, scratch + "/none.csv", scratch + "/s") is False


def test_second_writer_of_one_base_fails(spark, scratch):
    path = scratch + "/t"
    TB.write_snapshot(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    first, base = TB.read_version(spark, path)
    second, same = TB.read_version(spark, path)
    TB.write_snapshot(first.union(spark.createDataFrame([(2, "b")], "id int, v string")), path, base=base)
    with pytest.raises(TB.ConcurrentWrite):
        TB.write_snapshot(second.union(spark.createDataFrame([(3, "c")], "id int, v string")), path, base=same)
    assert sorted(r.id for r in TB.read_table(spark, path).collect()) == [1, 2]
    assert not [d for d in os.listdir(path) if d.startswith("_pending")]


def test_writer_that_commits_between_check_and_rename_is_not_lost(spark, scratch, monkeypatch):
    path = scratch + "/t"
    TB.write_snapshot(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    check, written = TB.latest_version, []

    def check_then_other_writer(*args):
        found = check(*args)
        monkeypatch.setattr(TB, "latest_version", check)
        try:
            TB.write_snapshot(spark.createDataFrame([(2, "b")], "id int, v string"), path, base=1)
            written.append(2)
        except TB.ConcurrentWrite:
            pass
        return found

    monkeypatch.setattr(TB, "latest_version", check_then_other_writer)
    try:
        TB.write_snapshot(spark.createDataFrame([(3, "c")], "id int, v string"), path, base=1)
        written.append(3)
    except TB.ConcurrentWrite:
        pass
    assert len(written) == 1 and [r.id for r in TB.read_table(spark, path).collect()] == written
    assert not [d for d in os.listdir(path) if d.startswith("_")]


def test_old_versions_are_retired(spark, scratch):
    for i in range(TB.KEEP_VERSIONS + 2):
        TB.write_snapshot(spark.range(1), scratch + "/t")
    assert TB.committed_versions(spark, scratch + "/t") == list(range(3, TB.KEEP_VERSIONS + 3))


def test_empty_increment_writes_nothing(spark, scratch):
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    TB.upsert_table(spark, scratch + "/t", rows, "id")
    TB.upsert_table(spark, scratch + "/t", rows.where("false"), "id")
    assert TB.committed_versions(spark, scratch + "/t") == [1]


def test_partition_parts_stay_padded_text(spark, scratch):
    batch = spark.createDataFrame([(1, 1, None, T0, "a")], SCHEMA)
    later = spark.createDataFrame([(2, 1, None, dt.datetime(2024, 3, 4), "b")], SCHEMA)
    for b in (batch, later):
        merge_batch(spark, b, scratch + "/t", SPEC, partition_by=C.DATE_PARTS)
    got = TB.read_table(spark, scratch + "/t")
    assert dict(got.dtypes)["month"] == "string"
    assert sorted((r.id, r.month, r.day) for r in got.collect()) == [(1, "01", "02"), (2, "03", "04")]


def test_sheet_codes_keep_leading_zeros(spark, scratch):
    with open(scratch + "/s.csv", "w") as f:
        f.write("account,concept\n0100,001\n")
    jobs.load_sheet(spark, scratch + "/s.csv", scratch + "/t", "2024-01-05")
    row = TB.read_table(spark, scratch + "/t").first()
    assert (row.account, row.concept) == ("0100", "001")


def test_country_reports_keep_the_column_and_earlier_reports(spark, scratch):
    rows = spark.createDataFrame([("i1", "MX"), ("i2", "BR"), ("i3", "PE"), ("i4", None)], "invoice string, country string")
    write_report_by_country(rows, scratch + "/r")
    write_report_by_country(rows.where("country = 'MX'").withColumn("invoice", F.lit("i9")), scratch + "/r")
    write_report_by_country(rows.where("false"), scratch + "/r")
    read = lambda c: [(r.invoice, r.country) for r in spark.read.option("header", True).csv(f"{scratch}/r/report_country={c}").collect()]
    assert read("MX") == [("i9", "MX")] and read("BR") == [("i2", "BR")]
    assert not os.path.exists(scratch + "/r/report_country=PE")


def test_unmapped_report_holds_current_invoices_only(spark, scratch):
    tables = jobs.Tables(scratch + "/silver", scratch + "/gold", scratch + "/reports")
    cols = "uuid string, invoice string, type string, id_client string, amount_d double, amount_c double"
    path = tables.silver_table(jobs.UNMAPPED)
    TB.write_snapshot(spark.createDataFrame([("u1", "a", "OP", "MX-1", 1.0, None), ("u2", "b", "OP", "MX-1", 1.0, None)], cols), path)
    jobs.invoices_not_mapped(spark, tables, "2024-01-31")
    TB.write_snapshot(spark.createDataFrame([("u2", "b", "OP", "MX-1", 1.0, None)], cols), path)
    jobs.invoices_not_mapped(spark, tables, "2024-01-31")
    got = spark.read.option("header", True).csv(tables.report("invoices_not_mapped") + "/report_country=MX")
    assert [r.invoice for r in got.collect()] == ["b"]
    assert TB.read_table(spark, tables.gold_table(jobs.INVOICES_NOT_MAPPED)).count() == 2


def test_merge_newest_needs_no_order(spark):
    rows = spark.createDataFrame([(1, 9, "U", T0, "n"), (2, 5, "D", T0, "g")], SCHEMA)
    older = spark.createDataFrame([(1, 3, "U", T0, "o"), (2, 4, "U", T0, "l")], SCHEMA)
    a = changes.merge_newest(rows, older, SPEC)
    b = changes.merge_newest(older, rows, SPEC)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert [r.id for r in changes.live_rows(a, SPEC).collect()] == [1]
