"""One test per behaviour decision of SURVEY §2.10 not covered elsewhere."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.operators import ledger as L, promote
from ledgerflow.plans import catalog as Q
from ledgerflow.sources.fixtures import FX_MAP
from tests.conftest import SF_SMALL

MAP_SCHEMA = ("code string, posting_class string, register_type string, map_descr string, "
              "debit_account string, credit_account string, y string, m string, d string")


def test_q2_snapshot_partition_ignores_register_type(spark):
    # the older OP row of a code is lost when its EC row is newer
    m = spark.createDataFrame([("X", "Normal", "OP", "op", "D1", "C1", "2023", "1", "1"),
                               ("X", "Normal", "EC", "ec", "D2", "C2", "2023", "6", "1")], MAP_SCHEMA)
    assert [r.register_type for r in L.latest_snapshot(m, FX_MAP).collect()] == ["EC"]
    both = L.latest_snapshot(m, FX_MAP, keys=("code", "posting_class", "register_type"))
    assert both.count() == 2


def test_q5_restamped_rows_keep_old_parts_unless_asked(spark):
    t = dt.datetime(2023, 6, 1)
    ledger = spark.createDataFrame([(t, "u1", t, "A", "2023", "6", "1")],
                                   "insert_date timestamp, uuid string, date timestamp, invoice string, "
                                   "year string, month string, day string")
    unm = spark.createDataFrame([("u1", "A")], "uuid string, invoice string")
    kept = L.reprocess_candidates(ledger, unm, as_of="2024-01-31").first()
    assert (kept.year, kept.month, kept.day) == ("2023", "6", "1")
    moved = L.reprocess_candidates(ledger, unm, as_of="2024-01-31", restamp_parts=True).first()
    assert (moved.year, moved.month, moved.day) == ("2024", "1", "30")


def test_q6_restamped_rows_sit_at_midnight_and_later_marks_skip_them(spark):
    t = dt.datetime(2023, 6, 1)
    ledger = spark.createDataFrame([(t, "u1", t, "A")],
                                   "insert_date timestamp, uuid string, date timestamp, invoice string")
    unm = spark.createDataFrame([("u1", "A")], "uuid string, invoice string")
    again = L.reprocess_candidates(ledger, unm, as_of="2024-01-31")
    assert again.first().insert_date == dt.datetime(2024, 1, 30, 0, 0)
    gold = spark.createDataFrame([(dt.datetime(2024, 1, 30, 8, 0),)], "insert_date timestamp")
    assert promote.newer_than(again, gold, "insert_date").count() == 0
    assert promote.newer_than(again, spark.createDataFrame([(dt.datetime(2024, 1, 30),)],
                                                           "insert_date timestamp"),
                              "insert_date", inclusive=True).count() == 1


def test_q10_unmapped_output_has_no_accounting_date(spark):
    df = Q.unmapped_entries(spark, SF_SMALL)
    assert C.ACCOUNTING_DATE not in df.columns
    assert tuple(df.columns) == C.UNMAPPED_COLUMNS


def test_q11_keyless_feed_is_rejected(spark, scratch):
    from ledgerflow.streaming.ingest import ingest_available_now
    schema = spark.createDataFrame([], "id int").schema
    with pytest.raises(ValueError):
        ingest_available_now(spark, os.path.join(scratch, "src"), schema, os.path.join(scratch, "t"),
                             C.ChangeFeedSpec(keys=()))


def test_q14_report_columns(spark):
    assert not set(C.DATE_PARTS) & set(Q.changed_clients(spark, SF_SMALL).columns)
    assert set(C.DATE_PARTS) <= set(Q.QUERIES["unmapped_invoices"](spark, SF_SMALL).columns)
    assert set(C.DATE_PARTS) <= set(Q.history_clients(spark, SF_SMALL).columns)


def test_q16_cutoff_compares_dates_not_text(spark):
    ledger = spark.createDataFrame([("05/01/2023", "u1", "A"), ("2023-05-01", "u2", "A")],
                                   "date string, uuid string, invoice string")
    unm = spark.createDataFrame([("u1", "A"), ("u2", "A")], "uuid string, invoice string")
    # text that is not a date is not after the cut-off; a real date is
    assert [r.uuid for r in L.matching_rows(ledger, unm).collect()] == ["u2"]


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as E
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and tuple(a.columns) == C.LEDGER_COLUMNS


def test_cutoff_on_timestamps_is_midnight(spark):
    ledger = spark.createDataFrame([(dt.datetime(2023, 1, 1, 10, 0), "u1", "A"),
                                    (dt.datetime(2023, 1, 1, 0, 0), "u2", "A")],
                                   "date timestamp, uuid string, invoice string")
    unm = spark.createDataFrame([("u1", "A"), ("u2", "A")], "uuid string, invoice string")
    assert [r.uuid for r in L.matching_rows(ledger, unm).collect()] == ["u1"]


def test_size_shuffle_partitions(spark):
    from ledgerflow.session import size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle_partitions(spark, 100 * 2**40) == 409600  # 100 TB / 256 MB
        assert size_shuffle_partitions(spark, 1) == 409600  # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
