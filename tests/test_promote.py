import datetime as dt

from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.operators import promote

D = dt.datetime


def test_newer_than_strict_mark(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3)), (4, None)],
                                "id int, ts timestamp")
    gold = spark.createDataFrame([(9, D(2024, 1, 2))], "id int, ts timestamp")
    assert sorted(r.id for r in promote.newer_than(src, gold, "ts").collect()) == [3]
    assert sorted(r.id for r in promote.newer_than(src, gold, "ts", inclusive=True).collect()) == [2, 3]


def test_newer_than_empty_and_all_null_targets(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1)), (2, None)], "id int, ts timestamp")
    empty = spark.createDataFrame([], "id int, ts timestamp")
    assert promote.newer_than(src, empty, "ts").count() == 2
    nulls = spark.createDataFrame([(5, None)], "id int, ts timestamp")
    assert promote.newer_than(src, nulls, "ts").count() == 0


def test_newer_than_parses_text(spark):
    src = spark.createDataFrame([(1, "2024-01-03 00:00:00.000"), (2, "garbage")], "id int, ts string")
    gold = spark.createDataFrame([(9, "2024-01-02 10:00:00.000")], "id int, ts string")
    out = promote.newer_than(src, gold, "ts").collect()
    assert [r.id for r in out] == [1]
    assert isinstance(out[0].ts, dt.datetime)


def test_high_water_mark_is_one_row(spark):
    gold = spark.createDataFrame([(D(2024, 1, 2),), (D(2024, 1, 5),), (None,)], "ts timestamp")
    r = promote.high_water_mark(gold, "ts").collect()
    assert len(r) == 1 and r[0].mark == D(2024, 1, 5) and r[0].n == 3


def test_since_yesterday_inclusive_and_drops_parts(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 29, 23)), (2, D(2024, 1, 30)), (3, D(2024, 1, 31, 5))],
                               "id int, ts timestamp").withColumn("year", F.lit("2024"))
    out = promote.since(df, "ts", as_of="2024-01-31")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert "year" not in out.columns


def test_history_since_bad_text_is_null_not_error(spark):
    df = spark.createDataFrame([("2023-01-01 00:00:00.000",), ("2022-12-31 23:59:59.999",), ("05/01/2023",)],
                               "created_at string")
    out = promote.history_since(df, "created_at")
    assert [r.created_at for r in out.collect()] == [D(2023, 1, 1)]


def test_changed_rows_null_semantics(spark):
    cur = spark.createDataFrame([("k1", "A", "T1"), ("k2", "B", "T2"), ("k3", None, "T3"), ("k4", "D", "T4x"),
                                 ("k5", "E", "T5")],
                                "client_id string, company_name string, tax_id string")
    prev = spark.createDataFrame([("k1", "A", "T1"), ("k2", "B old", "T2"), ("k3", "C", "T3"), ("k4", None, "T4")],
                                 "client_id string, company_name string, tax_id string")
    assert sorted(r.client_id for r in promote.changed_rows(cur, prev, C.CLIENT_ID).collect()) == ["k2", "k4"]
    assert sorted(r.client_id for r in promote.changed_rows(cur, prev, C.CLIENT_ID, null_safe=True)
                  .collect()) == ["k2", "k3", "k4"]


def test_changed_rows_emit_each_current_row_once(spark):
    cur = spark.createDataFrame([("k1", "A", "T1")], "client_id string, company_name string, tax_id string")
    prev = spark.createDataFrame([("k1", "X", "T1")] * 5, "client_id string, company_name string, tax_id string")
    out = promote.changed_rows(cur, prev, C.CLIENT_ID)
    assert out.count() == 1 and out.columns == cur.columns
