"""Keyed pseudonyms against a library MAC; malformed landing lines."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.privacy import keyed_pseudonym, pseudonym_of, pseudonymise_keyed
from ledgerflow.plans import jobs
from ledgerflow.sources import tables as TB

KEYS = {"k1": "first", "k2": "a key of more than sixty-four bytes " * 3, "k3": "é"}


def mac(version, text):
    return f"{version}:" + hmac.new(KEYS[version].encode(), text.encode(), hashlib.sha256).hexdigest()


def test_keyed_pseudonyms_equal_a_library_mac(spark):
    texts = ["", "a", "é日本", "x" * 500, None]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, n int")
    for version, key in KEYS.items():
        got = [r[0] for r in rows.orderBy("n").select(keyed_pseudonym(F.col("t"), key, version)).collect()]
        assert got == [mac(version, t or "") for t in texts]
    number = pseudonymise_keyed(rows.withColumn("n", F.when(F.col("n") > 0, F.col("n"))), ["n"], KEYS, "k1")
    assert {r.n for r in number.collect()} == {None, *[mac("k1", str(i)) for i in range(1, 5)]}


def test_vector_of_the_standard(spark):
    value = spark.range(1).select(keyed_pseudonym(F.lit("what do ya want for nothing?"), "Jefe", "v")).first()[0]
    assert value == "v:5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"


def test_rotated_keys_still_match(spark):
    rows = [(mac("k1", "ann"), "ann", True), (mac("k2", "ann"), "ann", True), (mac("k2", "ann"), "bob", False),
            ("k9:" + "0" * 64, "ann", False), (None, "ann", None), (mac("k3", ""), None, True)]
    df = spark.createDataFrame(rows, "stored string, clear string, want boolean")
    assert [r[0] for r in df.select(pseudonym_of(F.col("stored"), F.col("clear"), KEYS)).collect()] == [r[2] for r in rows]


def test_bad_parameters(spark):
    with pytest.raises(ValueError):
        keyed_pseudonym(F.lit("a"), "", "v")
    with pytest.raises(ValueError):
        keyed_pseudonym(F.lit("a"), "k", "v:1")
    with pytest.raises(ValueError):
        pseudonymise_keyed(spark.range(1), ["none"], KEYS, "k1")


def landing(scratch, text):
    with open(scratch + "/s.csv", "w") as f:
        f.write(text)
    return scratch + "/s.csv"


def test_malformed_lines_are_kept_apart(spark, scratch):
    path = landing(scratch, 'code,account,note\n01,100,a\n02,200\n03,300,c,extra\n"0,4",400,"d ""q"""\n,,\n')
    good, bad = TB.read_landing_split(spark, path)
    assert sorted((r.code or "", r.account or "", r.note or "") for r in good.collect()) == [("", "", ""), ("0,4", "400", 'd "q"'), ("01", "100", "a")]
    assert sorted((r.file, r[TB.BAD_LINE]) for r in bad.collect()) == [("s.csv", "02,200"), ("s.csv", "03,300,c,extra")]
    assert good.select("account").count() == 3 and bad.count() == 2      # also with columns pruned


def test_values_of_another_type_are_bad_lines(spark, scratch):
    path = landing(scratch, "code,account\n1,100\nx,200\n3,9e9\n")
    schema = spark.createDataFrame([], "code int, account int").schema
    good, bad = TB.read_landing_split(spark, path, schema)
    assert [tuple(r) for r in good.collect()] == [(1, 100)] and sorted(r[1] for r in bad.collect()) == ["3,9e9", "x,200"]
    with pytest.raises(ValueError):
        TB.read_landing_split(spark, path, header=False)


def test_sheet_load_with_quarantine(spark, scratch):
    sheet, table, bad = landing(scratch, "a,b\n1,2\n3\n4,5\n"), scratch + "/t", scratch + "/q"
    assert jobs.load_sheet(spark, sheet, table, "2024-01-05", quarantine=bad)
    assert sorted(r.a for r in TB.read_table(spark, table).collect()) == ["1", "4"]
    assert jobs.load_sheet(spark, sheet, table, "2024-01-06", quarantine=bad)
    kept = TB.read_table(spark, bad).collect()
    assert sorted((r[TB.BAD_LINE], r.day) for r in kept) == [("3", "5"), ("3", "6")]
