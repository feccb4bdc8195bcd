"""Property tests on small generated frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import changes, ledger as L

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keyed = st.lists(st.tuples(st.integers(0, 6), st.text("abc", max_size=2)), max_size=12)
unique_keyed = keyed.map(lambda rows: list({k: (k, v) for k, v in rows}.values()))
amounts = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), max_size=12)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string")


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(target=unique_keyed, source=unique_keyed)
def test_upsert_is_idempotent(spark, target, source):
    t, s = frame(spark, target), frame(spark, source)
    once = changes.upsert(t, s, ["id"])
    twice = changes.upsert(once, s, ["id"])
    assert as_set(once) == as_set(twice)
    assert {r.id for r in once.collect()} == {k for k, _ in target} | {k for k, _ in source}


@SETTINGS
@given(target=unique_keyed, source=unique_keyed)
def test_delete_after_upsert_removes_exactly_those_keys(spark, target, source):
    t, s = frame(spark, target), frame(spark, source)
    out = changes.delete_by_key(changes.upsert(t, s, ["id"]), s, ["id"])
    assert {r.id for r in out.collect()} == {k for k, _ in target} - {k for k, _ in source}


@SETTINGS
@given(values=amounts)
def test_split_then_coalesce_restores_amount(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "uuid int, amount double")
    out = {r.uuid: r.a for r in L.sign_split(df)
           .select("uuid", F.coalesce("amount_d", "amount_c").alias("a")).collect()}
    assert out == {i: v for i, v in enumerate(values) if v is not None}


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))), max_size=15))
def test_latest_by_key_is_idempotent(spark, rows):
    df = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(rows)], "k int, s int, i int")
    once = changes.latest_by_key(df, ["k"], "s", drop_sequence=False)
    twice = changes.latest_by_key(once, ["k"], "s", drop_sequence=False)
    assert as_set(once) == as_set(twice)
    # every surviving row carries its key's maximum sequence
    best = {}
    for k, s in rows:
        if s is not None:
            best[k] = max(best.get(k, s), s)
    assert all(r.s == best[r.k] for r in once.collect())
    assert {r.k for r in once.collect()} == set(best)


MAP_ROWS = [
    ("A", "Normal", "OP", "a", "DA", "CA", "2023", "12", "31"),
    ("A", "Correctora", "OP", "a rev", "DAR", "NA", "2023", "12", "31"),
    ("B", "Normal", "EC", "b", "NAD", "CB", "2023", "12", "31"),
    ("B", "Normal", "EC", "b2", "DB2", "CB2", "2023", "12", "31"),
    ("C", "Correctora", "EC", "c", "DC", None, "2023", "12", "31"),
    (None, "Normal", "OP", "null code", "DN", "CN", "2023", "12", "31"),
]
MAP_SCHEMA = ("code string, posting_class string, register_type string, map_descr string, "
              "debit_account string, credit_account string, y string, m string, d string")
side = st.one_of(st.none(), st.sampled_from([-5.0, -0.5, 0.0, 2.0, 7.5]))
tx_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "Z", None]),
                             st.sampled_from(["OP", "EC", None]), side, side), max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=tx_rows)
def test_single_pass_ledger_and_unmapped_match_stepwise_shapes(spark, rows):
    import datetime as dt

    from ledgerflow.plans import naive
    from ledgerflow.sources.fixtures import FX_MAP
    t = dt.datetime(2024, 1, 5)
    data = [(t, f"u{i}", t, t, code, "desc", typ, "MX-1", d, c, "2024", "1", "5")
            for i, (code, typ, d, c) in enumerate(rows)]
    tx = spark.createDataFrame(data, "insert_date timestamp, uuid string, date timestamp, "
                               "accounting_date timestamp, invoice string, invoice_description string, "
                               "type string, id_client string, amount_d double, amount_c double, "
                               "year string, month string, day string")
    m = L.latest_snapshot(spark.createDataFrame(MAP_ROWS, MAP_SCHEMA), FX_MAP)
    assert as_set(L.post_ledger(tx, m, FX_MAP)) == as_set(L.post_ledger_stepwise(tx, m, FX_MAP))
    assert as_set(L.post_ledger(tx, m, FX_MAP)) == as_set(naive.post_ledger(tx, m, FX_MAP))
    assert as_set(L.unmapped(tx, m, FX_MAP)) == as_set(naive.unmapped(tx, m, FX_MAP))
