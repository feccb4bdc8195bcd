"""Merges that rewrite only what they touch: files, rows, pruning, replays."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow import config as C
from ledgerflow.operators import changes, promote
from ledgerflow.plans import jobs
from ledgerflow.sources import partitioned as PT
from ledgerflow.sources import tables as TB
from ledgerflow.streaming import ingest

ROWS = "k int, part string, ts timestamp_ntz, v string, year string, month string, day string"
LAYOUT = PT.dated("ts", "month")


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def rows(spark, items):
    """(key, month, value): the stored date parts are those of January."""
    return spark.createDataFrame([(k, "p", dt.datetime(2024, m, 5) if m else None, v, "2024", "1", "5") for k, m, v in items], ROWS)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def content(df):
    return sorted(map(str, df.collect()))


def test_upsert_keeps_files_of_other_folders(spark, scratch):
    path = scratch + "/t"
    start = rows(spark, [(i, 1 + i % 4, f"a{i}") for i in range(40)] + [(None, 2, "null"), (100, None, "undated")])
    PT.upsert_partitions(spark, path, start, ["k"], LAYOUT)
    before = files(path)
    # key 3 (April) stays, key 7 (April) moves to May, 200 is new in March, null keys never match
    source = rows(spark, [(3, 4, "new"), (7, 5, "moved"), (200, 3, "added"), (None, 2, "null again")])
    PT.upsert_partitions(spark, path, source, ["k"], LAYOUT)
    assert content(TB.read_table(spark, path)) == content(changes.upsert(start, source, "k"))
    assert files(path).items() >= before.items()
    held = PT.read_held(spark, path, 2)
    writes = {held.values(f)[0]: len(w) for f, w in held.folders.items()}
    assert writes == {"2024-01-01": 1, "2024-02-01": 2, "2024-03-01": 2, "2024-04-01": 1, "2024-05-01": 1, None: 1}
    first = PT.read_held(spark, path, 1)
    same = [f for f in held.folders if first.folders.get(f) == held.folders[f]]
    assert sorted(str(held.values(f)[0]) for f in same) == ["2024-01-01", "None"]
    assert content(TB.read_at(spark, path, 1)) == content(start)


def test_delete_rewrites_folders_of_the_keys_only(spark, scratch):
    path = scratch + "/t"
    start = rows(spark, [(i, 1 + i % 6, f"a{i}") for i in range(60)])
    PT.upsert_partitions(spark, path, start, ["k"], LAYOUT)
    gone = spark.createDataFrame([(k,) for k in (0, 6, 12, None, 999)] + [(1 + 6 * i,) for i in range(10)], "k bigint")
    PT.delete_from_partitions(spark, path, gone, ["k"], LAYOUT)
    assert content(TB.read_table(spark, path)) == content(changes.delete_by_key(start, gone, "k"))
    a, b = PT.read_held(spark, path, 1).folders, PT.read_held(spark, path, 2).folders
    assert len(a) == 6 and len(b) == 5 and sum(a[f] == b[f] for f in b) == 4    # February is empty, January rewritten
    with pytest.raises(TB.TableNotFound):
        PT.delete_from_partitions(spark, scratch + "/none", gone, ["k"], LAYOUT)


def test_key_filter_prunes_before_any_shuffle(spark, scratch):
    spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("u"), "id").alias("u")).write.parquet(scratch + "/big")
    big = spark.read.parquet(scratch + "/big")
    few = spark.createDataFrame([(i, f"u{i}") for i in (5, 70_000, 70_001)], "k long, u string")
    found = PT.rows_of_keys(big, few, ["u", "k"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5)" in text and "LessThanOrEqual(u,u70001)" in text
    assert sorted(r.k for r in found.collect()) == [5, 70_000, 70_001]
    # of 100,000 rows hardly any but the keys reach the join
    assert big.where(PT.key_filter(few, ["u", "k"])).count() <= 10


def test_key_filter_never_loses_a_key(spark):
    rng = random.Random(2)
    pool = [(rng.randrange(-50, 50), rng.choice(["a", "b", "é", "", None]), dt.date(2024, 1, 1 + rng.randrange(28))) for _ in range(400)]
    table = spark.createDataFrame(pool, "a long, b string, c date")
    for n in (0, 1, 30):
        keys = spark.createDataFrame([(int(a), b, c) for a, b, c in pool[:n]] + [(None, "a", None)], "a int, b string, c date")
        for columns in (["a"], ["a", "b"], ["c", "b", "a"]):
            want = table.join(keys.dropna(subset=columns).select(*columns).distinct(), columns, "left_semi").select("a", "b", "c")
            assert content(PT.rows_of_keys(table, keys, columns)) == content(want)


def test_key_filter_of_many_keys_is_their_range(spark, monkeypatch):
    monkeypatch.setattr(PT, "MAX_KEYS", 20)
    table, keys = spark.range(1000).toDF("k"), spark.range(100, 400, 3).toDF("k")
    assert "substring" not in str(PT.key_filter(keys, ["k"])) and "substring" in str(PT.key_filter(keys.limit(20), ["k"]))
    assert [r.k for r in PT.rows_of_keys(table, keys, ["k"]).orderBy("k").collect()] == list(range(100, 400, 3))


def test_folders_of_many_writes_are_compacted_and_old_writes_retired(spark, scratch, monkeypatch):
    path = scratch + "/t"
    monkeypatch.setattr(PT, "MAX_WRITES", 3)
    monkeypatch.setattr(TB, "KEEP_VERSIONS", 2)
    for i in range(6):
        PT.upsert_partitions(spark, path, rows(spark, [(i, 1, f"a{i}")]), ["k"], LAYOUT)
    held = PT.read_held(spark, path, 6)
    assert max(map(len, held.folders.values())) <= 3
    assert sorted(r.k for r in TB.read_table(spark, path).collect()) == list(range(6))
    assert TB.committed_versions(spark, path) == [5, 6]
    named = {w for v in (5, 6) for ws in PT.read_held(spark, path, v).folders.values() for w in ws}
    assert {f.split("write=")[1].split("/")[0] for f in files(path)} == named


def test_snapshots_and_merges_share_versions(spark, scratch):
    path = scratch + "/t"
    TB.write_snapshot(rows(spark, [(1, 1, "a"), (2, 2, "b")]), path)
    PT.upsert_partitions(spark, path, rows(spark, [(2, 3, "c")]), ["k"], LAYOUT)
    PT.upsert_partitions(spark, path, rows(spark, [(3, 3, "d")]).withColumn("extra", F.lit(1)), ["k"], LAYOUT)
    got = TB.read_table(spark, path)
    assert sorted((r.k, r.v, r.extra) for r in got.collect()) == [(1, "a", None), (2, "c", None), (3, "d", 1)]
    TB.write_snapshot(got, path)
    assert TB.committed_versions(spark, path) == [1, 2, 3, 4] and TB.read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        PT.upsert_partitions(spark, path, rows(spark, [(9, 1, "x")]), ["k"], LAYOUT)
        PT.upsert_partitions(spark, path, rows(spark, [(9, 1, "x")]).withColumn("v", F.lit(1)), ["k"], PT.dated("ts", "month"))


def test_second_writer_of_a_version_loses_nothing(spark, scratch, monkeypatch):
    path = scratch + "/t"
    PT.upsert_partitions(spark, path, rows(spark, [(1, 1, "a")]), ["k"], LAYOUT)
    write, other = PT._write, rows(spark, [(2, 1, "b")])

    def write_after_another(*args):
        monkeypatch.setattr(PT, "_write", write)
        PT.upsert_partitions(spark, path, other, ["k"], LAYOUT)
        return write(*args)

    monkeypatch.setattr(PT, "_write", write_after_another)
    with pytest.raises(TB.ConcurrentWrite):
        PT.upsert_partitions(spark, path, rows(spark, [(3, 1, "c")]), ["k"], LAYOUT)
    assert sorted(r.k for r in TB.read_table(spark, path).collect()) == [1, 2]
    assert len(glob.glob(path + "/data/write=*")) == 2 and not glob.glob(path + "/_*")


def test_marker_of_a_killed_writer_lapses(spark, scratch, monkeypatch):
    path = scratch + "/t"
    TB.write_snapshot(spark.range(1), path)
    open(path + "/_claim-v00000002", "w").close()
    with pytest.raises(TB.ConcurrentWrite):
        TB.write_snapshot(spark.range(2), path)
    old = os.stat(path).st_mtime - TB.CLAIM_SECONDS - 60
    os.utime(path + "/_claim-v00000002", (old, old))
    TB.write_snapshot(spark.range(2), path)
    assert TB.read_table(spark, path).count() == 2 and not glob.glob(path + "/_*")


# --- pruned reads -------------------------------------------------------------

def scanned(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: ")[1].split(", PushedFilters")[0] for line in text.splitlines() if "PartitionFilters: " in line]


def test_date_bounds_skip_folders_and_find_restamped_rows(spark, scratch):
    path = scratch + "/t"
    # key 3 has January's date parts but was restamped in March
    PT.upsert_partitions(spark, path, rows(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, None, "d")]), ["k"], LAYOUT)
    table = PT.read_with_layout(spark, path)
    gold = rows(spark, [(9, 2, "mark")])
    for got in (promote.since(table, "ts", "2024-03-02", drop=()), promote.history_since(table, "ts", "2024-03-01 00:00:00"),
                promote.newer_than(table, gold, "ts")):
        assert [r.k for r in got.collect()] == [3]
        assert "period_month" in scanned(got)[0] and "period_month" not in got.columns
    assert sorted(r.k for r in promote.newer_than(table, gold.where("false"), "ts").collect()) == [1, 2, 3, 4]
    assert promote.newer_than(table, gold.withColumn("ts", F.lit(None).cast("timestamp_ntz")), "ts").count() == 0


def test_skipped_folders_are_not_read(spark, scratch):
    path = scratch + "/t"
    PT.upsert_partitions(spark, path, rows(spark, [(m, m, "a") for m in range(1, 13)]), ["k"], PT.dated("ts"))
    for f in files(path):
        if "period_day=2024-12" not in f and "period_day=2024-11" not in f:
            os.remove(f)                        # reading one of these would fail
    table = PT.read_with_layout(spark, path)
    assert promote.since(table, "ts", "2024-11-03", drop=()).count() == 2
    assert promote.newer_than(table, rows(spark, [(0, 11, "x")]), "ts").count() == 1


# --- bronze -------------------------------------------------------------------

FEED = "id int, seq int, Op string, ts timestamp, name string"
SPEC = C.ChangeFeedSpec(keys=("id",), sequence="seq", op="Op", timestamp="ts", tie_break=("Op", "name"))


def feed(spark, seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(25)]), rng.randrange(9), rng.choice(["U", "I", "D", None]), dt.datetime(2024, 1, 1 + rng.randrange(9)), rng.choice("abc"))
            for _ in range(n)]


def test_bucketed_state_does_not_depend_on_batches(spark, scratch):
    changes_ = feed(spark, 1)
    states = []
    for step in (60, 30, 13):
        path = f"{scratch}/t{step}"
        for i in range(0, 60, step):
            ingest.merge_batch(spark, spark.createDataFrame(changes_[i:i + step], FEED), path, SPEC, buckets=7)
        states.append(content(TB.read_table(spark, path)))
    assert states[0] == states[1] == states[2]


def test_batch_leaves_other_buckets_alone(spark, scratch):
    path = scratch + "/t"
    ingest.merge_batch(spark, spark.createDataFrame([(i, 1, "I", dt.datetime(2024, 1, 1), "a") for i in range(200)], FEED), path, SPEC, buckets=16)
    before = PT.read_held(spark, path, 1).folders
    old = files(path)
    ingest.merge_batch(spark, spark.createDataFrame([(5, 2, "D", dt.datetime(2024, 1, 2), "a")], FEED), path, SPEC, buckets=16)
    after = PT.read_held(spark, path, 2).folders
    assert len(before) == 16 and sum(before[f] != after[f] for f in before) == 1
    assert files(path).items() >= old.items()
    assert ingest.read_bronze(spark, path, SPEC).count() == 199
    # another number of buckets rewrites the table once, and loses nothing
    ingest.merge_batch(spark, spark.createDataFrame([(6, 2, "D", dt.datetime(2024, 1, 2), "a")], FEED), path, SPEC, buckets=3)
    assert ingest.read_bronze(spark, path, SPEC).count() == 198


def test_replayed_batch_of_a_killed_run_adds_no_version(spark, scratch, monkeypatch):
    src, path, ckpt = scratch + "/src", scratch + "/t", scratch + "/c"
    schema = spark.createDataFrame([], FEED).schema
    spark.createDataFrame(feed(spark, 2), FEED).coalesce(1).write.parquet(src)
    merge = ingest.merge_batch

    def killed_after_commit(*args):
        merge(*args)
        raise RuntimeError("the driver dies before the stream notes the batch")

    monkeypatch.setattr(ingest, "merge_batch", killed_after_commit)
    with pytest.raises(Exception):
        ingest.ingest_available_now(spark, src, schema, path, SPEC, ckpt)
    assert TB.committed_versions(spark, path) == [1]
    state = content(TB.read_table(spark, path))
    replayed = []
    monkeypatch.setattr(ingest, "merge_batch", lambda *args: replayed.append(merge(*args)))
    ingest.ingest_available_now(spark, src, schema, path, SPEC, ckpt)
    assert replayed == [None] and TB.committed_versions(spark, path) == [1] and content(TB.read_table(spark, path)) == state
    # the next batch of the same stream is merged
    spark.createDataFrame([(77, 1, "I", dt.datetime(2024, 1, 1), "z")], FEED).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest_available_now(spark, src, schema, path, SPEC, ckpt)
    assert TB.committed_versions(spark, path) == [1, 2]


def test_bucket_merge_shuffles_every_row_once(spark, scratch, monkeypatch):
    path, write, plans = scratch + "/t", PT._write, []

    def seen(spark_, at, df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(spark_, at, df, *more)

    monkeypatch.setattr(PT, "_write", seen)
    monkeypatch.setattr(PT, "TASK_ROWS", 30)
    rows_ = [(i % 40, i % 7, "UID"[i % 3], dt.datetime(2024, 1, 1 + i % 9), "abc"[i % 3]) for i in range(200)]
    for i in (0, 100):
        ingest.merge_batch(spark, spark.createDataFrame(rows_[i:i + 100], FEED), path, SPEC, buckets=2)
    assert ["ENSURE_REQUIREMENTS" in p for p in plans] == [False, False]
    assert [p.count("REPARTITION_BY_NUM") for p in plans] == [1, 1]
    want = changes.latest_by_key(changes.state_rows(spark.createDataFrame(rows_, FEED), SPEC), ["id"], "seq", ties="one",
                                 tie_break=SPEC.tie_break, drop_sequence=False)
    assert content(TB.read_table(spark, path)) == content(want)
    assert len(files(path)) > 4      # a bucket is written by several tasks


def test_hot_key_of_a_batch_is_reduced_before_the_merge(spark, scratch, monkeypatch):
    monkeypatch.setattr(ingest, "HOT_ROWS", 10)
    merge, sizes = ingest.merge_newest, []
    monkeypatch.setattr(ingest, "merge_newest", lambda old, new, *more: sizes.append(new.count()) or merge(old, new, *more))
    batch = spark.createDataFrame([(3, i, "U", dt.datetime(2024, 1, 1), "h") for i in range(300)] + [(k, 1, "I", dt.datetime(2024, 1, 2), "x") for k in range(20)], FEED)
    ingest.merge_batch(spark, batch, scratch + "/t", SPEC, buckets=2)
    assert sizes == [20] and sorted((r.id, r.seq) for r in TB.read_table(spark, scratch + "/t").collect()) == [(k, 299 if k == 3 else 1) for k in range(20)]


def test_batch_that_changes_between_reads_is_refused(spark, scratch):
    layout = PT.bucketed(["id"], 8)
    batch = spark.createDataFrame([(i, 1, "I", dt.datetime(2024, 1, 1), "a") for i in range(40)], FEED)
    ingest.merge_batch(spark, batch, scratch + "/t", SPEC, buckets=8)
    with pytest.raises(ValueError, match="read again"):
        PT.merge_buckets(spark, scratch + "/t", TB.read_table(spark, scratch + "/t"), ["id"], layout, lambda old, new, deal: new, found=(1, {"1"}))
    assert TB.committed_versions(spark, scratch + "/t") == [1]


# --- incremental posting --------------------------------------------------------

OPS = ("insert_date timestamp_ntz, uuid string, invoice_date timestamp_ntz, accounting_operation_date timestamp_ntz, invoice_type string, "
       "invoice_type_description string, invoice_amount double, contract_id int")
ECS = ("insert_date timestamp_ntz, uuid string, interests_calculation_last_date timestamp_ntz, file_date timestamp_ntz, economic_concept_code string, "
       "economic_concept_code_description string, economic_concept_gross_amount double, contract_id int")
SHEET = ("economic_concept string, `normal/correctora` string, registertype string, ec_description_ string, debit_account string, credit_account string, "
         "year string, month string, day string")


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_ledger_equals_posting_everything(spark, scratch, seed):
    rng = random.Random(seed)
    tables = {full: jobs.Tables(f"{scratch}/s{full}", f"{scratch}/g{full}", f"{scratch}/r{full}", unit="month") for full in (False, True)}
    sheet, data = [], {"OP": [], "EC": []}
    for step in range(1, 4):
        for kind in data:
            for _ in range(rng.randint(2, 12)):
                when = rng.choice([dt.datetime(2024, step, rng.randint(1, 20)), dt.datetime(2024, step, 20), None])
                data[kind].append((when, f"{kind}{len(data[kind])}", dt.datetime(2023 + rng.randrange(2), 1, 1), None, f"c{rng.randrange(6)}", "d",
                                   rng.choice([10.0, -4.0, 0.0, None]), 7))
        for _ in range(rng.randint(1, 5)):
            sheet.append((f"c{rng.randrange(6)}", rng.choice([C.NORMAL, C.CORRECTING]), rng.choice(["OP", "EC"]), f"d{step}", rng.choice(["1", "2", "NA"]),
                          rng.choice(["8", "9"]), "2024", str(step), str(rng.randint(1, 28))))
        ops, ecs, mapping = (spark.createDataFrame(x, t) for x, t in ((data["OP"], OPS), (data["EC"], ECS), (sheet, SHEET)))
        for full, where in tables.items():
            if step > 1:
                jobs.build_unmapped(spark, {"MX": ops}, {"MX": ecs}, spark.createDataFrame(sheet[:2], SHEET), where)
            jobs.build_ledger(spark, {"MX": ops}, {"MX": ecs}, mapping, where, as_of=f"2024-0{step}-25", full=full)
        for name in (jobs.TRANSACTIONS, jobs.UNMAPPED)[:1 + (step > 1)]:
            a, b = (content(TB.read_table(spark, where.silver_table(name))) for where in tables.values())
            assert a == b, (step, name)
    again = TB.latest_version(spark, tables[False].silver_table(jobs.TRANSACTIONS))
    jobs.build_ledger(spark, {"MX": ops}, {"MX": ecs}, mapping, tables[False], as_of="2024-03-26")
    jobs.build_ledger(spark, {"MX": ops}, {"MX": ecs}, mapping, tables[False], as_of="2024-03-26")
    assert TB.latest_version(spark, tables[False].silver_table(jobs.TRANSACTIONS)) <= again + 2
