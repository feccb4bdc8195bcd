"""Joins of hot keys without a broadcast, reports computed once, marks read from
the newest folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import joins, promote
from ledgerflow.sinks.reports import write_report
from ledgerflow.sources import partitioned as P
from ledgerflow.sources import tables as TB

ON = [("code", "m_code"), ("kind", "m_kind")]


@pytest.fixture(scope="module")
def sides(spark):
    large = (spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 50 == 9, None)
        .otherwise(F.concat(F.lit("c"), F.col("id") % 701)).alias("code"), F.lit(1).alias("kind"),
        F.map_from_arrays(F.array(F.lit("k")), F.array("id")).alias("extra")))
    small = spark.createDataFrame(
        [("hot", 1, "a"), ("hot", 1, "b"), ("hot", 2, "x"), (None, 1, "n")] + [(f"c{i}", 1, str(i)) for i in range(0, 701, 2)],
        "m_code string, m_kind long, account string")
    return large, small


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_join(sides, how):
    large, small = sides
    plain = large.join(small, (F.col("code") == F.col("m_code")) & (F.col("kind") == F.col("m_kind")), how)
    got = joins.split_join(large, small, ON, how, splits=7)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_hot_key_is_dealt_over_the_splits(spark, sides):
    large, small = sides
    hot = large.select(F.explode(joins.hot_keys(large, ["code", "kind"])).alias("h"))
    assert hot.distinct().count() == 2            # the code of nine tenths of the rows, and the null of a fiftieth
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[1] for r in joins.split_join(large, small, ON, splits=64).groupBy(F.spark_partition_id()).count().collect()]
        plan = joins.sized_join(large, small, ON, force=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_split_join_of_empty_sides(sides):
    large, small = sides
    assert joins.split_join(large.where("false"), small, ON).count() == 0
    assert joins.split_join(large, small.where("false"), ON, "left_anti").count() == 20_000
    with pytest.raises(ValueError):
        joins.split_join(large, small, ON, "full")


def test_report_runs_its_plan_once(spark, scratch):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    path = f"{scratch}/report"
    frame = spark.range(100).mapInArrow(count, "id long")
    assert write_report(frame, path) is True
    assert ran.value == 100
    assert spark.read.option("header", True).csv(path).count() == 100
    # an empty frame leaves the earlier report, and nothing beside it
    assert write_report(frame.where("id < 0"), path) is False
    assert write_report(spark.range(5).where("id > 9"), f"{scratch}/none") is False
    assert os.listdir(scratch) == ["report"]
    assert spark.read.option("header", True).csv(path).count() == 100
    assert write_report(spark.range(3), path) is True
    assert spark.read.option("header", True).csv(path).count() == 3


def test_failed_report_leaves_the_earlier_one(spark, scratch):
    path = f"{scratch}/report"
    write_report(spark.range(4), path)
    with pytest.raises(Exception):
        write_report(spark.range(4).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert os.listdir(scratch) == ["report"]
    assert spark.read.option("header", True).csv(path).count() == 4


@pytest.mark.parametrize("unit", ["day", "month"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_newest_folder_gives_the_mark(spark, scratch, unit, kind):
    path = f"{scratch}/table"
    when = [None, "2024-01-31 23:59:59.000", "2024-02-01 00:00:01.000", "2024-02-01 08:00:00.000", "2023-05-05 01:00:00.000"]
    source = spark.createDataFrame(list(enumerate(when)), "id int, at string").withColumn("at", F.col("at").cast(kind))
    P.upsert_partitions(spark, path, source.where("id = 0"), ["id"], P.dated("at", unit))
    whole = lambda: TB.read_table(spark, path)
    mark = lambda df: promote.high_water_mark(df, "at").first()
    assert tuple(mark(P.read_newest(spark, path))) == (None, 1)       # no timestamp at all: promotes none
    P.upsert_partitions(spark, path, source, ["id"], P.dated("at", unit))
    newest = P.read_newest(spark, path)
    assert mark(newest).mark == mark(whole()).mark == dt.datetime(2024, 2, 1, 8)
    assert len(newest.inputFiles()) < len(whole().inputFiles())
    assert newest.columns == whole().columns
    assert rows(promote.newer_than(source, newest, "at", inclusive=True)) == rows(promote.newer_than(source, whole(), "at", inclusive=True))
