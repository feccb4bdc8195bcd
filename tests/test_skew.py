"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from ledgerflow.operators import changes
from ledgerflow.plans import naive


def hot_feed(spark, n=3000):
    # key 0 holds a third of the rows; its newest sequence is tied 5 times
    return (spark.range(n)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                    F.when(F.col("id") % 3 == 0, F.least(F.col("id"), F.lit(14))).otherwise(F.lit(1)).alias("seq"),
                    F.col("id").alias("payload")))


def test_latest_by_key_with_hot_key(spark):
    feed = hot_feed(spark)
    fast = changes.latest_by_key(feed, ["k"], "seq")
    slow = naive.latest_by_key(feed, ["k"], "seq")
    assert sorted(fast.collect()) == sorted(slow.collect())
    hot = fast.where("k = 0").count()
    assert hot == feed.where("k = 0 AND seq = 14").count() and hot > 900
    one = changes.latest_by_key(feed, ["k"], "seq", ties="one")
    assert one.where("k = 0").count() == 1
    assert one.count() == feed.select("k").distinct().count()


def test_upsert_and_delete_with_hot_target_key(spark):
    target = hot_feed(spark).select("k", "payload")
    source = spark.createDataFrame([(1, -1), (0, -2)], "k long, payload long")
    out = changes.upsert(target, source, ["k"])
    # every row of key 0 is replaced by the single source row
    assert out.where("k = 0").collect()[0].payload == -2 and out.where("k = 0").count() == 1
    assert out.count() == target.where("k NOT IN (0, 1)").count() + 2
    gone = changes.delete_by_key(target, spark.createDataFrame([(0,)], "k long"), ["k"])
    assert gone.count() == target.count() - target.where("k = 0").count()
