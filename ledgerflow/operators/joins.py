"""Join-side helpers.

A broadcast hint is only given to a side whose estimated size is within a byte
bound.  The estimate is the planner's own (file sizes, literal rows, what its
operators make of them), read from the optimised plan: no job runs, nothing is
remembered, so a rewritten input is judged anew.  Without a hint the planner
and AQE's runtime re-planning choose.

``sized_join`` broadcasts a side within the bound; beyond it ``split_join``
shuffles both sides, the rows of hot keys dealt over many partitions.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Estimated bytes up to which a side is broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 16 * 1024 * 1024
# A key is hot from one row in so many of the large side (so there are at most
# that many hot keys), and the sketch that finds them tracks so many keys.
HOT_SHARE = 64
SKETCH_ITEMS = 4096
_HASH, _SPLIT, _SMALL_SPLIT = "_key_hash", "_split", "_small_split"


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df`` (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                      force: Optional[bool] = None) -> DataFrame:
    """``broadcast(df)`` if its estimated size is at most ``max_bytes``, else
    ``df``.  ``force=True``/``False`` skips the check (the caller vouches for
    the size or wants a shuffled join)."""
    if force is None:
        force = estimated_bytes(df) <= max_bytes
    return F.broadcast(df) if force else df


def _key_hash(keys: Sequence[str], types: Sequence[T.DataType]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types)])


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> Column:
    """Scalar subquery: hashes of the keys that hold at least one in ``share``
    rows of ``df``.  One frequent-items sketch over the key columns, merged
    from one per task, whose counts are off by less than a thousandth of the
    rows: near the threshold it may name a key or not, which only changes how
    its rows are dealt."""
    hashes = df.select(_key_hash(keys, [df.schema[k].dataType for k in keys]).alias(_HASH))
    found = hashes.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, {share}, {SKETCH_ITEMS})").alias("top"))
    return found.select(F.expr(f"transform(filter(top, t -> t.count * {share} >= n), t -> t.item)")).scalar()


def split_join(large: DataFrame, small: DataFrame, on: Sequence[tuple[str, str]], how: str = "inner",
               splits: Optional[int] = None) -> DataFrame:
    """Shuffled equi-join (``inner``, ``left``, ``left_semi`` or ``left_anti``)
    on pairs of columns, safe for hot keys of ``large``.

    A row of ``large`` with a hot key gets one of ``splits`` numbers (default:
    the session's shuffle partitions), its rows in ``small`` are repeated for
    every number, and the number joins with the key: each row of ``large``
    still meets every match once.  Only the rows of at most ``HOT_SHARE`` keys
    are repeated, and the join is a sort-merge join whatever the planner's
    estimate, so ``small`` may be of any size.
    The number is made of the row and its task, so a retried task deals alike.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"split_join cannot do {how!r}")
    splits = splits or int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = [a for a, _ in on], [b for _, b in on]
    types = [large.schema[k].dataType for k in left]
    hot = hot_keys(large, left)

    def is_hot(keys: Sequence[str]) -> Column:
        return F.coalesce(F.array_contains(hot, _key_hash(keys, types)), F.lit(False))

    row = [F.col(f.name) for f in large.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    dealt = large.withColumn(_SPLIT, F.when(is_hot(left), F.pmod(F.xxhash64(F.spark_partition_id(), *row), F.lit(splits)))
                             .otherwise(0).cast("int"))
    every = F.when(is_hot(right), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
    repeated = small.withColumn(_SMALL_SPLIT, F.explode(every))
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in on]) & (F.col(_SPLIT) == F.col(_SMALL_SPLIT))
    return dealt.join(repeated.hint("merge"), cond, how).drop(_SPLIT, _SMALL_SPLIT)


def sized_join(large: DataFrame, small: DataFrame, on: Sequence[tuple[str, str]], how: str = "inner",
               force: Optional[bool] = None) -> DataFrame:
    """``small`` broadcast if its estimated size is within the bound, else
    ``split_join``; ``force`` as in ``bounded_broadcast``."""
    if force is None:
        force = estimated_bytes(small) <= DEFAULT_MAX_BROADCAST_BYTES
    if not force:
        return split_join(large, small, on, how)
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in on])
    return large.join(F.broadcast(small), cond, how)
