"""Change capture and keyed merges on plain DataFrames.

``latest_by_key`` reduces a change feed to the newest row(s) per key,
``upsert`` / ``delete_by_key`` / ``merge_changes`` compute the next snapshot of
a keyed table.  All are lazy: the caller decides where the result is written
(see ``ledgerflow.sources.tables``).

Scale notes
-----------
* ``latest_by_key`` never sends all rows of one key to one task: a partial
  limit keeps each key's newest rows per map task before the shuffle (see the
  function's docstring).
* Merges are one left-anti join of the target against the source keys plus a
  union.  Null key parts never match (as in SQL MERGE).  AQE splits skewed
  left-side partitions of the anti join.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.functions.dates import with_date_parts
from ledgerflow.functions.privacy import pseudonymise
from ledgerflow.operators.joins import bounded_broadcast


#: Spreads rows over tasks: (rows with a column of their place, its name).
Deal = Callable[[DataFrame], tuple[DataFrame, str]]


def _keys(keys: Sequence[str] | str) -> list[str]:
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",")]
    keys = [k for k in keys if k]
    if not keys:
        raise ValueError("a merge needs at least one key column")
    return list(keys)


def all_not_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def fill_op(df: DataFrame, op: str = "Op", value: str = C.FULL_LOAD_OP) -> DataFrame:
    """Null operation codes (rows of the initial full load) become ``value``."""
    return df.withColumn(op, F.coalesce(F.col(op), F.lit(value)))


def newest_first(df: DataFrame, keys: Sequence[str], sequence: str, tie_break: Sequence[str] = (),
                 leave: Sequence[str] = ()) -> list[Column]:
    """The total order of one key's rows, newest first: by ``sequence``, then by
    ``tie_break``, then by all other orderable columns but ``leave``."""
    orderable = {f.name for f in df.schema.fields
                 if not isinstance(f.dataType, (T.MapType, T.VariantType))}
    rest = [c for c in df.columns
            if c not in keys and c != sequence and c not in tie_break and c in orderable and c not in leave]
    return [F.col(sequence).desc(), *[F.col(c).desc_nulls_last() for c in (*tie_break, *rest)]]


def latest_by_key(df: DataFrame, keys: Sequence[str], sequence: str,
                  ties: str = "keep", tie_break: Sequence[str] = (),
                  drop_sequence: bool = True, strategy: str = "rank") -> DataFrame:
    """Newest row(s) per key by ``sequence``.

    Rows with a null sequence never win; rows with null key parts form their
    own group per distinct key value (null included).

    ``ties="keep"`` returns every row tied on the newest sequence (the source
    job's behaviour).  Plan: ``rank() == 1``, one scan and one shuffle; the
    partial ``WindowGroupLimit`` lets each map task send only the rows that
    are newest there, so a hot key does not reach a reducer whole, and the
    sorts spill.

    ``strategy="preaggregate"`` takes ``max(sequence)`` per key as a hash
    aggregate and a left-semi join on (key, sequence = max): two scans, no
    sort of the feed by key; the join is partitioned by key *and* sequence.

    ``strategy="window"`` computes the keep-ties form as ``max`` over a key
    window instead: one shuffle and no second scan, but every row of a key
    meets in one task, so use it only for feeds known to have no hot keys.

    ``ties="one"`` returns exactly one row per key, choosing by ``tie_break``
    columns and then by all remaining orderable columns (descending, nulls
    last), so the choice is deterministic.  ``row_number() == 1`` plans with a
    partial ``WindowGroupLimit``: every map task keeps one row per key before
    the shuffle, so no key reaches a reducer with more rows than there are
    map tasks.
    """
    keys = _keys(keys)
    live = df.where(F.col(sequence).isNotNull())
    if ties == "keep" and strategy == "window":
        newest = F.max(sequence).over(Window.partitionBy(*keys))
        out = live.withColumn("_latest_seq", newest).where(
            F.col(sequence) == F.col("_latest_seq")).drop("_latest_seq")
    elif ties == "keep" and strategy == "rank":
        w = Window.partitionBy(*keys).orderBy(F.col(sequence).desc())
        out = live.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")
    elif ties == "keep":
        if strategy != "preaggregate":
            raise ValueError(f"strategy must be 'rank', 'preaggregate' or 'window', not {strategy!r}")
        # The key travels as one struct: struct equality treats null fields as
        # equal, so null key parts group and match like a window partition.
        newest = (live.groupBy(F.struct(*keys).alias("_latest_key"))
                  .agg(F.max(sequence).alias("_latest_seq")))
        cond = ((F.struct(*keys) == F.col("_latest_key"))
                & (F.col(sequence) == F.col("_latest_seq")))
        out = live.join(newest, cond, "left_semi")
    elif ties == "one":
        w = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, sequence, tie_break))
        out = live.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    else:
        raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
    return out.drop(sequence) if drop_sequence else out


def _key_counts(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null source keys with their row count (partial aggregation first,
    so a hot key costs one row per map task)."""
    return (source.where(all_not_null(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n")))


def duplicate_key_guard(source: DataFrame, keys: Sequence[str], like: DataFrame,
                        counts: Optional[DataFrame] = None) -> DataFrame:
    """An always-empty frame shaped like ``like`` that fails the job if
    ``source`` holds a non-null key more than once.

    The failure sits in a filter, so it fires for any action, ``count()``
    included.  The raising predicate is conditional on the count, so the
    optimizer cannot push it below the aggregate onto every source row.
    """
    keys = _keys(keys)
    counts = counts if counts is not None else _key_counts(source, keys)
    n = F.col("_n")
    message = F.concat(F.lit("merge source holds a key more than once: "),
                       F.to_json(F.struct(*keys)))
    return (counts.where(n > 1).where(F.when(n > 1, F.raise_error(message)).isNull())
            .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields]))


def _merge_columns(target: DataFrame, source: DataFrame) -> list[str]:
    return target.columns + [c for c in source.columns if c not in target.columns]


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] | str,
           check_unique: bool = True, broadcast_keys: Optional[bool] = False) -> DataFrame:
    """Next snapshot of ``target`` after an update-all / insert-all merge.

    Target rows whose key occurs in ``source`` are replaced, other source rows
    are inserted, rows with a null key part never match.  Columns new in the
    source are added (null for untouched rows); column order is the target's,
    then the new ones.  ``check_unique`` fails the job when a source key
    occurs twice (a MERGE would be ambiguous).

    The anti join's key side and the duplicate guard are both read from one
    per-key count aggregate, so the source is aggregated once (the guard
    reuses the aggregate's shuffle) and scanned once more for the insert.

    ``broadcast_keys``: ``False`` leaves the join strategy to the planner and
    AQE (the target is shuffled by key); ``None`` broadcasts the source key set
    when the planner's size estimate is within the byte bound of
    ``joins.bounded_broadcast``, so a small increment merges into a large
    target without shuffling the target; ``True`` forces
    the broadcast.
    """
    keys = _keys(keys)
    counts = _key_counts(source, keys)
    # The filter on the count keeps the aggregate in the anti join's key side
    # (without it the optimizer drops the aggregate there and the guard's
    # aggregate could not reuse the shuffle).
    key_set = counts.where(F.col("_n") >= 1).select(*keys)
    if broadcast_keys is not False:
        key_set = bounded_broadcast(key_set, force=broadcast_keys)
    kept = target.join(key_set, keys, "left_anti")
    merged = kept.unionByName(source, allowMissingColumns=True)
    merged = merged.select(*_merge_columns(target, source))
    if check_unique:
        merged = merged.unionByName(duplicate_key_guard(source, keys, merged, counts))
    return merged


def delete_by_key(target: DataFrame, keys_df: DataFrame, keys: Sequence[str] | str,
                  broadcast_keys: Optional[bool] = False) -> DataFrame:
    """``target`` without the rows whose key occurs in ``keys_df``.

    The key set is de-duplicated first (partial aggregation before the shuffle,
    and the aggregate's partitioning is reused by the join).  ``broadcast_keys``
    as in ``upsert``."""
    keys = _keys(keys)
    doomed = keys_df.where(all_not_null(keys)).select(*keys).distinct()
    if broadcast_keys is not False:
        doomed = bounded_broadcast(doomed, force=broadcast_keys)
    return target.join(doomed, keys, "left_anti").select(*target.columns)


def merge_changes(target: DataFrame, latest: DataFrame, keys: Sequence[str] | str,
                  op: str, deletes: str = "apply",
                  broadcast_keys: Optional[bool] = False) -> DataFrame:
    """Apply one batch of de-duplicated changes to a keyed snapshot.

    ``deletes="apply"``: keys whose newest change is a delete are removed and
    not inserted; ``"keep"``: delete rows are stored like any other change.
    One anti join covers updates and deletes together.  ``broadcast_keys`` as
    in ``upsert``.
    """
    keys = _keys(keys)
    if deletes == "keep":
        return upsert(target, latest, keys, check_unique=False, broadcast_keys=broadcast_keys)
    if deletes != "apply":
        raise ValueError(f"deletes must be 'apply' or 'keep', not {deletes!r}")
    live = latest.where(~F.coalesce(F.col(op) == F.lit(C.DELETE_OP), F.lit(False)))
    key_set = latest.where(all_not_null(keys)).select(*keys)
    if broadcast_keys is not False:
        key_set = bounded_broadcast(key_set, force=broadcast_keys)
    kept = target.join(key_set, keys, "left_anti")
    return (kept.unionByName(live, allowMissingColumns=True)
            .select(*_merge_columns(target, latest)))


def prepare_changes(changes: DataFrame, spec: C.ChangeFeedSpec,
                    pseudonymise_columns: Sequence[str] = (), secret: Optional[str] = None,
                    ties: str = "one", drop_sequence: bool = True) -> DataFrame:
    """Change feed to one mergeable row per key: fill the op code, keep the
    newest change per key, pseudonymise, add padded year/month/day of the
    change timestamp."""
    out = fill_op(changes, spec.op)
    out = latest_by_key(out, spec.keys, spec.sequence, ties=ties, tie_break=spec.tie_break,
                        drop_sequence=drop_sequence)
    if pseudonymise_columns:
        if secret is None:
            raise ValueError("pseudonymising needs a secret")
        out = pseudonymise(out, pseudonymise_columns, secret)
    return with_date_parts(out, spec.timestamp, padded=True)


def state_rows(changes: DataFrame, spec: C.ChangeFeedSpec) -> DataFrame:
    """The rows of a change feed that ``prepare_changes`` chooses from, as it
    would store them: every change that has a sequence."""
    live = fill_op(changes, spec.op).where(F.col(spec.sequence).isNotNull())
    return with_date_parts(live, spec.timestamp, padded=True)


def thin_hot_keys(rows: DataFrame, spec: C.ChangeFeedSpec, hot: Sequence[int]) -> DataFrame:
    """``rows`` with one row, the newest, of each key whose ``key_hash`` is in
    ``hot``; rows of other keys pass without a shuffle."""
    if not hot:
        return rows
    found = F.coalesce(key_hash(spec.keys).isin(*hot), F.lit(False))
    newest = latest_by_key(rows.where(found), spec.keys, spec.sequence, ties="one",
                           tie_break=spec.tie_break, drop_sequence=False)
    return rows.where(~found).unionByName(newest)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def apply_changes(target: DataFrame, changes: DataFrame, spec: C.ChangeFeedSpec,
                  deletes: str = "apply", pseudonymise_columns: Sequence[str] = (),
                  secret: Optional[str] = None) -> DataFrame:
    """Next snapshot of a bronze table after one batch of the change feed."""
    latest = prepare_changes(changes, spec, pseudonymise_columns, secret)
    return merge_changes(target, latest, spec.keys, spec.op, deletes)


def merge_newest(target: DataFrame, latest: DataFrame, spec: C.ChangeFeedSpec,
                 deal: Optional[Deal] = None) -> DataFrame:
    """Next state of a bronze table that keeps its sequence: for every key the
    newest change of ``target`` and ``latest`` (one row per key each), deletes
    included as tombstones.

    "Newest" is the order of ``latest_by_key(ties="one")``, a total order of
    the stored rows, so the state after any number of batches does not depend
    on how the changes were cut into batches, on the batches' order, or on a
    batch being merged twice.  Null key parts match each other here, or a
    repeated batch would add their rows again.  Rows of the target whose key
    does not occur in ``latest`` stay as they are, whatever they hold.

    Both sides meet in one key window: every row is shuffled and sorted once,
    and a side that is dealt by key already (a window's result) is not shuffled
    again.  ``latest`` may hold a key several times (``thin_hot_keys`` bounds
    how often).  ``deal`` spreads the rows over tasks in the caller's way: by a
    column that it adds, which a row's key must determine.
    """
    keys, new, first, within = list(spec.keys), "_is_new", "_first", []
    rows = target.withColumn(new, F.lit(False)).unionByName(latest.withColumn(new, F.lit(True)), allowMissingColumns=True)
    if deal is not None:
        rows, place = deal(rows)
        within = [place]
    w = Window.partitionBy(*within, *keys).orderBy(*newest_first(rows, keys, spec.sequence, spec.tie_break, (new, *within)))
    changed = F.max(new).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    wins = (F.col(first) == 1) & F.col(spec.sequence).isNotNull()
    return (rows.select("*", F.row_number().over(w).alias(first), changed.alias("_changed"))
            .where(~F.col("_changed") | wins).select(*_merge_columns(target, latest)))


def live_rows(bronze: DataFrame, spec: C.ChangeFeedSpec, deletes: str = "apply") -> DataFrame:
    """What readers see of a bronze state: without the sequence and, if
    deletes apply, without tombstones."""
    if deletes not in ("apply", "keep"):
        raise ValueError(f"deletes must be 'apply' or 'keep', not {deletes!r}")
    if deletes == "apply":
        bronze = bronze.where(~F.coalesce(F.col(spec.op) == F.lit(C.DELETE_OP), F.lit(False)))
    return bronze.drop(spec.sequence)
