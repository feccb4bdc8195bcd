"""Incremental change-feed ingestion with Structured Streaming.

The file source remembers, in its checkpoint, which files it has processed,
so each run picks up only files that arrived since the last one (a "job
bookmark").  ``trigger(availableNow=True)`` processes everything available
in bounded micro-batches and stops, which makes the job schedulable like a
batch job; ``max_files_per_trigger`` bounds each micro-batch of a large
backlog.  Each micro-batch is merged into the bronze table in
``foreachBatch``.  The bronze table keeps each row's sequence and, as
tombstones, deletes; a change replaces a row only if it is newer
(``changes.merge_newest``).  So the stored state depends on the changes alone:
not on how they were cut into batches, on the order of files, or on a batch
being replayed after a failure.  A batch rewrites only the key buckets it
touches, and its number is committed with the version, so a replay writes
nothing.  ``read_bronze`` gives the live rows.
"""

from __future__ import annotations

import hashlib
import posixpath
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow import config as C
from ledgerflow.operators.changes import (Deal, key_hash, latest_by_key, live_rows, merge_newest,
                                          prepare_changes, state_rows, thin_hot_keys)
from ledgerflow.operators.joins import HOT_SHARE, SKETCH_ITEMS
from ledgerflow.session import durable_base
from ledgerflow.sources.partitioned import BUCKET, Layout, bucketed, merge_buckets, table_state
from ledgerflow.sources.tables import (discard, materialise, read_if_exists, read_table,
                                       read_version_or_empty, write_snapshot)


# Rows of one key up to which a batch is merged without reducing the key first.
HOT_ROWS = 10_000


def read_bronze(spark: SparkSession, path: str, spec: C.ChangeFeedSpec, deletes: str = "apply") -> DataFrame:
    """Live rows of a bronze table: no sequence and, if deletes apply, no
    tombstones."""
    return live_rows(read_table(spark, path), spec, deletes)


def default_checkpoint(spark: SparkSession, source_path: str, target_path: str) -> str:
    """The bookmark of one feed into one table, below the configured
    ``spark.checkpoint.dir``: the same in every application, and its own for
    every pair of full paths."""
    name = posixpath.basename(target_path.rstrip("/")) or "table"
    pair = f"{source_path.rstrip('/')}|{target_path.rstrip('/')}"
    return f"{durable_base(spark)}/bookmarks/{name}-{hashlib.sha256(pair.encode()).hexdigest()[:16]}"


def merge_batch(spark: SparkSession, batch: DataFrame, target_path: str,
                spec: C.ChangeFeedSpec, pseudonymise_columns: Sequence[str] = (),
                secret: Optional[str] = None, partition_by: Optional[Sequence[str]] = None,
                buckets: int = 64, epoch: Optional[tuple[str, int]] = None) -> Optional[str]:
    """Merge one batch of raw changes into the bronze table; returns the new
    version's folder (``None`` for an empty batch, or one merged before).

    The table lies in ``buckets`` folders by a hash of the key, and only the
    buckets of the batch are read and rewritten.  Batch and stored rows are
    shuffled once.  The batch is read several times (for its buckets and hot
    keys, then whole): pass a frame that gives the same rows each time.  ``epoch`` (stream id, batch
    number) is recorded with the version in the same commit: a batch that is
    replayed after it was committed is skipped.  ``partition_by`` keeps a table
    in folders of these columns instead, rewritten as a whole.
    """
    done = table_state(spark, target_path).get("epochs", {})
    if epoch is not None and done.get(epoch[0], -1) >= epoch[1]:
        return None
    if batch.isEmpty():
        return None
    if partition_by:
        latest = prepare_changes(batch, spec, pseudonymise_columns, secret, drop_sequence=False)
        target, base = read_version_or_empty(spark, target_path, latest.schema)
        return write_snapshot(merge_newest(target, latest, spec), target_path, partition_by, base)
    layout, staged = bucketed(spec.keys, buckets), None
    if pseudonymise_columns:
        # The newest change is chosen by the values that came, not by pseudonyms:
        # before the merge, which reads it twice.
        rows = staged = materialise(prepare_changes(batch, spec, pseudonymise_columns, secret, drop_sequence=False))
    else:
        rows = state_rows(batch, spec)
    state = {"epochs": {**done, epoch[0]: epoch[1]}} if epoch else None
    try:
        n, wanted, hot = _survey(rows, layout, spec)

        def combine(old: DataFrame, new: DataFrame, deal: Optional[Deal]) -> DataFrame:
            if staged is None and [c for c in dict.fromkeys((*old.columns, *new.columns)) if c in new.columns] != new.columns:
                # ties are broken by the columns' order in the batch, then by that in the table
                new = latest_by_key(new, spec.keys, spec.sequence, ties="one", tie_break=spec.tie_break, drop_sequence=False)
            elif staged is None:
                new = thin_hot_keys(new, spec, hot)
            return merge_newest(old, new, spec, deal)

        return merge_buckets(spark, target_path, rows, spec.keys, layout, combine, state, (n, wanted))
    finally:
        if staged is not None:
            discard(staged)


def _survey(rows: DataFrame, layout: Layout, spec: C.ChangeFeedSpec) -> tuple[int, set[str], list[int]]:
    """One pass over a batch's keys: its rows, its buckets, and the hashes of
    the keys that hold at least one in ``HOT_SHARE`` of its rows (by a sketch
    merged from one per task; see ``joins.hot_keys``)."""
    hashed = layout.apply(rows).select(BUCKET, key_hash(spec.keys).alias("_hash"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.collect_set(BUCKET).alias("buckets"),
                       F.expr(f"approx_top_k(_hash, {HOT_SHARE}, {SKETCH_ITEMS})").alias("top")).first()
    hot = [t["item"] for t in found["top"] or [] if t["count"] * HOT_SHARE >= found["n"] and t["count"] > HOT_ROWS]
    return found["n"], set(found["buckets"]), hot


def ingest_available_now(spark: SparkSession, source_path: str, schema: T.StructType,
                         target_path: str, spec: C.ChangeFeedSpec,
                         checkpoint: Optional[str] = None,
                         pseudonymise_columns: Sequence[str] = (),
                         secret: Optional[str] = None,
                         partition_by: Optional[Sequence[str]] = None,
                         max_files_per_trigger: Optional[int] = None,
                         buckets: int = 64) -> Optional[StreamingQuery]:
    """Merge every change file not seen before into the bronze table, then stop.
    A source path that does not exist is no data (``None``).

    ``checkpoint`` defaults to ``default_checkpoint``.
    """
    if not spec.keys:
        raise ValueError("a change feed without a primary key cannot be merged")
    if read_if_exists(spark, source_path, schema=schema) is None:
        return None
    if checkpoint is None:
        checkpoint = default_checkpoint(spark, source_path, target_path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # the id of the stream that the checkpoint keeps, not of this run
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_batch(batch.sparkSession, batch, target_path, spec, pseudonymise_columns, secret, partition_by,
                    buckets, (stream_id, epoch_id) if stream_id else None)

    query = (stream.writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
