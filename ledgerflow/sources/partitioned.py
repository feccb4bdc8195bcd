"""Merges that rewrite only the partitions they touch.

A merged version of a table (see ``sources.tables``) holds no rows itself.  Its
file ``_held.json`` names, for every partition folder, the writes that hold its
rows::

    <path>/v00000007/_held.json                       folder -> writes
    <path>/data/write=<id>/<partition folders>/*.parquet

A merge finds the folders that hold rows of the source's keys, rewrites these
into a folder of its own write, adds the source's other rows as new files, and
commits a version that names the new write for them.  Files of all other
folders keep their names and times, and older versions stay readable.  Versions
are committed as in ``sources.tables``: atomically, one writer per version.

A ``Layout`` says by which columns a table is spread over folders: columns of
the table, and columns derived from a row that readers do not see.  ``dated``
spreads by the day or month of a timestamp as it is now, so that bounds on it
skip folders (see ``operators.promote``); ``bucketed`` by a hash of the key, so
that a batch of changes touches its buckets only.

Finding the touched folders reads the key columns alone: first the range and a
Bloom filter of the source's keys drop rows in the scan, then the few left are
joined with the keys exactly.  No row of an untouched folder is shuffled.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from typing import Callable, Mapping, Optional, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.functions.dates import parse_timestamp
from ledgerflow.operators.changes import Deal, all_not_null, delete_by_key, upsert
from ledgerflow.operators.joins import estimated_bytes
from ledgerflow.sources import tables as TB

BUCKET = "bucket"
_WRITE = "write"
_HELD = "_held.json"
_NULL = "__HIVE_DEFAULT_PARTITION__"
#: Writes of one folder from which the next merge rewrites it into one.
MAX_WRITES = 8
#: Cells of a key filter: at least, and at most (one byte each).
MIN_CELLS, MAX_CELLS = 1 << 12, 1 << 20
#: Keys beyond which so many cells let most rows through: the filter is the ranges alone.
MAX_KEYS = MAX_CELLS // 2
#: What one task of a bucket merge takes at most: rows of the batch, bytes of stored files.
TASK_ROWS, TASK_BYTES = 500_000, 16 << 20
_PLACE = "_place"


# --- layouts ----------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """Partition columns in folder order; ``derived`` computes those that are
    not columns of the table.  ``name`` tells layouts apart."""

    name: str
    columns: tuple[str, ...]
    derived: Mapping[str, Callable[[DataFrame], Column]] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: make(df) for c, make in self.derived.items()}) if self.derived else df


def dated(column: str, unit: str = "day") -> Layout:
    """By the day (or month) of ``column``, whatever date parts a row stores:
    a row whose timestamp changes moves to another folder, so a bound on the
    timestamp is a bound on the folder."""
    def period(df: DataFrame) -> Column:
        return F.date_trunc(unit, parse_timestamp(df, column)).cast("date").cast("string")

    return Layout(f"dated:{column}:{unit}", (C.PERIODS[unit],), {C.PERIODS[unit]: period})


def bucketed(keys: Sequence[str], buckets: int = 64) -> Layout:
    """By a hash of the key (of its text, so that a wider integer type of a
    later batch lands in the same bucket); null key parts are hashed too."""
    def bucket(df: DataFrame) -> Column:
        text = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
        return F.pmod(F.xxhash64(*text), F.lit(buckets)).cast("string")

    return Layout(f"bucketed:{','.join(keys)}:{buckets}", (BUCKET,), {BUCKET: bucket})


# --- versions ----------------------------------------------------------------

@dataclass(frozen=True)
class Held:
    """What a merged version holds: partition folder -> writes, in order."""

    layout: str
    columns: tuple[str, ...]
    schema: T.StructType
    folders: Mapping[str, tuple[str, ...]]
    state: Mapping[str, object]

    def values(self, folder: str) -> tuple[Optional[str], ...]:
        found = [part.partition("=")[2] for part in folder.split("/")]
        return tuple(None if v == _NULL else unquote(v) for v in found)


def read_held(spark: SparkSession, path: str, version: int) -> Optional[Held]:
    """The list of a merged version; None for a plain snapshot."""
    fs, file, jvm = TB._fs(spark, f"{TB.version_path(path, version)}/{_HELD}")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        raw = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Held(raw["layout"], tuple(raw["columns"]), T.StructType.fromJson(raw["schema"]),
                {f: tuple(w) for f, w in raw["folders"].items()}, raw["state"])


def _frame(spark: SparkSession, path: str, held: Held, folders: Optional[Sequence[str]] = None) -> DataFrame:
    """Rows of some folders (default all), derived partition columns included."""
    hidden = [c for c in held.columns if c not in held.schema.names]
    whole = T.StructType([*held.schema.fields, *[T.StructField(c, T.StringType()) for c in (*hidden, _WRITE)]])
    names = [*held.schema.names, *hidden]
    paths = [f"{path.rstrip('/')}/data/{_WRITE}={w}/{f}" for f in (held.folders if folders is None else folders)
             for w in held.folders[f]]
    if not paths:
        return spark.createDataFrame([], whole).select(*names)
    return (spark.read.schema(whole).option("basePath", f"{path.rstrip('/')}/data").parquet(*paths).select(*names))


def load(spark: SparkSession, path: str, version: int, held: Held, derived: bool = False) -> DataFrame:
    """All rows of a merged version; ``derived`` keeps the layout's own columns
    (for predicates on them)."""
    out = _frame(spark, path, held)
    return out if derived else out.select(*held.schema.names)


def read_with_layout(spark: SparkSession, path: str) -> DataFrame:
    """Newest version with its derived partition columns, if it has any."""
    version = TB.latest_version(spark, path)
    if not version:
        raise TB.TableNotFound(path)
    held = read_held(spark, path, version)
    return load(spark, path, version, held, True) if held else TB.read_table(spark, path)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ``dated`` table that decide its newest timestamp: those of
    its newest folder, found in the version's list without reading a row.

    Empty only if the table is.  Rows without a timestamp count where there are
    no others.  A zoned timestamp may lie a day off (the zone of the session
    that wrote it), so folders that reach into the day before are read too.
    Tables of other layouts are read whole."""
    version = TB.latest_version(spark, path)
    if not version:
        raise TB.TableNotFound(path)
    held = read_held(spark, path, version)
    if held is None or not held.layout.startswith("dated:"):
        return TB.read_table(spark, path)
    column, _, unit = held.layout.removeprefix("dated:").rpartition(":")
    periods = {f: held.values(f)[0] for f in held.folders}
    dates = [date.fromisoformat(p) for p in periods.values() if p is not None]
    if not dates:
        return load(spark, path, version, held)
    zoned = isinstance(held.schema[column].dataType, T.TimestampType)
    first = max(dates) - timedelta(days=1 if zoned else 0)
    first = first.replace(day=1) if unit == "month" else first
    wanted = [f for f, p in periods.items() if p is not None and date.fromisoformat(p) >= first]
    return _frame(spark, path, held, wanted).select(*held.schema.names)


def table_state(spark: SparkSession, path: str) -> dict:
    """What the newest version's writer recorded with it (empty for none)."""
    version = TB.latest_version(spark, path)
    held = read_held(spark, path, version) if version else None
    return dict(held.state) if held else {}


# --- key filter --------------------------------------------------------------

def key_filter(keys_df: DataFrame, keys: Sequence[str]) -> Optional[Column]:
    """A predicate on the key columns that holds for every row whose key is in
    ``keys_df`` and for few others; None if ``keys_df`` has no complete key.

    Ranges of the key columns (pushed to the scan: whole row groups are
    skipped) and a Bloom filter of two hashes.  Only the ranges and at most
    ``MAX_CELLS`` cells come to the driver; beyond some 100,000 keys the filter
    lets more rows through, and beyond ``MAX_KEYS`` it is left out.
    """
    doomed = keys_df.where(all_not_null(keys)).select(*keys)
    found = doomed.agg(F.count("*").alias("n"), *[f(k).alias(f"{a}{i}") for i, k in enumerate(keys) for f, a in ((F.min, "l"), (F.max, "h"))]).first()
    if not found["n"]:
        return None
    types = dict(doomed.dtypes)

    def literal(value, key: str) -> Column:
        return F.lit(value).cast(types[key])

    ranges = [(F.col(k) >= literal(found[f"l{i}"], k)) & (F.col(k) <= literal(found[f"h{i}"], k)) for i, k in enumerate(keys)]
    if found["n"] > MAX_KEYS:
        return reduce(lambda a, b: a & b, ranges)
    cells = min(MAX_CELLS, max(MIN_CELLS, 1 << math.ceil(math.log2(16 * found["n"]))))

    def places() -> list[Column]:
        return [F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(cells)).cast("int") for seed in (1, 2)]

    held = bytearray(cells)
    for row in doomed.select(F.explode(F.array(*places())).alias("p")).distinct().collect():
        held[row["p"]] = 1
    bits = F.lit(bytes(held))
    tests = [F.substring(bits, p + 1, F.lit(1)) == F.lit(b"\x01") for p in places()]
    return reduce(lambda a, b: a & b, [*ranges, *tests])


def rows_of_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (a left semi join), the
    rows that cannot match dropped in the scan by ``key_filter``."""
    keys = list(keys)
    only = keys_df.where(all_not_null(keys)).select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys]).distinct()
    wanted = key_filter(only, keys)
    if wanted is None:
        return df.where(F.lit(False))
    return df.where(wanted).join(only, keys, "left_semi").select(*df.columns)


def touched_folders(spark: SparkSession, path: str, held: Held, keys_df: DataFrame, keys: Sequence[str]) -> set[str]:
    """Folders that hold a row whose key is in ``keys_df``."""
    by_value = {held.values(f): f for f in held.folders}
    hits = rows_of_keys(_frame(spark, path, held), keys_df, keys).select(*held.columns).distinct()
    return {by_value[tuple(None if v is None else str(v) for v in row)] for row in hits.collect()}


# --- writing -----------------------------------------------------------------

def _written(fs, root, depth: int) -> list[str]:
    """Partition folders below ``root``."""
    names = [""]
    for _ in range(depth):
        below = []
        for name in names:
            at = root if not name else root.suffix("/" + name)
            below += [f"{name}/{s.getPath().getName()}".lstrip("/") for s in fs.listStatus(at)
                      if s.isDirectory() and "=" in s.getPath().getName()]
        names = below
    return names


def _commit(spark: SparkSession, path: str, held: Held, base: int) -> str:
    fs, pending, jvm = TB._fs(spark, f"{path.rstrip('/')}/_pending-{uuid.uuid4().hex}")
    raw = {"layout": held.layout, "columns": held.columns, "schema": json.loads(held.schema.json()),
           "folders": held.folders, "state": held.state}
    for name, text in ((_HELD, json.dumps(raw)), ("_SUCCESS", "")):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(pending, name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
    return TB.commit_version(spark, path, str(pending), base)


def _write(spark: SparkSession, path: str, df: DataFrame, layout: Layout, dealt: bool = False) -> tuple[str, list[str]]:
    """Write rows below a new write id: (id, partition folders).  ``dealt``: the
    rows of a folder lie in few tasks already."""
    write = uuid.uuid4().hex
    root = f"{path.rstrip('/')}/data/{_WRITE}={write}"
    fs, folder, _ = TB._fs(spark, root)
    spread = layout.apply(df)
    if not dealt:
        spread = spread.hint("rebalance", *[F.col(c) for c in layout.columns])
    try:
        spread.write.mode("errorifexists").partitionBy(*layout.columns).parquet(root)
        return write, _written(fs, folder, len(layout.columns))
    except BaseException:
        fs.delete(folder, True)
        raise


def retire(spark: SparkSession, path: str, versions: Sequence[int], kept: Sequence[int]) -> None:
    """Delete the folders that only the versions to be dropped name."""
    fs, _, jvm = TB._fs(spark, path)

    def named(version: int) -> set[tuple[str, str]]:
        held = read_held(spark, path, version)
        return {(w, f) for f, writes in held.folders.items() for w in writes} if held else set()

    gone = set().union(*map(named, versions))
    if not gone:
        return
    for w, f in gone - set().union(*map(named, kept)):
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/data/{_WRITE}={w}/{f}"), True)


Combine = Callable[[DataFrame, DataFrame], DataFrame]


def merge(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], layout: Layout, combine: Combine,
          state: Optional[Mapping[str, object]] = None, touched: Optional[Callable[[Held], set[str]]] = None,
          dealt: bool = False) -> str:
    """Commit the version that ``combine(old rows, source)`` makes of the table.

    ``combine`` gets the rows of the touched folders only and returns what
    these rows and the source become; it must leave rows of other keys as they
    are.  ``source`` is read several times: pass a materialised frame.
    ``state`` is recorded with the version (missing entries are kept).  A table
    of another layout, or a plain snapshot, is rewritten once as a whole.
    ``dealt`` says that ``combine`` deals its rows by folder, so that the write
    need not shuffle them.
    """
    base = TB.latest_version(spark, path)
    held = read_held(spark, path, base) if base else None
    if held is None or held.layout != layout.name:
        old = TB.read_table(spark, path) if base else spark.createDataFrame([], source.schema)
        stay: dict[str, tuple[str, ...]] = {}
    else:
        hit = touched(held) if touched else touched_folders(spark, path, held, source, keys)
        hit |= {f for f, writes in held.folders.items() if len(writes) >= MAX_WRITES}
        old = _frame(spark, path, held, sorted(hit)).select(*held.schema.names)
        stay = {f: w for f, w in held.folders.items() if f not in hit}
    rows = combine(old, source)
    schema = rows.schema
    if held is not None and stay:
        stored = {f.name: f.dataType for f in held.schema.fields}
        changed = [f.name for f in schema.fields if f.name in stored and stored[f.name] != f.dataType]
        if changed or set(stored) - set(schema.names):
            raise ValueError(f"{path}: columns {changed or sorted(set(stored) - set(schema.names))} would change type or vanish")
    write, folders = _write(spark, path, rows, layout, dealt)
    if touched and set(folders) & set(stay):        # a key could lie in two writes of its folder
        fs, folder, _ = TB._fs(spark, f"{path.rstrip('/')}/data/{_WRITE}={write}")
        fs.delete(folder, True)
        raise ValueError(f"{path}: the source gave other rows when it was read again")
    now = {**stay, **{f: (*stay.get(f, ()), write) for f in folders}}
    known = dict(held.state) if held else {}
    try:
        return _commit(spark, path, Held(layout.name, layout.columns, schema, now, {**known, **(state or {})}), base)
    except TB.ConcurrentWrite:
        fs, folder, _ = TB._fs(spark, f"{path.rstrip('/')}/data/{_WRITE}={write}")
        fs.delete(folder, True)
        raise


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], layout: Layout,
                      state: Optional[Mapping[str, object]] = None) -> str:
    """``changes.upsert`` of ``source`` into the table at ``path`` (created
    when missing), rewriting only the folders that hold one of its keys."""
    return merge(spark, path, source, keys, layout, lambda old, new: upsert(old, new, keys), state)


def delete_from_partitions(spark: SparkSession, path: str, keys_df: DataFrame, keys: Sequence[str], layout: Layout) -> str:
    """``changes.delete_by_key``, rewriting only the folders that hold one of
    the keys; a folder that keeps no row is dropped."""
    if not TB.latest_version(spark, path):
        raise TB.TableNotFound(path)
    return merge(spark, path, keys_df, keys, layout, lambda old, gone: delete_by_key(old, gone, keys))


def merge_buckets(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], layout: Layout,
                  combine: Callable[[DataFrame, DataFrame, Optional[Deal]], DataFrame],
                  state: Optional[Mapping[str, object]] = None, found: Optional[tuple[int, set[str]]] = None) -> str:
    """``merge`` into a ``bucketed`` table: the source's own buckets are the
    touched ones (null key parts included), so the table is not searched.

    ``found`` is what ``rows_and_buckets`` says of the source, if known.
    ``combine`` also gets a function that deals rows over tasks: every task has
    rows of one bucket, and a bucket with many rows has several tasks, by
    another hash of the key.  So the one shuffle in which keys meet is also the
    one by which the buckets are written.
    """
    n, wanted = found if found is not None else rows_and_buckets(source, layout)
    buckets = int(layout.name.rpartition(":")[2])

    def own(held: Held) -> set[str]:
        return {f for f in held.folders if held.values(f)[0] in wanted}

    def whole(old: DataFrame, new: DataFrame) -> DataFrame:
        stored = estimated_bytes(old)
        stored = 0 if stored >= 1 << 60 else stored         # no estimate: an empty table
        cells = max(1, math.ceil(max(n / TASK_ROWS, stored / TASK_BYTES) / max(1, len(wanted))))

        def deal(rows: DataFrame) -> tuple[DataFrame, str]:
            cell = F.pmod(F.xxhash64(F.lit(1), *[F.col(k).cast("string") for k in keys]), F.lit(cells))
            placed = layout.apply(rows).withColumn(_PLACE, (F.col(BUCKET).cast("int") * cells + cell).cast("int"))
            return placed.drop(BUCKET).repartitionById(buckets * cells, F.col(_PLACE)), _PLACE

        return combine(old, new, deal if dealt else None)

    # the text of a float tells 0.0 from -0.0, which are one key: such keys meet by value
    dealt = not any(t in source.schema[k].dataType.simpleString() for k in keys for t in ("float", "double"))
    return merge(spark, path, source, keys, layout, whole, state, own, dealt)


def rows_and_buckets(source: DataFrame, layout: Layout) -> tuple[int, set[str]]:
    """How many rows a source of a ``bucketed`` table has, and in which buckets."""
    n, found = layout.apply(source).agg(F.count(F.lit(1)), F.collect_set(BUCKET)).first()
    return n, set(found)
