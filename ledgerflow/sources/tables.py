"""Keyed tables stored as versioned Parquet snapshot directories.

No table format is available, and Spark cannot overwrite a path it is reading,
so every write of a table goes to a new version directory under the table path
(``<path>/v00000001``, ``v00000002``, ...).  A version is written in a folder of
its own and renamed once Spark's output committer has finished it, so a failed
or half-written job never becomes visible.  A writer commits exactly the
version after the one it read: if another writer was faster, the commit fails
(``ConcurrentWrite``) instead of losing the other's rows.  The newest
``KEEP_VERSIONS`` versions stay readable, older ones are removed.  A version is
a snapshot of all rows, or, after a merge by ``sources.partitioned``, the list
of partition folders that hold them; both are read by ``read_table``.

Paths go through Hadoop's FileSystem API, so the same code works on local
disk, HDFS and object stores.
"""

from __future__ import annotations

import re
import time
import uuid
from typing import Optional, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import config as C
from ledgerflow.operators.changes import delete_by_key, upsert

_VERSION = re.compile(r"^v(\d{8})$")
# Committed versions that stay; readers of older ones must have finished.
KEEP_VERSIONS = 10
# Age from which a commit marker is that of a killed writer (a commit is one rename).
CLAIM_SECONDS = 900


class TableNotFound(FileNotFoundError):
    """No committed version exists under the table path."""


class ConcurrentWrite(RuntimeError):
    """Another writer committed a version after the one this writer read."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed version numbers under ``path``, oldest first."""
    fs, root, jvm = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        m = _VERSION.match(status.getPath().getName())
        if m and status.isDirectory() and fs.exists(
                jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version:08d}"


def latest_path(spark: SparkSession, path: str) -> Optional[str]:
    versions = committed_versions(spark, path)
    return version_path(path, versions[-1]) if versions else None


def _load(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A version with its partition columns as the text that was written
    (types are not guessed from folder names, or ``01`` would come back as 1)."""
    from ledgerflow.sources import partitioned

    held = partitioned.read_held(spark, path, version)
    if held is not None:
        return partitioned.load(spark, path, version, held)
    folder = version_path(path, version)
    whole = spark.read.parquet(folder)
    stored = set(spark.read.option("recursiveFileLookup", "true").parquet(folder).columns)
    if stored.issuperset(whole.columns):
        return whole
    text = [f if f.name in stored else T.StructField(f.name, T.StringType()) for f in whole.schema.fields]
    return spark.read.schema(T.StructType(text)).parquet(folder)


def latest_version(spark: SparkSession, path: str) -> int:
    """Newest committed version, 0 for none."""
    return max(committed_versions(spark, path), default=0)


def read_version(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Newest committed snapshot and its version, to be passed to
    ``write_snapshot`` as ``base``."""
    version = latest_version(spark, path)
    if not version:
        raise TableNotFound(path)
    return _load(spark, path, version), version


def read_at(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A committed version by its number."""
    return _load(spark, path, version)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Newest committed snapshot of the table at ``path``."""
    return read_version(spark, path)[0]


def read_version_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, int]:
    """As ``read_version``; an empty frame of ``schema`` and 0 when none exists."""
    try:
        return read_version(spark, path)
    except TableNotFound:
        return spark.createDataFrame([], schema), 0


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest snapshot, or an empty frame of ``schema`` when none exists."""
    return read_version_or_empty(spark, path, schema)[0]


def _claim(fs, claim, jvm) -> bool:
    """Create the marker file ``claim``; False if it exists.  One of several
    writers succeeds if the file system's create without overwrite is atomic
    (HDFS; Hadoop's local one is not, so there it is the JVM's).  A marker older
    than ``CLAIM_SECONDS`` is that of a killed writer and is taken over."""
    if fs.exists(claim):
        age = time.time() - fs.getFileStatus(claim).getModificationTime() / 1000
        if age > CLAIM_SECONDS:
            fs.delete(claim, False)
    if fs.getUri().getScheme() == "file":
        return jvm.java.io.File(fs.makeQualified(claim).toUri().getPath()).createNewFile()
    try:
        fs.create(claim, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def write_snapshot(df: DataFrame, path: str, partition_by: Optional[Sequence[str]] = None,
                   base: Optional[int] = None) -> str:
    """Write ``df`` as the version after ``base`` (the newest committed one if
    not given); returns its directory."""
    spark = df.sparkSession
    base = latest_version(spark, path) if base is None else base
    fs, root, jvm = _fs(spark, path)
    pending = f"{path.rstrip('/')}/_pending-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(pending)
    except BaseException:
        fs.delete(jvm.org.apache.hadoop.fs.Path(pending), True)
        raise
    return commit_version(spark, path, pending, base)


def commit_version(spark: SparkSession, path: str, pending: str, base: int) -> str:
    """Make the finished folder ``pending`` the version after ``base``, or
    delete it and raise ``ConcurrentWrite``; returns the version's folder."""
    fs, _, jvm = _fs(spark, path)
    target = version_path(path, base + 1)
    pending_path, target_path = jvm.org.apache.hadoop.fs.Path(pending), jvm.org.apache.hadoop.fs.Path(target)
    claim = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_claim-v{base + 1:08d}")
    if not _claim(fs, claim, jvm):
        fs.delete(pending_path, True)
        raise ConcurrentWrite(f"{path}: version {base + 1} is being committed by another writer (if that one was killed, its marker lapses after {CLAIM_SECONDS} s)")
    try:        # nobody else commits, or deletes, this version meanwhile
        taken = latest_version(spark, path) != base
        if not taken and fs.exists(target_path):
            fs.delete(target_path, True)        # an uncommitted leftover, never a table
        if taken or not fs.rename(pending_path, target_path):
            fs.delete(pending_path, True)
            raise ConcurrentWrite(f"{path}: version {base + 1} was committed by another writer")
    finally:
        fs.delete(claim, False)
    versions = committed_versions(spark, path)
    if dropped := versions[:-KEEP_VERSIONS]:
        from ledgerflow.sources import partitioned

        partitioned.retire(spark, path, dropped, versions[-KEEP_VERSIONS:])
        for old in dropped:
            fs.delete(jvm.org.apache.hadoop.fs.Path(version_path(path, old)), True)
    return target


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into Parquet in the session's shared folder and
    return a frame reading it back (lineage cut; survives executor loss;
    columns that a later step does not need are not read).  ``discard`` it
    when the job has committed."""
    from ledgerflow.session import shared_base

    path = f"{shared_base(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised frame."""
    path = df.__dict__.get("_staged_path")
    if path:
        fs, p, _ = _fs(df.sparkSession, path)
        fs.delete(p, True)


def upsert_table(spark: SparkSession, path: str, source: DataFrame,
                 keys: Sequence[str] | str,
                 partition_by: Optional[Sequence[str]] = None,
                 materialise_source: bool = True) -> str:
    """Merge ``source`` into the table at ``path`` (created when missing).

    The merge reads its source more than once (insert rows, key set,
    duplicate guard); ``materialise_source`` computes it once first.  An empty
    source leaves an existing table as it is."""
    target, base = read_version_or_empty(spark, path, source.schema)
    if materialise_source:
        source = materialise(source)
    try:
        if base and source.isEmpty():
            return version_path(path, base)
        return write_snapshot(upsert(target, source, keys), path, partition_by, base)
    finally:
        if materialise_source:
            discard(source)


def delete_from_table(spark: SparkSession, path: str, keys_df: DataFrame,
                      keys: Sequence[str] | str,
                      partition_by: Optional[Sequence[str]] = None) -> str:
    target, base = read_version(spark, path)
    return write_snapshot(delete_by_key(target, keys_df, keys), path, partition_by, base)


def read_region_tables(spark: SparkSession, template: str,
                       regions: Sequence[str] = C.REGIONS, fmt: str = "parquet") -> dict[str, DataFrame]:
    """One frame per region from a path template with a ``{region}`` slot
    (filled with the lower-case region code), e.g.
    ``/landing/{region}/operations``.  Feed the
    result to ``plans.silver`` / ``plans.jobs``, which conform and union it."""
    return {r: spark.read.format(fmt).load(template.format(region=r.lower())) for r in regions}


def read_landing_csv(spark: SparkSession, path: str,
                     schema: Optional[T.StructType] = None) -> DataFrame:
    """CSV landing files with a header row.  Every column is text unless a
    ``schema`` is given (guessed types would turn account ``0100`` into 100).
    Empty strings read back as null."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


BAD_LINE = "_bad_line"


def read_landing_split(spark: SparkSession, path: str, schema: Optional[T.StructType] = None,
                       header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV landing files as (good rows, bad lines): a line with too many or too
    few fields, or with a value that is not of its column's type, goes to the
    second frame as it stands (column ``_bad_line`` and the file's name) instead
    of being cut, padded with nulls or dropped.

    Without a ``schema`` every column of the header is text.  Both frames are
    one scan each and parse whole lines (pruned columns would hide bad lines);
    a quote within a quoted field is doubled.
    """
    if schema is None:
        if not header:
            raise ValueError("files without a header need a schema")
        names = spark.read.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    whole = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = (spark.read.schema(whole).option("header", header).option("mode", "PERMISSIVE")
             .option("escape", '"').option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    # always true, but needs every field: a reader that prunes columns would not
    # notice the faults of the others
    read = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in schema.names])) >= 0
    lines = lines.select("*", F.col("_metadata.file_name").alias("_landing_file")).where(read)
    bad = lines.where(F.col(BAD_LINE).isNotNull()).select(F.col("_landing_file").alias("file"), BAD_LINE)
    return lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "_landing_file"), bad


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: Optional[T.StructType] = None) -> Optional[DataFrame]:
    """Frame at ``path``, or ``None`` when the path does not exist.  Only a
    missing path means "no data"; every other read error propagates."""
    from pyspark.errors import AnalysisException

    try:
        reader = spark.read.format(fmt)
        return (reader.schema(schema) if schema is not None else reader).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise
