"""Shared folder, staged tables and small helpers of the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
_MADE: ContextVar[list[str] | None] = ContextVar("made folders", default=None)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each
    application, so that a query also runs where the package is not installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerflow-py-"), "ledgerflow.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("ledgerflow", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a scratch
    folder; a cluster session without it raises.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="ledgerflow-llm-")
    return _LOCAL[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _MADE.get() is not None:
        _MADE.get().append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later
    steps neither recompute it nor depend on executors that computed it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete, on leaving, every folder that operators made within, except those
    of staged frames put in the list: frames computed here that read another
    folder must be staged before the end."""
    kept: list[DataFrame] = []
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield kept
    finally:
        _MADE.reset(token)
        stay = {getattr(df, "_staged_path", None) for df in kept}
        for path in made:
            if path not in stay:
                _delete(spark, path)
        if _MADE.get() is not None:
            _MADE.get().extend(p for p in made if p in stay)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the package is shipped for the operators that follow."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
