"""Files that tasks write themselves, in the folder all executors share.

A task writes under a name that no other attempt uses and reports the file in
its rows; only files named in the staged list of such rows (the manifest) are
read.  What a lost or repeated attempt left behind is never looked at.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, of a URI or a plain path."""
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    elif path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    elif "://" not in path:
        path = "file://" + path
    return fs.FileSystem.from_uri(path)


def new_file(folder: str, prefix: str, suffix: str) -> str:
    """A name in ``folder`` that no other task attempt uses."""
    store, inner = locate(folder)
    store.create_dir(inner, recursive=True)
    return f"{folder}/{prefix}-{uuid.uuid4().hex}{suffix}"


def open_output(path: str):
    store, inner = locate(path)
    return store.open_output_stream(inner, compression=None)    # never by the file's ending


def open_input(path: str, seek: bool = False):
    store, inner = locate(path)
    return store.open_input_file(inner) if seek else store.open_input_stream(inner, compression=None)


def one_task_each(manifest: DataFrame) -> DataFrame:
    """The manifest with about one file in each partition."""
    return manifest.repartition(max(1, manifest.count()))
