"""Token ids in fixed-width bit-packed files.

File layout (integers little-endian):

    8 bytes   magic ``LFIDPK01``
    blocks    BLOCK ids each (the last may be shorter), every id in ``bits``
              bits, lowest bit first, each block padded to whole bytes
    docs      Arrow stream: id, n_tokens (one row a document, in order)
    footer    uint64 x 5: bits, ids in a block, ids, place of docs, place of
              the offsets; before it the offsets: uint64 place of each block
    8 bytes   magic

``bits`` is the least width that holds every id of the vocabulary.  Offsets
let a reader seek to the blocks of any id range and unpack them with numpy.

Writing: documents are range-partitioned and sorted by id (ties by the hash of
their text), each task encodes its range and writes files of at most about
``FILE_IDS`` ids.  A file's first id in the whole sequence is the sum over the
files before it, taken over the manifest alone.

Defined results: null text is empty and gives the end id alone; null ids come
first; repeated rows are separate documents next to each other; an empty
table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import new_folder, stage
from .files import new_file, one_task_each, open_input, open_output
from .tokens import encode_batches, encoder

MAGIC = b"LFIDPK01"
BLOCK = 1 << 16
#: Ids after which a task begins another file.
FILE_IDS = 1 << 25


def width(vocab_size: int) -> int:
    """Bits that the largest id of a vocabulary needs."""
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flat = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(flat.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (flat.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.uint32)


class Writer:
    """One file; ``add`` takes whole documents in order."""

    def __init__(self, path: str, bits: int, block: int = BLOCK):
        self.path, self.bits, self.block = path, bits, block
        self.out = open_output(path)
        self.out.write(MAGIC)
        self.place, self.offsets = len(MAGIC), []
        self.pending, self.held = [], 0
        self.names, self.lengths, self.n_ids = [], [], 0

    def add(self, names: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents' names, their ids in one array, their lengths."""
        self.names += names
        self.lengths.append(lengths)
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            whole = np.concatenate(self.pending)
            full = len(whole) // self.block * self.block
            for at in range(0, full, self.block):
                self._write(whole[at:at + self.block])
            self.pending, self.held = [whole[full:]], len(whole) - full

    def _write(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.bits)
        self.offsets.append(self.place)
        self.out.write(data)
        self.place += len(data)

    def close(self, id_type: pa.DataType) -> tuple[int, int]:
        """Finish the file: (documents, ids)."""
        if self.held:
            self._write(np.concatenate(self.pending))
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        docs = pa.table({"id": pa.array(self.names, type=id_type), "n_tokens": pa.array(lengths.astype(np.int64))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_table(docs)
        data = sink.getvalue()
        self.out.write(data)
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.out.write(np.array([self.bits, self.block, self.n_ids, self.place, self.place + data.size], dtype="<u8").tobytes())
        self.out.write(MAGIC)
        self.out.close()
        return len(self.names), self.n_ids


class Reader:
    """Random access to one file."""

    def __init__(self, path: str):
        self.file = open_input(path, seek=True)
        size = self.file.size()
        self.file.seek(size - 48)
        tail = self.file.read(48)
        self.file.seek(0)
        if tail[40:] != MAGIC or self.file.read(8) != MAGIC:
            raise ValueError(f"{path}: not a file of packed ids")
        self.bits, self.block, self.n_ids, self.docs_at, self.offsets_at = (int(x) for x in np.frombuffer(tail[:40], "<u8"))
        self.file.seek(self.offsets_at)
        self.offsets = np.frombuffer(self.file.read(size - 48 - self.offsets_at), "<u8")

    def docs(self) -> pa.Table:
        self.file.seek(self.docs_at)
        return pa.ipc.open_stream(self.file.read(self.offsets_at - self.docs_at)).read_all()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of this file, read from their blocks only."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.docs_at
        begin = int(self.offsets[first])
        self.file.seek(begin)
        data = self.file.read(end - begin)
        parts = []
        for b in range(first, last + 1):
            at = int(self.offsets[b]) - begin
            count = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack_bits(data[at:at + (count * self.bits + 7) // 8], self.bits, count))
        whole = np.concatenate(parts)
        return whole[start - first * self.block:stop - first * self.block]


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, id_col: str = "doc_id",
              text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents' ids in ascending id order; the manifest: file,
    n_docs, n_ids, start (ids in all files before it)."""
    folder = folder or new_folder(docs.sparkSession, "ids")
    mark = F.xxhash64("text")
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange("id", mark).sortWithinPartitions("id", mark))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bits = width(max(encoder(tokenizer).vocab_size, end_id + 1))
        writer, number, id_type = None, 0, None

        def done() -> pa.RecordBatch:
            n_docs, n_ids = writer.close(id_type)
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number]), pa.array([writer.path]), pa.array([n_docs]), pa.array([n_ids])],
                                              names=["part", "number", "file", "n_docs", "n_ids"])

        for rows, ids, offsets in encode_batches(batches, "text", tokenizer):
            id_type = rows.column("id").type
            ends = offsets[1:]
            if writer is None:
                writer = Writer(new_file(folder, f"part-{part:06d}-{number:04d}", ".ids"), bits)
            writer.add(rows.column("id").to_pylist(), np.insert(ids, ends, np.uint32(end_id)), np.diff(offsets) + 1)
            if writer.n_ids >= file_ids:
                yield done()
                writer, number = None, number + 1
        if writer is not None:
            yield done()

    files = stage(ordered.mapInArrow(write, "part long, number long, file string, n_docs long, n_ids long"), "id-files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def read_ids(spark: SparkSession, manifest: DataFrame, id_type: str = "long", id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start, n_tokens, ids (binary,
    little-endian unsigned 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["file"])
                docs = reader.docs()
                ends = np.cumsum(docs.column("n_tokens").to_numpy())
                first, count = 0, len(ends)
                while first < count:      # documents of about a million ids at a time
                    base = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, base + (1 << 20), side="right")))
                    ids = reader.ids(base, int(ends[last - 1])).astype("<u4")
                    bounds = np.concatenate(([base], ends[first:last])) - base
                    data = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("id").slice(first, last - first).combine_chunks(), pa.array(row["start"] + base + bounds[:-1]),
                         pa.array(np.diff(bounds)), data], names=[id_col, "start", "n_tokens", "ids"])
                    first = last

    return one_task_each(manifest).mapInArrow(read, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")
