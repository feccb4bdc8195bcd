"""Sum-of-squares online packing of documents into token windows.

Documents arrive in the order of their partition; each is placed at once.
``levels[h]`` counts the open windows filled to h tokens.  A document of s
tokens goes to the fill level h (0: a new window) that makes the sum of
``levels[h] ** 2`` over all partial levels smallest, ties to the fullest
window (Csirik et al., "On the Sum-of-Squares Algorithm for Bin Packing").
Documents longer than a window first fill windows of their own.

Each task packs its own rows: no shuffle, no sort, and memory for at most
``MAX_OPEN`` open windows.  When that many are open, and at the end of a
partition, the emptiest windows are poured into the gaps of the fullest, cut
where a gap ends, so that one window a partition is left part-filled.  The
input order of a partition is that of its files, so a repeated task packs
alike.

Defined results: null text counts as empty and gives the end id alone; null
or repeated ids are packed row by row; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tokens import encode_batches

#: Open windows a task holds before it pours the emptiest into the fullest.
MAX_OPEN = 2048


class Packer:
    """Online packing of one partition; ``done`` holds finished windows."""

    def __init__(self, window: int, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0
        self.done: list[list] = []

    def best_level(self, size: int) -> int:
        """The level whose choice makes the sum of squared counts smallest."""
        top = self.window - size
        counts = self.levels
        change = 2 * (counts[size:self.window + 1] - counts[:top + 1]) + 2
        change[top] = 1 - 2 * counts[top]          # the window becomes full
        usable = counts[:top + 1] > 0
        usable[0] = True
        change[0] = 2 * counts[size] + 1 if top else 0
        change[~usable] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def add(self, doc: int, ids: np.ndarray) -> None:
        at = 0
        while len(ids) - at >= self.window:
            self.done.append([(doc, at, ids[at:at + self.window])])
            at += self.window
        size = len(ids) - at
        if not size:
            return
        if at:
            ids, start = ids[at:].copy(), at             # the filled windows' ids need not be held
        else:
            start = 0
        level = self.best_level(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append((doc, start, ids))
        if level + size == self.window:
            self.done.append(pieces)
        else:
            self.open[level + size].append(pieces)
            self.levels[level + size] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                self.pour()

    def pour(self) -> None:
        """Fill the fullest open windows from the emptiest; one may stay."""
        windows = [(level, pieces) for level in sorted(self.open) for pieces in self.open[level]]
        self.open.clear()
        self.levels[:] = 0
        self.n_open = 0
        low, high = 0, len(windows) - 1
        while low < high:
            fill, into = windows[high]
            left, source = windows[low]
            gap = self.window - fill
            while gap and source:
                doc, start, ids = source.pop()
                take = min(gap, len(ids))
                if take < len(ids):
                    source.append((doc, start, ids[:len(ids) - take]))
                into.append((doc, start + len(ids) - take, ids[len(ids) - take:]))
                gap, left = gap - take, left - take
            windows[high], windows[low] = (self.window - gap, into), (left, source)
            if not gap:
                self.done.append(into)
                high -= 1
            if not source:
                low += 1
        if low == high and windows[low][1]:
            level, pieces = windows[low]
            self.open[level].append(pieces)
            self.levels[level] += 1
            self.n_open = 1

    def finish(self) -> None:
        self.pour()
        self.done += [pieces for group in self.open.values() for pieces in group]
        self.open.clear()


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True, memory: Mapping[str, int] | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, ids (array of int).  ``memory`` sets
    the bounds of ``tokens.encode_batches``; the ids do not depend on them."""
    bounds_of = dict(memory or {})
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, `offset` long" + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, names, totals = Packer(window), {}, {}
        sequence = TaskContext.get().partitionId() << 40
        number = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for pieces in packer.done:
                offset = 0
                for doc, start, ids in pieces:
                    rows.append((names[doc], start, len(ids), zlib.crc32(ids), totals[doc], sequence, offset, ids))
                    offset += len(ids)
                sequence += 1
            packer.done = []
            held = {doc for group in packer.open.values() for pieces in group for doc, _, _ in pieces}
            for doc in [d for d in names if d not in held]:
                del names[doc], totals[doc]
            columns = list(zip(*rows)) or [()] * 8
            arrays = [pa.array(columns[0], type=id_arrow)] + [pa.array(c, type=pa.int64()) for c in columns[1:7]]
            if with_ids:
                flat = np.concatenate(columns[7]) if rows else np.zeros(0, np.uint32)
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in columns[7]]))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32))))
            return pa.RecordBatch.from_arrays(arrays, names=labels)

        labels = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        id_arrow = None
        for part, ids, offsets in encode_batches(batches, text_col, tokenizer, **bounds_of):
            id_arrow = part.column(id_col).type
            for i, name in enumerate(part.column(id_col).to_pylist()):
                own = np.append(ids[offsets[i]:offsets[i + 1]], np.uint32(end_id)).astype("<u4")
                names[number], totals[number] = name, len(own)
                packer.add(number, own)
                number += 1
            yield flush()
        if id_arrow is not None:
            packer.finish()
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
