"""Embedding near-duplicates through spherical-cap filters.

Equal vectors of a label are one node with a count.  The filters are the
directions of random product codes: after a random rotation a vector is cut
into two blocks (three from ``THREE_BLOCKS`` nodes on); a direction takes one
of ``code`` random unit vectors in each, so many that the directions grow in
proportion to the nodes and buckets stay small.  A vector passes all
filters whose direction it exceeds ``alpha`` with; ``list_decode`` finds them
block by block, without trying them all.  ``alpha`` lets a random vector pass
``FILTERS`` filters of a code on average.  The number a vector passes varies,
so several independent codes are used (``ROTATIONS``): measured on random
pairs at cosine 0.98, one code of two blocks misses 9 to 13 % of them, two
about 1 %, four none of 1,000; of three blocks one misses 31 to 41 %, four 1 to
2 %, eight none of 1,000 (for 262,145 and for a billion nodes).

Nodes join on (label, filter); filters that only one node passes are dropped
before any vector is moved, and candidates are verified by their cosine in
double precision.  A pair that meets in several filters is verified and counted in
the smallest one it shares, so counts add up without listing pairs; a row
carries only the shared filters below its own, all that this needs.  A task sends
on, for each node, its count and its root in a spanning forest.  A bucket
larger than ``BUCKET`` nodes is cut into (block, block) tasks, all of which
run; small buckets share tasks of about ``TASK_BYTES``.

Defined results: unusable vectors (null, zero, or with null or non-finite
components) and rows without a label have no links and are components of
their own; vectors of different lengths do not link; repeated rows link with
each other; null ids link but name no component unless it has no other id; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stage
from .components import components, forest
from .vectors import cosine, dtype_of, matrices, unit, usable

#: Independent codes, by blocks.
ROTATIONS = {2: 4, 3: 8}
FILTERS = 18
BUCKET = 2048
TASK_BYTES = 16 << 20
THREE_BLOCKS = 1 << 18
#: Buckets up to this size are compared pair by pair, larger ones by blocks.
SMALL = 24
SEED = 8


def code_size(nodes: int) -> tuple[int, int]:
    """(blocks, code vectors in a block): about 16 directions a node."""
    if nodes <= THREE_BLOCKS:
        return 2, int(max(64, 2 ** int(np.ceil(np.log2(max(1, 16 * nodes)) / 2))))
    return 3, int(np.ceil(np.cbrt(16 * nodes)))


@lru_cache(maxsize=16)
def _code(dim: int, size: tuple[int, int], rotation_no: int) -> tuple[np.ndarray, list[np.ndarray], list[slice], float]:
    """Rotation, code vectors by block, the blocks, and alpha: the value that
    random vectors exceed in ``FILTERS`` directions on average."""
    rng = np.random.default_rng([SEED, dim, rotation_no])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    cuts = np.linspace(0, dim, min(size[0], dim) + 1).astype(int)
    blocks = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
    codes = []
    for block in blocks:
        c = rng.standard_normal((size[1], block.stop - block.start))
        codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(len(blocks)))

    def top(values: np.ndarray) -> np.ndarray:
        kept = min(len(values), 20 * FILTERS)
        return np.partition(values, len(values) - kept)[len(values) - kept:]

    best, probes = [], unit(rng.standard_normal((32, dim))) @ rotation
    for probe in probes:
        sums = np.zeros(1)   # the largest sums come from the largest parts
        for block, c in zip(blocks, codes):
            sums = top((sums[:, None] + top(c @ probe[block])).ravel())
        best.append(sums)
    every = np.sort(np.concatenate(best))
    return rotation, codes, blocks, float(every[-min(len(every), FILTERS * len(probes))])


def list_decode(x: np.ndarray, size: tuple[int, int]) -> list[np.ndarray]:
    """For each unit vector, the sorted numbers of all filters that it exceeds
    alpha with (and, for each code, always that of the nearest direction)."""
    found: list[list[np.ndarray]] = [[] for _ in range(len(x))]
    for number in range(ROTATIONS[size[0]]):
        rotation, codes, blocks, alpha = _code(x.shape[1], size, number)
        turned = x @ rotation
        parts = [turned[:, block] @ c.T for block, c in zip(blocks, codes)]
        orders = [np.argsort(-p, axis=1) for p in parts]
        tops = [p.max(axis=1) for p in parts]
        for i in range(len(x)):
            sums, numbers = np.zeros(1), np.full(1, number, dtype=np.int64)
            for k, part in enumerate(parts):
                ranked = part[i][orders[k][i]]
                # code vectors that can still reach alpha after each prefix
                counts = np.searchsorted(-ranked, sums + sum(t[i] for t in tops[k + 1:]) - alpha, side="right")
                if not counts.any():
                    counts[sums.argmax()] = 1
                prefix = np.repeat(np.arange(len(sums)), counts)
                place = np.arange(len(prefix)) - np.repeat(np.cumsum(counts) - counts, counts)
                sums, numbers = sums[prefix] + ranked[place], numbers[prefix] * size[1] + orders[k][i][place]
            found[i].append(numbers)
    return [np.sort(np.concatenate(f)) for f in found]


def _with_filters(nodes: DataFrame, size: tuple[int, int]) -> DataFrame:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = np.zeros(batch.num_rows, dtype=np.int32)
                lists: list = [None] * batch.num_rows
                for rows, x in matrices(batch.column("vector")):
                    dims[rows] = x.shape[1]
                    for r, found in zip(rows.tolist(), list_decode(unit(x), size)):
                        lists[r] = found
                yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(dims), pa.array(lists, pa.list_(pa.int64()))],
                                                 names=batch.schema.names + ["dim", "filters"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(decode, f"{fields}, dim int, filters array<long>")


class _Lists:
    """The smaller shared filters of each row, as one flat array."""

    def __init__(self, lists: list[np.ndarray]):
        self.size = np.array([len(f) for f in lists], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(lists).astype(np.int64)

    def _of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, filter) of every entry of these rows."""
        size = self.size[rows]
        owner = np.repeat(np.arange(len(rows)), size)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        return owner, self.flat[self.start[rows][owner] + within]

    def meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether row a[i] and row b[i] have a filter in common."""
        found = np.zeros(len(a), dtype=bool)
        for k in range(0, len(a), 2000):
            (pa_, fa), (pb, fb) = self._of(a[k:k + 2000]), self._of(b[k:k + 2000])
            names, place = np.unique(np.concatenate((fa, fb)), return_inverse=True)
            keys = np.sort(np.concatenate((pa_, pb)) * max(1, len(names)) + place)
            found[k + keys[1:][keys[1:] == keys[:-1]] // max(1, len(names))] = True
        return found

    def meet_all(self, start: int, end: int) -> np.ndarray:
        """``meet`` of every two rows of a bucket: products of membership
        matrices, a few thousand filters at a time."""
        n = end - start
        row, names = self._of(np.arange(start, end))
        known, counts = np.unique(names, return_counts=True)
        known = known[counts > 1]
        shared = np.zeros((n, n), dtype=bool)
        for at in range(0, len(known), 4096):
            part = known[at:at + 4096]
            place = np.minimum(np.searchsorted(part, names), len(part) - 1)
            here = part[place] == names
            member = np.zeros((n, len(part)), dtype=np.float32)
            member[row[here], place[here]] = 1.0
            for top in range(0, n, 256):
                shared[top:top + 256] |= member[top:top + 256] @ member.T > 0
        return shared


def _pairs(bucket: np.ndarray, own: np.ndarray, same: np.ndarray, x: np.ndarray, u: np.ndarray, before: _Lists,
           threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that link and that their bucket owns (no smaller filter
    holds both), so every link is found in one bucket only and verified once.
    Rows are sorted by bucket; where ``same`` is False only pairs of different
    blocks are looked at."""
    starts = np.nonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))[0]
    ends = np.append(starts[1:], len(bucket))

    def verified(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(0, len(a), 50_000):
            p, q = a[k:k + 50_000], b[k:k + 50_000]
            exact = cosine(x[p], x[q]) >= threshold
            yield p[exact], q[exact]

    stop = np.repeat(ends, ends - starts)
    size = np.repeat(ends - starts, ends - starts)
    place = np.arange(len(bucket))
    for step in range(1, min(SMALL, int((ends - starts).max())) if len(bucket) else 1):
        a = place[(size <= SMALL) & (place + step < stop)]
        b = a + step
        good = (same[a] | (own[a] != own[b])) & (np.einsum("nd,nd->n", u[a], u[b]) >= threshold - 1e-6)
        a, b = a[good], b[good]
        shared = before.meet(a, b)
        yield from verified(a[~shared], b[~shared])
    for start, end in zip(starts[ends - starts > SMALL], ends[ends - starts > SMALL]):
        shared = before.meet_all(start, end)
        for at in range(start, end, 256):
            to = min(end, at + 256)
            a, b = np.nonzero((u[at:to] @ u[at:end].T >= threshold - 1e-6) & ~shared[at - start:to - start, at - start:])
            a, b = a + at, b + at
            good = (b > a) & (same[a] | (own[a] != own[b]))
            yield from verified(a[good], b[good])


def _links_of_task(rows: pd.DataFrame, dtype: str, threshold: float) -> pd.DataFrame:
    """For each node with links in one task: the count of the links that its
    buckets own, and the root of its local tree."""
    rows = rows.sort_values(["bucket", "node"], ignore_index=True)
    out = {"node": [], "root": [], "links": []}
    for dim in rows["dim"].unique():
        part = rows[rows["dim"] == dim]
        node, copies = part["node"].to_numpy(dtype=np.int64), part["copies"].to_numpy(dtype=np.int64)
        x = np.stack(part["vector"].to_list()).astype(dtype)
        ids, local = np.unique(node, return_inverse=True)
        counts, ta, tb, held = np.zeros(len(ids), dtype=np.int64), [], [], 0
        for a, b in _pairs(part["bucket"].to_numpy(), part["own"].to_numpy(), (part["i"] == part["j"]).to_numpy(), x, unit(x),
                           _Lists(part["before"].to_list()), threshold):
            counts += np.bincount(local[a], weights=copies[b], minlength=len(ids)).astype(np.int64)
            counts += np.bincount(local[b], weights=copies[a], minlength=len(ids)).astype(np.int64)
            ta.append(local[a])
            tb.append(local[b])
            held += len(a)
            if held > 1_000_000:
                root = forest(np.concatenate(ta), np.concatenate(tb), len(ids))
                ta, tb, held = [np.arange(len(ids))], [root], len(ids)
        if ta:
            root = forest(np.concatenate(ta), np.concatenate(tb), len(ids))
            used = np.unique(np.concatenate((*ta, *tb)))
            out["node"].append(ids[used])
            out["root"].append(ids[root[used]])
            out["links"].append(counts[used])
    return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()})


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept."""
    dtype = dtype_of(vectors, vector_col)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    good = usable("vector") & F.col("label").isNotNull()
    rows = rows.withColumn("node", F.when(good, F.xxhash64("label", "vector")))
    nodes = stage(rows.where("node is not null").groupBy("node", "label", "vector")
                  .agg(F.count("*").alias("copies"), F.min("id").alias("low")), "cap-nodes")
    nodes = stage(_with_filters(nodes, code_size(nodes.count())), "cap-filters")
    passed = nodes.select("node", "label", "dim", F.explode("filters").alias("filter"))
    keys = ["label", "dim", "filter"]
    met = stage(passed.groupBy(keys).agg(F.count("*").alias("size")).where("size > 1"), "cap-buckets")
    # a node's filters that another node passes too, in order
    shared = (passed.join(met, keys).groupBy("node")
              .agg(F.array_sort(F.collect_list(F.struct("filter", "size"))).alias("shared")))
    rows_in = stage(nodes.join(shared.withColumnRenamed("node", "member"), F.col("node") == F.col("member"))
                    .select("node", "copies", "vector", "label", "dim", "shared"), "cap-shared")
    width = F.col("dim") * (4 if dtype == "<f4" else 8) + F.size("shared") * 4 + 64
    n_tasks = max(1, -(-(rows_in.agg(F.sum(width * F.size("shared"))).first()[0] or 0) // TASK_BYTES))
    blocks = F.ceil(F.col("size") / BUCKET).cast("int")
    whole = (rows_in.select("*", F.posexplode("shared").alias("place", "entry"))
             .withColumns({"filter": F.col("entry.filter"), "size": F.col("entry.size"),
                           "before": F.slice("shared.filter", 1, F.col("place"))})
             .withColumn("own", F.pmod(F.xxhash64("node", "filter"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
             .withColumn("bucket", F.xxhash64("label", "dim", "filter", "i", "j"))
             .withColumn("task", F.when(F.col("size") > BUCKET // 4, F.col("bucket")).otherwise(F.pmod("bucket", F.lit(n_tasks))))
             .select("task", "bucket", "dim", "own", "i", "j", "node", "copies", "vector", "before"))
    found = stage(whole.groupBy("task").applyInPandas(lambda rows: _links_of_task(rows, dtype, threshold), "node long, root long, links long"), "cap-links")
    counts = found.groupBy(F.col("node").alias("cn")).agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = (nodes.select("node", "copies", "low").join(roots.withColumnRenamed("node", "rn"), F.col("node") == F.col("rn"), "left")
              .join(counts, F.col("node") == F.col("cn"), "left")
              .select("node", "low", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    lowest = rooted.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component"))
    classes = rooted.join(lowest, F.col("root") == F.col("r")).select(F.col("node").alias("own_node"), "n_links", "component")
    joined = rows.select("id", "node").join(classes, F.col("node") == F.col("own_node"), "left")
    component = F.when(F.col("own_node").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
