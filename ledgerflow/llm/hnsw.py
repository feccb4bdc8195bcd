"""Approximate nearest neighbours: a small-world graph hierarchy per shard.

Every partition is read as a stream and cut into shards of ``shard_rows`` rows
(more in larger tables, as far as a task's memory allows); a shard's graph is built in memory and stored as one row of flat arrays (ids,
vectors, and for each layer its members, offsets and neighbours).  A node is a
distinct vector with the ids of its rows, so copies cannot fill a
neighbourhood.  A node's layers are drawn geometrically; in each layer it is
linked to neighbours chosen by the diversity rule of HNSW (Malkov & Yashunin)
among its nearest, links go both ways, and parts that this leaves apart are
joined, so every node can be reached.

A search descends the layers with a beam.  Query blocks meet every shard; a
shard returns each query's nearest ids by the exact cosine of the original
vectors, and the shard results are merged per query.

Defined results: rows with a null id or an unusable vector take no part, nor do
vectors of another length than the query's; a row never finds its own id;
equal scores are ranked by the smaller id; if an id repeats, it is returned once with its best score, and a repeated query id
stands for the smallest of its vectors; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage
from .components import forest
from .vectors import cosine, dtype_of, matrices, unit, usable

SHARD = 4096
#: Shards grow with the table up to these, so that searches (every block of
#: queries against every shard) grow less than the table's square.
MAX_SHARD, SHARD_BYTES = 32_768, 1 << 25
QUERIES = 512
M = 16
CANDIDATES = 64
BEAM = 128
SEED = 5


# -- building -----------------------------------------------------------------

def _diverse(x: np.ndarray, near: np.ndarray, sims: np.ndarray, cap: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none), those nearer to the
    row than to any candidate chosen before, filled up with the nearest of the
    others; -1 pads to ``cap``."""
    out = np.full((len(near), cap), -1, dtype=np.int32)
    for at in range(0, len(near), 256):
        s = slice(at, at + 256)
        ids, own = near[s], sims[s]
        among = np.einsum("nad,nbd->nab", x[ids], x[ids], optimize=True)
        chosen = np.zeros(ids.shape, dtype=bool)
        taken = np.zeros(len(ids), dtype=int)
        closest = np.full(ids.shape, -2.0, dtype=x.dtype)
        for c in range(ids.shape[1]):
            pick = (ids[:, c] >= 0) & (own[:, c] > closest[:, c]) & (taken < cap)
            chosen[pick, c] = True
            taken += pick
            closest[pick] = np.maximum(closest[pick], among[pick, :, c])
        rank = np.where(ids < 0, 2, np.where(chosen, 0, 1)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :cap]
        best = np.take_along_axis(ids, order, axis=1)
        out[s, :best.shape[1]] = best
    return out


def _layer(x: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and neighbours of one layer over the rows of ``x``."""
    n = len(x)
    if n == 1:
        return np.array([0, 0], dtype=np.int32), np.zeros(0, dtype=np.int32)
    width = min(CANDIDATES, n - 1)
    near = np.empty((n, width), dtype=np.int32)
    sims = np.empty((n, width), dtype=x.dtype)
    step = max(16, min(512, (1 << 21) // n))
    for at in range(0, n, step):
        s = x[at:at + step] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -3.0
        top = np.argpartition(-s, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(s, top, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near[at:at + step], sims[at:at + step] = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
    picked = _diverse(x, near, sims, cap // 2)
    a = np.repeat(np.arange(n), picked.shape[1])[picked.ravel() >= 0]
    b = picked.ravel()[picked.ravel() >= 0].astype(np.int64)
    label = forest(a, b, n)
    roots = np.unique(label)
    while len(roots) > 1:          # join each part to its nearest outside node
        extra_a, extra_b = [], []
        main = roots[np.argmax([np.count_nonzero(label == r) for r in roots])]
        for r in roots[roots != main]:
            inside, outside = np.nonzero(label == r)[0], np.nonzero(label != r)[0]
            closest = -np.inf
            for at in range(0, len(inside), step):
                s = x[inside[at:at + step]] @ x[outside].T
                i, j = np.unravel_index(int(s.argmax()), s.shape)
                if s[i, j] > closest:
                    closest, link = s[i, j], (inside[at + i], outside[j])
            extra_a.append(link[0])
            extra_b.append(link[1])
        a, b = np.concatenate((a, extra_a)), np.concatenate((b, extra_b))
        label = forest(a, b, n)
        roots = np.unique(label)
    pairs = np.unique(np.concatenate((a * n + b, b * n + a)))
    return (np.searchsorted(pairs, np.arange(n + 1) * n).astype(np.int32), (pairs % n).astype(np.int32))


def build(vectors: np.ndarray) -> np.ndarray:
    """The graph over distinct vectors as one flat int32 array: layers, then
    for each, topmost last: members, links, member list, offsets, neighbours
    (as places in the member list)."""
    x = unit(vectors).astype(np.float32)
    rng = np.random.default_rng([SEED, len(x)])
    level = np.floor(-np.log(1.0 - rng.random(len(x))) / np.log(M)).astype(int)
    parts = [np.array([level.max() + 1], dtype=np.int32)]
    for k in range(level.max() + 1):
        members = np.nonzero(level >= k)[0].astype(np.int32)
        offsets, links = _layer(x[members], 2 * M if k == 0 else M)
        parts += [np.array([len(members), len(links)], dtype=np.int32), members, offsets, links]
    return np.concatenate(parts)


# -- searching ----------------------------------------------------------------

def _layers(graph: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    out, at = [], 1
    for _ in range(int(graph[0])):
        n, links = int(graph[at]), int(graph[at + 1])
        at += 2
        out.append((graph[at:at + n], graph[at + n:at + 2 * n + 1], graph[at + 2 * n + 1:at + 2 * n + 1 + links]))
        at += 2 * n + 1 + links
    return out


def _beam(x: np.ndarray, offsets: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, size: int) -> np.ndarray:
    """For each query, the ``size`` best nodes that a beam search of one layer
    reaches from its entry nodes (-1 pads)."""
    n = len(x)
    degree = np.diff(offsets)
    wide = int(degree.max()) if n > 1 else 1
    padded = np.full((n + 1, wide), n, dtype=np.int32)       # its last row leads nowhere
    rows = np.repeat(np.arange(n), degree)
    padded[rows, np.arange(len(links)) - np.repeat(offsets[:-1], degree)] = links
    size = min(size, n)
    seen = np.zeros((len(q), n + 1), dtype=bool)
    seen[:, n] = True
    ids = np.full((len(q), size), n, dtype=np.int64)
    sims = np.full((len(q), size), -4.0, dtype=np.float32)
    open_ = np.zeros((len(q), size), dtype=bool)
    x1 = np.vstack((x, np.zeros((1, x.shape[1]), dtype=x.dtype)))

    def offer(who: np.ndarray, nodes: np.ndarray) -> None:
        fresh = ~seen[who[:, None], nodes]
        # a node reached twice at once counts once
        order = np.argsort(nodes, axis=1, kind="stable")
        ranked = np.take_along_axis(nodes, order, axis=1)
        double = np.zeros(nodes.shape, dtype=bool)
        np.put_along_axis(double, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
        fresh &= ~double
        seen[who[:, None], nodes] = True
        s = np.where(fresh, np.einsum("nwd,nd->nw", x1[nodes], q[who], optimize=True), -4.0).astype(np.float32)
        all_ids = np.concatenate((ids[who], np.where(fresh, nodes, n)), axis=1)
        all_sims = np.concatenate((sims[who], s), axis=1)
        all_open = np.concatenate((open_[who], fresh), axis=1)
        top = np.argpartition(-all_sims, size - 1, axis=1)[:, :size]
        ids[who] = np.take_along_axis(all_ids, top, axis=1)
        sims[who] = np.take_along_axis(all_sims, top, axis=1)
        open_[who] = np.take_along_axis(all_open, top, axis=1)

    offer(np.arange(len(q)), entry)
    step = min(4, size)
    while True:
        who = np.nonzero(open_.any(axis=1))[0]
        if not len(who):
            break
        value = np.where(open_[who], sims[who], -5.0)
        best = np.argpartition(-value, step - 1, axis=1)[:, :step]
        usable_ = np.take_along_axis(value, best, axis=1) > -5.0
        nodes = np.where(usable_, np.take_along_axis(ids[who], best, axis=1), n)
        flags = open_[who]
        np.put_along_axis(flags, best, False, axis=1)
        open_[who] = flags
        offer(who, padded[nodes].reshape(len(who), -1))
    order = np.argsort(-sims, axis=1, kind="stable")
    ids = np.take_along_axis(ids, order, axis=1)
    return np.where(np.take_along_axis(sims, order, axis=1) > -4.0, ids, -1)


def search(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Nodes near each query, best first, -1 pads."""
    x, q = unit(vectors).astype(np.float32), unit(queries).astype(np.float32)
    entry, found = None, None
    for k, (members, offsets, links) in reversed(list(enumerate(_layers(graph)))):
        start = np.zeros((len(q), 1), dtype=np.int64) if entry is None else entry
        at = _beam(x[members], offsets, links, q, start, beam if k == 0 else 16)
        found = np.where(at >= 0, members[at], -1)
        if k:       # places of the best nodes in the layer below
            below = _layers(graph)[k - 1][0]
            entry = np.searchsorted(below, np.where(found >= 0, found, found[:, :1]))
    return found


# -- tables -------------------------------------------------------------------

def shard_rows(n: int) -> int:
    """Rows of a shard for a table of ``n`` rows."""
    return min(MAX_SHARD, max(SHARD, n // 128))


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int | None = None) -> DataFrame:
    """The index, staged: a row per shard with all its rows' ids."""
    dtype = dtype_of(vectors, vector_col)
    most = shard or shard_rows(vectors.count())
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
            .where(F.col("id").isNotNull() & usable("vector")))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 32

        def done(dim: int, parts: list) -> pa.RecordBatch:
            nonlocal number
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            nodes, node = np.unique(x, axis=0, return_inverse=True)
            own = np.unique(np.stack((node.ravel().astype(np.int64), ids), axis=1), axis=0)
            firsts = np.searchsorted(own[:, 0], np.arange(len(nodes) + 1)).astype("<i4")
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number - 1]), pa.array([dim], pa.int32()), pa.array([own[:, 1].astype("<i8").tobytes()]), pa.array([firsts.tobytes()]),
                 pa.array([nodes.astype(dtype).tobytes()]), pa.array([build(nodes).astype("<i4").tobytes()])],
                names=["shard", "dim", "ids", "firsts", "vectors", "graph"])

        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, x in matrices(batch.column("vector")):
                dim = x.shape[1]
                shard = max(1, min(most, SHARD_BYTES // x[:1].nbytes))
                parts = held.setdefault(dim, [])
                for begin in range(0, len(at), shard):
                    parts.append((ids[at[begin:begin + shard]], x[begin:begin + shard]))
                    if sum(len(p[0]) for p in parts) >= shard:
                        yield done(dim, parts)
                        parts.clear()
        for dim, parts in held.items():
            if parts:
                yield done(dim, parts)

    return stage(rows.mapInArrow(shards, "shard long, dim int, ids binary, firsts binary, vectors binary, graph binary"), "hnsw")


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            shard: int | None = None, beam: int = BEAM) -> DataFrame:
    """The k nearest rows of each row that ``queries`` selects: query_id, rank,
    vec_id, score."""
    dtype = dtype_of(vectors, vector_col)
    shards = index(vectors, id_col, vector_col, shard)
    asked = (vectors.where(queries & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
             .where(usable("vector")).groupBy("id").agg(F.min("vector").alias("vector")))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, x in matrices(batch.column("vector")):
                for begin in range(0, len(at), QUERIES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.shape[1]], pa.int32()), pa.array([ids[at[begin:begin + QUERIES]].astype("<i8").tobytes()]),
                         pa.array([x[begin:begin + QUERIES].astype(dtype).tobytes()])], names=["qdim", "qids", "qvectors"])

    asked = stage(asked.mapInArrow(blocks, "qdim int, qids binary, qvectors binary"), "hnsw-queries")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                dim = row["dim"]
                x = np.frombuffer(row["vectors"], dtype=dtype).reshape(-1, dim)
                q = np.frombuffer(row["qvectors"], dtype=dtype).reshape(-1, dim)
                qids, ids = np.frombuffer(row["qids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                firsts = np.frombuffer(row["firsts"], "<i4")
                found = search(x, np.frombuffer(row["graph"], "<i4"), q, beam)
                who, place = np.nonzero(found >= 0)
                node = found[who, place]
                score = cosine(x[node], q[who])
                # a node stands for its smallest k + 1 distinct ids
                rows_q, rows_id, rows_s = [], [], []
                for extra in range(min(k + 1, int(np.diff(firsts).max()))):
                    held = firsts[node] + extra < firsts[node + 1]
                    rows_q.append(who[held])
                    rows_id.append(ids[firsts[node[held]] + extra])
                    rows_s.append(score[held])
                rq, ri, rs = np.concatenate(rows_q), np.concatenate(rows_id), np.concatenate(rows_s)
                other = ri != qids[rq]
                rq, ri, rs = rq[other], ri[other], rs[other]
                order = np.lexsort((ri, -rs, rq))
                rq, ri, rs = rq[order], ri[order], rs[order]
                kept = np.arange(len(rq)) - np.searchsorted(rq, rq) < k
                yield pa.RecordBatch.from_arrays([pa.array(qids[rq[kept]]), pa.array(ri[kept]), pa.array(rs[kept])], names=["query_id", "vec_id", "score"])

    # every shard is in one slot and every block of queries goes to all slots
    n = max(1, shards.count())
    slots = shards.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(n))).repartition(n, "slot")
    everywhere = asked.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("qslot"))
    met = (slots.hint("merge").join(everywhere, F.col("slot") == F.col("qslot")).where("dim = qdim")
           .mapInArrow(meet, "query_id long, vec_id long, score double")
           .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
