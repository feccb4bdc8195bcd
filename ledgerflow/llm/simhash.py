"""SimHash near-duplicates through vantage-point trees.

1. Every text becomes one 64-bit fingerprint (majority bits of its shingles'
   XXH64).  Equal fingerprints are one node from here on, so exact copies,
   however many, cost one row.
2. A vantage-point tree over a bounded sample of fingerprints (``TREE_SAMPLE``)
   cuts Hamming space into shards.  At a node with vantage point v and radius
   r a fingerprint x with d(x, v) <= r goes inside, others outside; one that is
   inside but within ``max_bits`` of the boundary (d > r - max_bits) visits the
   outside as well.  By the triangle inequality a pair within ``max_bits`` that
   a node parts meets again outside, so every pair shares a shard, and a
   boundary costs copies on one side of it only.  *Every* fingerprint is
   routed; the sample only decides how even the shards are, never which pairs
   are found.
3. A shard's task goes on cutting by the same rule and compares exactly at the
   leaves.  It sends on a spanning forest of what it found, not the pairs.
   A shard far larger than aimed at (a dense neighbourhood that no vantage
   point cuts) is cut into blocks, and every two blocks are a task.
4. ``components`` joins the forests; the class of a document is the smallest
   doc_id of its component.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; a null doc_id is kept and never is
a component's id unless the component has no other (then null); repeated rows
give repeated result rows; columns other than id and text are ignored by
``near_duplicates`` and kept by ``keep_one``; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from .common import fresh, stage
from .components import components, forest

#: Fingerprints from which the upper tree is fitted (a bound on what the
#: driver gets; all fingerprints are routed through the tree).
TREE_SAMPLE = 16_384
#: Fingerprints aimed at in one shard, visitors included; a task never gets
#: more than four times as many.
SHARD_POINTS = 32_768
#: Points below which the lower tree compares directly.
BUCKET = 512
SEED = 42


# -- fingerprints -------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint (as a signed long) of a whole text.

    A-Z are lower-cased, words are runs of anything but ASCII white space,
    shingles (repeats included) are ``shingle`` words joined by a space, or
    the whole sequence if it is shorter.  Bit i is set if more than half of
    the shingles' XXH64 (seed 42) have it set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    codes = np.fromiter((hashed(joined[s:e], SEED) for s, e in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())),
                        dtype="<u8", count=len(words) - k + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(codes), 65_536):
        block = codes[at:at + 65_536]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(codes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text, shingle: int = 3):
    """Column expression: the fingerprint of a text column, as a long."""

    @F.pandas_udf(LongType())
    def simhash64(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash64(text)


# -- the upper tree -----------------------------------------------------------

def _distance(x: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(x ^ np.uint64(v))


def _vantage(points: np.ndarray, reach: int) -> tuple[int, int] | None:
    """The vantage point and radius, among a few spread-out points, whose
    larger side (visitors included) is smallest; None if none cuts."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(len(points), 8)).astype(int)]:
        below = np.cumsum(np.bincount(_distance(points[:4096], v), minlength=65))
        outside = below[-1] - np.concatenate((np.zeros(reach, dtype=np.int64), below))[:65]
        larger = np.maximum(below, outside)
        r = int(larger.argmin())
        share = larger[r] / below[-1]
        if share < 0.95 and (best is None or share < best[0]):
            best = (share, int(v), r)
    return best and best[1:]


def _sides(x: np.ndarray, v: int, r: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    d = _distance(x, v).astype(np.int64)
    return d <= r, d > r - reach


def build_tree(sample: np.ndarray, shard_sample: float, reach: int) -> list[tuple[int, int, int, int]]:
    """Flat tree: node i is (vantage point, radius, inside, outside); a child
    >= 0 is a node, a child < 0 is shard -child - 1.  An empty list: one shard.
    Parts with more than ``shard_sample`` sample points are cut if they can be."""
    nodes: list[list[int]] = []
    shards, pending = 0, [(sample, None)]
    while pending:
        points, at = pending.pop()
        cut = _vantage(points, reach) if len(points) > max(shard_sample, 4) else None
        if cut is None:
            if at is not None:
                nodes[at[0]][at[1]] = -shards - 1
            shards += 1
            continue
        if at is not None:
            nodes[at[0]][at[1]] = len(nodes)
        nodes.append([cut[0], cut[1], 0, 0])
        inside, outside = _sides(points, *cut, reach)
        pending += [(points[inside], (len(nodes) - 1, 2)), (points[outside], (len(nodes) - 1, 3))]
    return [tuple(n) for n in nodes]


def route(x: np.ndarray, tree: list[tuple[int, int, int, int]], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every visit."""
    rows, shards = [], []
    pending = [(0 if tree else -1, np.arange(len(x)))]
    while pending:
        node, at = pending.pop()
        if node < 0:
            rows.append(at)
            shards.append(np.full(len(at), -node - 1, dtype=np.int32))
        elif len(at):
            v, r, inside, outside = tree[node]
            near, far = _sides(x[at], v, r, reach)
            pending += [(inside, at[near]), (outside, at[far])]
    return np.concatenate(rows), np.concatenate(shards)


# -- within a shard -----------------------------------------------------------

def _links_in_leaf(x: np.ndarray, ids: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among ``x`` (named by ``ids``); where they are dense, a spanning
    forest of a block's links."""
    rows = max(1, 1_000_000 // len(x))
    for at in range(0, len(x), rows):
        hit = np.bitwise_count(x[at:at + rows, None] ^ x[None, at:]) <= reach
        a, b = np.nonzero(hit)
        a, b = a + at, b + at
        a, b = a[a < b], b[a < b]
        if len(a) > 4 * sum(hit.shape):
            label = forest(a, b, len(x))
            a = np.nonzero(label != np.arange(len(x)))[0]
            b = label[a]
        if len(a):
            yield ids[a], ids[b]


def search_shard(points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, root) of all links at ``reach`` or fewer bits
    among distinct fingerprints."""
    found_a, found_b, held = [], [], 0
    pending = [np.arange(len(points))]
    while pending:
        at = pending.pop()
        cut = _vantage(points[at], reach) if len(at) > BUCKET else None
        if cut is not None:
            inside, outside = _sides(points[at], *cut, reach)
            if max(inside.sum(), outside.sum()) < len(at):
                pending += [at[inside], at[outside]]
                continue
        if len(at) < 2:
            continue
        for a, b in _links_in_leaf(points[at], at, reach):
            found_a.append(a)
            found_b.append(b)
            held += len(a)
            if held > 1_000_000:  # what is held stays as small as the shard
                label = forest(np.concatenate(found_a), np.concatenate(found_b), len(points))
                other = np.nonzero(label != np.arange(len(points)))[0]
                found_a, found_b, held = [other], [label[other]], len(other)
    if not found_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    label = forest(np.concatenate(found_a), np.concatenate(found_b), len(points))
    other = np.nonzero(label != np.arange(len(points)))[0]
    return points[other], points[label[other]]


def fingerprint_components(fps: DataFrame, max_bits: int = 3, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(node, root) over distinct fingerprints ``fps`` (fp long): the root of
    every fingerprint that is linked to a smaller one."""
    n = fps.count()
    sample = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()]
    tree = build_tree(np.array(sample, dtype=np.int64).view(np.uint64), shard_points * len(sample) / max(1, n), max_bits)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch["fp"].to_numpy(dtype=np.int64)
            row, shard = route(x.view(np.uint64), tree, max_bits)
            for at in range(0, len(row), 100_000):
                step = slice(at, at + 100_000)
                yield pd.DataFrame({"shard": shard[step], "fp": x[row[step]]})

    routed = stage(fps.select("fp").mapInPandas(visits, "shard int, fp long"), "vp-visits")
    blocks = routed.groupBy("shard").agg(F.ceil(F.count("*") / (2 * shard_points)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), "blocks").cast("int")
    tasks = (routed.join(blocks, "shard").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .where("blocks = 1 or own != other")
             .select("shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))

    def search(block: pd.DataFrame) -> pd.DataFrame:
        a, b = search_shard(block["fp"].to_numpy(dtype=np.int64).view(np.uint64), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return components(tasks.groupBy("shard", "i", "j").applyInPandas(search, "a long, b long"))


# -- documents ----------------------------------------------------------------

def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id, winner): prints has fp, id, mark; winner is the
    smallest (id nulls last, mark) of the component."""
    groups = stage(prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("w")), "prints")
    roots = fingerprint_components(groups.select("fp"), max_bits)
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "w", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("w").alias("winner"))
    return rooted.select("fp", "root").join(best, "root").select("fp", "winner")


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    return stage(docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("mark"),
                             fingerprint_column(F.col(text_col), shingle).alias("fp")), "prints")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    prints = _prints(docs, id_col, text_col, shingle)
    classes = _classes(prints, max_bits)
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("winner.id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of every component: that with the smallest id
    (then the smallest hash of its text; of equal rows, any one)."""
    winners = _classes(_prints(docs, id_col, text_col, shingle), max_bits)
    winners = stage(winners.select("winner.id", "winner.mark").distinct(), "winners")
    mark = fresh("mark", docs.columns)
    marked = docs.withColumn(mark, F.coalesce(F.xxhash64(text_col), F.lit(0)))
    kept = marked.join(winners, marked[id_col].eqNullSafe(winners["id"]) & (marked[mark] == winners["mark"]), "left_semi")
    repeated = kept.groupBy(id_col, mark).count().where("count > 1").limit(1).count()
    if repeated:
        kept = kept.dropDuplicates([id_col, mark])
    return kept.drop(mark)
