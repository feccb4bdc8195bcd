"""Filter interaction audit: exact constrained least squares over coalitions.

Every document gets the set of filters it fails, as bits of a mask.  Documents
are counted by (part, mask), and from these counts the removals of every
coalition of filters are tabulated: ``v(S)`` is the number of documents that
fail a filter of S.  Coalition differences give what a filter removes after
any set of earlier ones: ``v(P + f) - v(P)``.

A filter's share of all removals (its Shapley value) is the solution of a
least-squares problem: fit ``v(S)`` by the sum of the members' shares, weighted
by the Shapley kernel ``(n-1) / (C(n,s) * s * (n-s))``, under the constraint
that all shares add up to ``v`` of all filters.  ``shapley_weights`` solves its
normal equations (with one multiplier for the constraint) in rationals, once
for every right-hand side, since the matrix is the same for all parts; the
shares are then sums of whole multiples of the ``v(S)``.

Work: one scan makes a slim table (id, part, digest of the text, mask) in the
shared folder.  The smallest id of each repeated text and the labels come by
joins without an aggregate above them that adaptive execution could not split
around; all counting combines map-side, to at most 32 rows a part.

Defined results: null text is empty, a null source is the part ''; rows with a
null id are audited, fail E never and make no other row fail it, and have no
label; rows that share id and text do not make each other fail E; several
labels of one id count as 1 if any is 1; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from .common import stage

#: Fixed by the audit's contract: the filters A to E, in the order of their bits.
LETTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"


def shapley_weights(n: int) -> list[list[Fraction]]:
    """``w[i][S]`` with ``share of filter i = sum over S of w[i][S] * v(S)``,
    S running over all coalitions as bit masks.

    The normal equations of the constrained fit: with ``z`` the membership
    vector of S and ``k`` its kernel weight, ``sum k z z' x + m = sum k z v(S)``
    and ``sum x = v(all)``, solved by elimination for one unit right-hand side
    a coalition.
    """
    full = (1 << n) - 1
    members = {s: [s >> i & 1 for i in range(n)] for s in range(full + 1)}
    rows = [[Fraction(0)] * (n + 1 + full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        size = sum(members[s])
        kernel = Fraction(n - 1, math.comb(n, size) * size * (n - size))
        for i in range(n):
            if members[s][i]:
                for j in range(n):
                    rows[i][j] += kernel * members[s][j]
                rows[i][n + 1 + s] = kernel
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full] = Fraction(1)
    for col in range(n + 1):
        pivot = next(r for r in range(col, n + 1) if rows[r][col])
        rows[col], rows[pivot] = rows[pivot], rows[col]
        lead = rows[col][col]
        rows[col] = [x / lead for x in rows[col]]
        for r in range(n + 1):
            if r != col and rows[r][col]:
                factor = rows[r][col]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[col])]
    return [rows[i][n + 1:] for i in range(n)]


def failures(text: Column) -> list[Column]:
    """The conditions A to D of a text that is not null."""
    words = F.array_remove(F.split(text, _SPACE), "")
    return [F.size(words) < 200,
            100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text).cast("long"),
            text.rlike("[#$%&*|]")]


def _bits(conditions: Sequence[Column]) -> Column:
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per document: part, mask of failed filters, good, toxic (0/1)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = stage(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                             F.unhex(F.sha2(text, 256)).alias("digest"), _bits(failures(text)).alias("mask")), "filter-masks")
    firsts = (slim.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").select(F.col("digest").alias("same"), "first"))
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("labelled"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")))
    copied = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return (slim.join(firsts, F.col("digest") == F.col("same"), "left")
            .join(known, F.col("id") == F.col("labelled"), "left")
            .select("part", F.col("mask").bitwiseOR(F.when(copied, 1 << 4).otherwise(0)).alias("mask"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("toxic")))


def coalitions(failed: DataFrame, n: int = len(LETTERS)) -> DataFrame:
    """(part, coalition, total, v, good, toxic) for all 2^n coalitions: the
    documents that a coalition removes, and the good and toxic ones of them."""
    counts = failed.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("g"), F.sum("toxic").alias("t"))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    return (counts.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("coalition"))
            .groupBy("part", "coalition")
            .agg(F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(a)
                                              for c, a in (("n", "v"), ("g", "good"), ("t", "toxic"))]))


def audit(failed: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all filters and step.

    ``failed`` has part, mask (bit i: fails ``letters[i]``), good and toxic.
    """
    n = len(letters)
    full = (1 << n) - 1
    orders = []
    for order in itertools.permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            orders.append({"o": "".join(letters[i] for i in order), "step": step, "f": f, "own": 1 << f, "a": before, "b": before | 1 << f})
            before |= 1 << f
    whole = [[int(w * math.factorial(n)) for w in row] for row in shapley_weights(n)]
    shares = F.from_json(F.lit(json.dumps(whole)), "array<array<bigint>>")
    table = (coalitions(failed, n).groupBy("part")
             .agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("coalition", "v", "good", "toxic"))).alias("c"))
             .withColumn("shares", F.transform(shares, lambda w: F.aggregate(
                 F.zip_with(w, F.col("c.v"), lambda x, y: x * y), F.lit(0).cast("bigint"), lambda x, y: x + y))))
    steps = F.explode(F.from_json(F.lit(json.dumps(orders)), "array<struct<o:string,step:int,f:int,own:int,a:int,b:int>>"))
    rows = table.select("*", steps.alias("s"))

    def at(coalition: Column, field: str) -> Column:
        return F.get(F.col("c"), coalition)[field]

    a, b, alone = F.col("s.a"), F.col("s.b"), F.col("s.own")
    removed = at(b, "v") - at(a, "v")
    return rows.select("part", F.col("s.o").alias("filter_order"), F.col("s.step").alias("step"),
                       (F.col("total") - at(b, "v")).alias("kept"), removed.alias("removed"),
                       (at(alone, "v") - removed).alias("redundant"),
                       (at(F.lit(full), "v") - at(F.lit(full) - alone, "v")).alias("unique_fails"),
                       (at(b, "good") - at(a, "good")).alias("good_lost"),
                       (at(b, "toxic") - at(a, "toxic")).alias("toxic_lost"),
                       F.get(F.col("shares"), F.col("s.f")).alias("shapley"))
