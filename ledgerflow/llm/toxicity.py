"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams.

Features of a text are the presence of its lower-cased words, word pairs and
skip-grams (pairs with one or two words between), hashed into ``BUCKETS``
weights.  FTRL-proximal keeps a learning rate per weight and drives rare and
useless weights to zero (L1), so the model that is sent to the executors is a
few thousand weights, and never more than ``BUCKETS``.

The model is fitted in one task on at most ``TRAIN_ROWS`` labelled rows, taken
in the order of the hash of their id up to ``TRAIN_BYTES`` of text (texts over
``TRAIN_TEXT`` bytes are not learned from); scoring covers every row and the
whole text, however long, in the tasks that scan the documents, without a
shuffle.

Defined results: null text is scored as empty; repeated label rows count as
toxic if any says so; null labels or ids in the label table are ignored; each
row of a repeated doc_id is scored, and one of its texts (that of smallest
hash) is learned from; a null doc_id is scored and not held out; without any
usable label the score is the prior 0 (nothing is predicted toxic); other
columns are kept by ``keep_clean`` and ignored by ``score``; an empty table
gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

BUCKETS = 1 << 20
#: Bound on the labelled rows the classifier is fitted on.
TRAIN_ROWS = 16_000
#: Bounds on their texts in UTF-8 bytes: all of them, and a single one.
TRAIN_BYTES, TRAIN_TEXT = 64_000_000, 1_000_000
EPOCHS = 3
#: FTRL-proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
_TRIM = ".,;:!?\"'()[]{}<>|*#%$&-_/\\"
_GAPS = (1, 2, 3)
_STEP_BYTES = 2_000_000


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of every text, repeats included."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    coded = words.flatten().dictionary_encode()
    plain = pc.utf8_trim(coded.dictionary, characters=_TRIM).to_pylist()
    codes = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) if w else 0 for w in plain),
                        dtype=np.uint64, count=len(plain))
    word = codes[coded.indices.to_numpy()] if len(plain) else codes
    bounds = words.offsets.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    held = word != 0                       # punctuation alone is no word
    word, row = word[held], row[held]
    rows, buckets = [row], [word % np.uint64(BUCKETS)]
    for gap in _GAPS:
        a, b = word[:-gap], word[gap:]
        same = row[:-gap] == row[gap:]
        mixed = (a[same] * np.uint64(0x9E3779B97F4A7C15) + b[same] * np.uint64(2 * gap + 1)) >> np.uint64(17)
        rows.append(row[:-gap][same])
        buckets.append(mixed % np.uint64(BUCKETS))
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(sizes) // _STEP_BYTES
    cuts = [0, *(np.nonzero(np.diff(step))[0] + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        yield texts.slice(a, b - a)


def fit(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over the rows in their order, ``EPOCHS`` times:
    (buckets, weights) of the non-zero weights, and the bias."""
    rows = []
    for part in _slices(texts):
        row, bucket = features(part)
        pairs = np.unique(row * BUCKETS + bucket)
        rows += np.split((pairs % BUCKETS).astype(np.int32), np.searchsorted(pairs, np.arange(1, len(part)) * BUCKETS))
    # a feature of a single row says nothing of other rows
    seen = np.zeros(BUCKETS + 1, dtype=np.int64)
    for x in rows:
        seen[x] += 1
    for i, x in enumerate(rows):            # in place: one copy of the features is held
        rows[i] = np.append(x[seen[x] > 1], np.int32(BUCKETS))
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    l1 = np.full(BUCKETS + 1, L1)
    l1[BUCKETS] = 0.0                      # the bias is not penalised

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1[at], 0.0, (np.sign(zi) * l1[at] - zi) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for x, y in zip(rows, labels):
            w = weights(x)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            root = np.sqrt(n[x])
            n[x] += g * g
            z[x] += g - (np.sqrt(n[x]) - root) / ALPHA * w
    w = weights(np.arange(BUCKETS + 1))
    kept = np.nonzero(w[:BUCKETS])[0]
    return kept, w[kept], float(w[BUCKETS])


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 5 (0 is held out)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


class Model:
    """Sparse weights; bounded by BUCKETS, usually some thousand."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        dense = np.zeros(BUCKETS, dtype=np.float64)
        dense[self.buckets] = self.weights
        out = []
        for part in _slices(texts):
            row, bucket = features(part)
            used = dense[bucket] != 0
            pairs = np.unique(row[used] * BUCKETS + bucket[used])
            margin = self.bias + np.bincount(pairs // BUCKETS, weights=dense[pairs % BUCKETS], minlength=len(part))
            out.append(1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col) != 0))
             .groupBy(id_col).agg(F.max(label_col).alias("y")))
    total = known.count()
    share = min(1.0, train_rows / total) if total else 1.0
    order = F.xxhash64(F.col(id_col), F.lit(11))
    # as many ids as the bound, by hash: a share of the hash range, then exactly (the same in every run)
    low = F.pmod(order, F.lit(1_000_000))
    picked = known.where(low < int(share * 1_050_000) + 1).orderBy(low, id_col).limit(train_rows)
    texts = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("t")).where(F.octet_length("t") <= TRAIN_TEXT)
    # one text an id, chosen before the shuffle, so a repeated id sends one row a task
    one = (texts.join(F.broadcast(picked), id_col).groupBy(id_col, "y")
           .agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("first"))
           .select(order.alias("o"), F.col(id_col).alias("i"), "first.t", "y"))
    # at most train_rows rows are left for the one task that learns
    so_far = F.sum(F.octet_length("t")).over(Window.orderBy("o", "i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sample = one.withColumn("bytes", so_far).where(F.col("bytes") <= train_bytes).select("t", "y")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            whole = pa.Table.from_batches(got).combine_chunks()
            texts = whole.column("t").combine_chunks() if whole.num_rows else pa.array([], pa.string())
            y = whole.column("y").to_numpy().astype(float)
            if len(set(y.tolist())) == 2:
                kept, w, bias = fit(texts, y)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, -1)), pa.array(np.append(w, bias))], names=["bucket", "weight"])

    fitted = sample.mapInArrow(learn, "bucket long, weight double").collect()
    if not fitted:
        return Model(np.zeros(0, np.int64), np.zeros(0), -30.0)
    bucket = np.array([r[0] for r in fitted], dtype=np.int64)
    weight = np.array([r[1] for r in fitted])
    own = bucket >= 0
    return Model(bucket[own], weight[own], float(weight[~own][0]))


def score_column(docs: DataFrame, model: Model, text_col: str = "text"):
    """Column expression: the toxicity of a text, 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def toxicity(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(pa.array(texts, type=pa.large_string(), from_pandas=True)))

    return toxicity(F.col(text_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    return (docs.select(id_col, F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"),
                        score_column(docs, model, text_col).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the model calls toxic."""
    return docs.where(score_column(docs, model, text_col) < threshold)
