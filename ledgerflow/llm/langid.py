"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree: for each context of up to ``ORDER``
bytes the bytes that followed it, with their counts.  A byte is coded in the
longest context that the tree has; where the byte never followed, an escape is
coded and the next shorter context is tried, without the bytes that the longer
one could have coded (exclusion), down to all bytes alike.  A context with N
occurrences of D different bytes gives a byte n / (N + D) and the escape
D / (N + D).  The counts are frozen: a text's code length in a language is a
sum over its bytes of a number that depends on the ``ORDER`` bytes before and
the byte alone.  The language of the shortest code is predicted; its score is
its probability if all learned languages were equally likely before.

The code lengths of all grams (context and byte) that occur in any language's
sample are worked out beforehand, in units of 2**-20 bit, so that sums are
exact in any order.  A text's grams are looked up in a hash table of them; for
a gram that no language has seen, the codes of its longest known suffix are
carried on through the escapes of the longer contexts, for each distinct gram
of a step once.

Learning: counts of grams are summed by Spark over a sample of ``TRAIN_ROWS``
rows a language, chosen by the hash of the id, of the ``LANGUAGES`` languages
with most rows.  The rarest grams are left out until at most ``MODEL_COUNTS``
counts and ``MODEL_CELLS`` code lengths are left, which bounds the model that is
sent to the executors.  Scoring reads whole texts in the tasks that scan them,
without a shuffle.

Defined results: null text and text without a letter is ``und`` with score 0,
as is every text if nothing could be learned; ties go to the smaller language
name; rows with a null id are scored and not held out, and not learned from;
equal rows count each; a text of any length is read whole, in steps; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import drop_stage, stage

ORDER = 4
#: Bound on the rows that each language is learned from (by expectation).
TRAIN_ROWS = 300
#: Bound on the languages learned.
LANGUAGES = 200
#: Bounds on the model: counts collected, and grams times languages.
MODEL_COUNTS = 2_000_000
MODEL_CELLS = 8_000_000
#: Text bytes scored at once (memory bound of a task).
STEP_BYTES = 2_000_000
_UNIT = 1 << 20
_HASH = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 5 (0 is held out)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


# -- grams ------------------------------------------------------------------------

def _padded(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts, each after ``order`` zero bytes."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    whole = pc.binary_join_element_wise(pa.scalar(bytes(order), pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For every place from ``order`` on: the byte and the ``order`` bytes
    before it as one number, the byte itself lowest."""
    key = data[order:].astype(np.uint64)
    for back in range(1, order + 1):
        key |= data[order - back:len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return key


def _own(offsets: np.ndarray, order: int, total: int) -> np.ndarray:
    """Which of ``grams`` belong to a text, not to the zeros between texts."""
    held = np.ones(max(0, total - order), dtype=bool)
    for back in range(order):
        at = offsets[1:-1] + back - order
        held[at[(at >= 0) & (at < len(held))]] = False
    return held


# -- context trees and their code lengths -----------------------------------------

def _bits(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log2(x)


class Model:
    """Frozen code lengths, from counts[gram, language] of the longest grams.

    For grams of each length (1 to order + 1): ``keys`` sorted, and for every
    language the count ``n``, the code length ``full`` of the gram's byte in
    the gram's context, and ``after``, its code length in shorter contexts
    once that context has been escaped from.  For contexts: ``ctx`` sorted, and
    for every language the count ``held`` (0: not in its tree), the escape's
    length ``escape``, and for the next shorter context without this one's
    bytes the total's logarithm ``rest`` and the escape's length ``skip``.
    """

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.languages, self.order = languages, order
        levels = [(keys, counts.astype(np.float64))]
        for _ in range(order):
            keys, counts = levels[-1]
            short = keys & np.uint64((1 << 8 * (order + 1 - len(levels))) - 1)
            shorter, place = np.unique(short, return_inverse=True)
            total = np.zeros((len(shorter), counts.shape[1]))
            np.add.at(total, place, counts)
            levels.append((shorter, total))
        self.keys = [k for k, _ in reversed(levels)]
        self.n = [n for _, n in reversed(levels)]
        self.ctx, self.held, self.escape, self.rest, self.skip = [], [], [], [], []
        self.full, self.after = [], []
        for length in range(1, order + 2):
            self._level(length)

    def _level(self, length: int) -> None:
        keys, n = self.keys[length - 1], self.n[length - 1]
        ctx, place = np.unique(keys >> np.uint64(8), return_inverse=True)
        shape = (len(ctx), n.shape[1])
        total, kinds = np.zeros(shape), np.zeros(shape)
        np.add.at(total, place, n)
        np.add.at(kinds, place, n > 0)
        with np.errstate(invalid="ignore"):
            escape = _bits(total + kinds) - _bits(kinds)
        if length == 1:
            # below the root: all 256 bytes alike, without those of the root
            rest, skip = np.log2(np.maximum(256 - kinds, 1)), np.zeros(shape)
        else:
            # the next shorter context, without the bytes of this one
            parent = np.searchsorted(self.ctx[-1], ctx & np.uint64((1 << 8 * (length - 2)) - 1))
            below = np.zeros(shape)
            np.add.at(below, place, np.where(n > 0, self.n[length - 2][self._shorter(keys, length)], 0))
            kinds_left = self._kinds[parent] - kinds
            total_left = self._total[parent] - below + kinds_left
            rest = _bits(np.maximum(total_left, 1))
            skip = np.where(kinds_left > 0, rest - _bits(np.maximum(kinds_left, 1)), 0.0)
        self._total, self._kinds = total, kinds
        held = total > 0
        if length == 1:
            after = np.broadcast_to(rest[place], n.shape).copy()
            absent = after
        else:
            short = self._shorter(keys, length)
            found = self.n[length - 2][short]
            after = np.where(found > 0, rest[place] - _bits(np.maximum(found, 1)), skip[place] + self.after[-1][short])
            absent = self.full[-1][short]
        with np.errstate(invalid="ignore"):
            full = np.where(n > 0, _bits(total + kinds)[place] - _bits(np.maximum(n, 1)),
                            np.where(held[place], escape[place] + after, absent))
        self.ctx.append(ctx)
        self.held.append(held)
        self.escape.append(np.where(held, escape, 0.0))
        self.rest.append(rest)
        self.skip.append(skip)
        self.full.append(full)
        self.after.append(after)

    def _shorter(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Where the grams without their first byte are, one level below."""
        return np.searchsorted(self.keys[length - 2], keys & np.uint64((1 << 8 * (length - 1)) - 1))

    # -- scoring --

    def ready(self) -> None:
        """Whole-numbered lengths and the hash table of the longest grams."""
        if hasattr(self, "slots"):
            return
        keys = self.keys[-1]
        self.cost = np.ascontiguousarray(np.rint(self.full[-1] * _UNIT).astype(np.int64).T)
        bits = max(4, int(math.log2(max(1, len(keys)))) + 3)
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, _FREE)
        self.index = np.zeros(len(self.slots), dtype=np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            if probe == 64:
                raise ValueError("too many equal hashes")
            at = self._slot(keys[left]) + probe
            free = self.slots[at] == _FREE
            self.slots[at[free]] = keys[left[free]]        # of equal places the last wins
            won = self.slots[at] == keys[left]
            self.index[at[won]] = left[won]
            left, probe = left[~won], probe + 1
        self.probes = probe

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * _HASH) >> self.shift).astype(np.int64)

    def unseen(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths [gram, language] of distinct longest grams, seen or not."""
        languages = len(self.languages)
        full = np.full((len(keys), languages), 8.0)
        after = np.full((len(keys), languages), 8.0)
        found = np.zeros((len(keys), languages))
        for length in range(1, self.order + 2):
            low = keys & np.uint64((1 << 8 * length) - 1)
            ctx, table = self.ctx[length - 1], self.keys[length - 1]
            c = np.minimum(np.searchsorted(ctx, low >> np.uint64(8)), len(ctx) - 1)
            known = ctx[c] == low >> np.uint64(8)
            held = self.held[length - 1][c] & known[:, None]
            if length == 1:
                after = self.rest[0][c]
            else:
                after = np.where(held, np.where(found > 0, self.rest[length - 1][c] - _bits(np.maximum(found, 1)),
                                                self.skip[length - 1][c] + after), after)
            g = np.minimum(np.searchsorted(table, low), len(table) - 1)
            same = table[g] == low
            found = np.where(same[:, None], self.n[length - 1][g], 0)
            full = np.where(same[:, None], self.full[length - 1][g], np.where(held, self.escape[length - 1][c] + after, full))
        return np.rint(full * _UNIT).astype(np.int64)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length of every text [text, language] in units of 2**-20 bit."""
        self.ready()
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not len(texts):
            return out
        data, offsets = _padded(texts, self.order)
        for a in range(self.order, len(data), STEP_BYTES):
            b = min(a + STEP_BYTES, len(data))
            key = grams(data[a - self.order:b], self.order)
            home = self._slot(key)
            place = np.full(len(key), -1, dtype=np.int32)
            hit = self.slots[home] == key
            place[hit] = self.index[home[hit]]
            left = np.flatnonzero(~hit & (self.slots[home] != _FREE))
            for probe in range(1, self.probes):
                at = home[left] + probe
                hit = self.slots[at] == key[left]
                place[left[hit]] = self.index[at[hit]]
                left = left[~hit & (self.slots[at] != _FREE)]
            begin = np.clip(offsets[:-1] + self.order, a, b) - a
            end = np.clip(offsets[1:], a, b) - a
            rows = np.flatnonzero(end > begin)
            if not len(rows):
                continue
            cuts = np.stack((begin[rows], end[rows]), axis=1).ravel()
            own = np.zeros(len(key) + 1, dtype=np.int8)
            np.add.at(own, begin[rows], 1)
            np.add.at(own, end[rows], -1)
            new = np.flatnonzero((place < 0) & (np.cumsum(own[:-1]) > 0))
            distinct, which = np.unique(key[new], return_inverse=True)
            more = self.unseen(distinct)
            if cuts[-1] == len(key):
                cuts = cuts[:-1]
            for language, cost in enumerate(self.cost):
                each = cost[place]                     # between texts anything: it is cut away
                each[new] = more[which, language]
                out[rows, language] += np.add.reduceat(each, cuts)[::2]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of every text."""
        letters = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages or not len(texts):
            return ["und"] * len(texts), np.zeros(len(texts))
        lengths = self.lengths(texts)
        best = np.argmin(lengths, axis=1)
        over = (lengths - lengths[np.arange(len(best)), best][:, None]) / _UNIT
        score = 1.0 / np.exp2(-np.minimum(over, 1000)).sum(axis=1)
        return [self.languages[i] if ok else "und" for i, ok in zip(best.tolist(), letters.tolist())], np.where(letters, score, 0.0)


# -- learning and scoring tables --------------------------------------------------

def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_rows: int = TRAIN_ROWS, order: int = ORDER, cells: int = MODEL_CELLS) -> Model:
    """Learn the context trees from a bounded sample outside the held-out fold."""
    usable = docs.where((fold(id_col) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in rows)
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0)), order)
    number = {lang: i for i, lang in enumerate(languages)}
    share = {r["lang"]: min(1.0, train_rows / r["count"]) for r in rows}
    # a share of the range of the id's hash for each language
    limits = F.from_json(F.lit(json.dumps({lang: int(s * (1 << 30)) for lang, s in share.items()})), "map<string,bigint>")
    numbers = F.from_json(F.lit(json.dumps(number)), "map<string,int>")
    sample = usable.where(F.pmod(F.xxhash64("id", F.lit(23)), F.lit(1 << 30)) < limits[F.col("lang")]).select(
        numbers[F.col("lang")].alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            for which in np.unique(lang).tolist():
                data, offsets = _padded(batch.column("text").filter(pa.array(lang == which)), order)
                key, n = np.unique(grams(data, order)[_own(offsets, order, len(data))], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), which), pa.int32()), pa.array(key.view(np.int64)), pa.array(n, pa.int64())],
                                                 names=["lang", "gram", "n"])

    summed = stage(sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    spread, held, least = summed.groupBy("n").count().orderBy(F.desc("n")).collect(), 0, 1
    for row in spread:                                 # as many different counts as the sample allows
        held += row["count"]
        if held > MODEL_COUNTS:
            least = row["n"] + 1
            break
    found = summed.where(F.col("n") >= least).toArrow()
    drop_stage(summed)
    lang, gram, n = (found.column(c).to_numpy() for c in ("lang", "gram", "n"))
    gram = gram.astype(np.int64).view(np.uint64)
    while True:
        kept = n >= least
        keys = np.unique(gram[kept])
        if len(keys) * len(languages) <= cells:
            break
        least += 1
    counts = np.zeros((len(keys), len(languages)), dtype=np.int64)
    counts[np.searchsorted(keys, gram[kept]), lang[kept]] = n[kept]
    return Model(languages, keys, counts, order) if len(keys) else Model([], keys, counts[:, :0], order)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                lang, score = sent.value.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=[id_col, "held_out", "lang_pred", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``STEP_BYTES`` of text (one longer text is one)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(sizes) // STEP_BYTES
    cuts = [0, *(np.nonzero(np.diff(step))[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
