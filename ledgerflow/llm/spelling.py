"""Spelling variants: near words found by pivotal bigrams, grouped by form.

Words.  Tasks cut texts into runs of Latin letters (``[A-Za-z\\u00C0-\\u00FF]``),
lower-case A-Z and count them; a run whose crc32 with its document's id is
divisible by ``EVERY`` loses one letter (the contract's planted misspelling).
The counts are summed on the word with map-side combining.

Near words (one letter inserted, deleted or replaced).  Bigrams are ranked by
how often the words hold them, rarest first.  A word's prefix is its three
rarest bigrams (with all others of the same rank as the third), and its pivots
are the two of them that do not overlap and are rarest together, chosen by
dynamic programming over the positions.  One edit damages at most one of two
disjoint bigrams, so of two near words the one whose prefix ends at the
smaller rank has a pivot in the other word's prefix: pivots are joined with
prefixes.  Position limits make the join key: a bigram that survives the edit
has the whole edit on one side of it, so the letters from the bigram to the
word's other end are equal (``known``), and the lengths differ by at most one.
The edit is right of the first pivot, or else left of the second, so one key a
pivot is enough.  Where ``known`` is short, the rest is cut in two halves, one
of which the edit leaves alone, and each gives a key with that half.  Keys are
64-bit hashes; every pair that meets is verified by its edit distance.

Forms.  A word's form is its most frequent near word, if that is at least
``RATIO`` times as frequent.  Counts grow by that factor along forms, so their
chains are short, and a few rounds of pointer jumping lead to the roots.

Work: rows with a word or key are all that moves.  The table of bigrams (at
most 90 * 90, the alphabet squared) is all that a task gets whole.  No join
has an aggregate directly above it that would keep adaptive execution from
splitting a hot key.

Defined results: null text has no words; a null id is written as nothing
before the colon; equal rows count each; an empty table gives no words; a text
of any length is read whole, in steps cut between runs; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import drop_stage, stage

#: Fixed by the contract.
EVERY, MIN_LETTERS, MIN_COUNT, RATIO = 31, 7, 2, 10
#: Bytes of text cut into runs at once (memory bound of a task).
STEP_BYTES = 4_000_000
#: Letters of ``known`` from which a key does without a half of the rest.
LONG_KNOWN = 6
_LOWER = np.zeros(256, dtype=np.uint8)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LEAD = 0xC3            # first byte of U+00C0 to U+00FF in UTF-8
_DIRECT = 64            # bytes of a run from which its crc32 is taken alone


# -- words ----------------------------------------------------------------------

def _shift_tables() -> np.ndarray:
    """``T[n, k, b]``: what byte k of a crc32 register contributes after n
    more bytes.  crc32 is linear, so crc32(prefix + run) is the run's own
    crc32 xor these four entries for the prefix's."""
    out = np.zeros((_DIRECT, 4, 256), dtype=np.uint32)
    for n in range(_DIRECT):
        zeros = bytes(n)
        base = zlib.crc32(zeros)
        for k in range(4):
            for bit in range(8):
                out[n, k, 1 << bit] = zlib.crc32(zeros, 1 << (8 * k + bit)) ^ base
            for b in range(1, 256):
                low = b & -b
                if b != low:
                    out[n, k, b] = out[n, k, low] ^ out[n, k, b ^ low]
    return out


_TABLES: list[np.ndarray] = []


def _crc(prefix: np.ndarray, run: np.ndarray, size: np.ndarray) -> np.ndarray:
    if not _TABLES:
        _TABLES.append(_shift_tables())
    t = _TABLES[0]
    out = run.copy()
    for k in range(4):
        out ^= t[size, k, (prefix >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _steps(data: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Cuts of a buffer between runs, about ``step`` bytes apart."""
    a = 0
    while a < len(data):
        b = min(a + step, len(data))
        while b < len(data) and (_LOWER[data[b]] or data[b] == _LEAD or data[b - 1] == _LEAD):
            b += 1
        yield a, b
        a = b


def count_batch(ids: list[str | None], texts: pa.Array, min_letters: int = MIN_LETTERS,
                every: int = EVERY) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, counts) of the runs in ``texts``; a word may come repeatedly."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    begin = offsets[:-1] - offsets[0]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    marks = [f"{'' if i is None else i}:".encode() for i in ids]
    prefix = np.fromiter(map(zlib.crc32, marks), dtype=np.uint32, count=len(ids))
    first = np.zeros(len(data) + 1, dtype=bool)
    first[begin] = True                       # runs do not reach over texts
    for a, b in _steps(data, STEP_BYTES):
        part = data[a:b]
        low, lead = _LOWER[part], part == _LEAD
        after = np.concatenate(([False], lead[:-1]))
        low[lead | after] = part[lead | after]
        held = low != 0
        opens = held & ~after & (np.concatenate(([True], ~held[:-1])) | first[a:b])
        places = np.flatnonzero(opens) + a
        letters = low[held]
        starts = np.concatenate((np.flatnonzero(opens[held]), [len(letters)])).astype(np.int32)
        size = np.diff(starts)
        wide = np.concatenate(([0], np.cumsum(letters == _LEAD, dtype=np.int32)))
        count = size - (wide[starts[1:]] - wide[starts[:-1]])
        keep = count >= min_letters
        if not keep.any():
            continue
        runs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(starts), pa.py_buffer(letters)])
        coded = runs.filter(pa.array(keep)).dictionary_encode()
        known = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy()
        size, count = size[keep].astype(np.int64), count[keep].astype(np.int64)
        doc = np.searchsorted(begin, places[keep], side="right") - 1
        own = np.fromiter(map(zlib.crc32, known), dtype=np.uint32, count=len(known))
        h = _crc(prefix[doc], own[code], np.minimum(size, _DIRECT - 1))
        for i in np.flatnonzero(size >= _DIRECT).tolist():
            h[i] = zlib.crc32(known[code[i]], int(prefix[doc[i]]))
        cut = h % np.uint32(every) == 0
        seen = np.bincount(code[~cut], minlength=len(known))
        at = np.flatnonzero(seen)
        yield coded.dictionary.take(pa.array(at)).cast(pa.string()), seen[at]
        changed: Counter[str] = Counter()
        for i in np.flatnonzero(cut & (count > min_letters)).tolist():
            word, k = known[code[i]].decode(), int(h[i]) % int(count[i])
            changed[word[:k] + word[k + 1:]] += 1
        if changed:
            yield pa.array(list(changed), pa.string()), np.fromiter(changed.values(), dtype=np.int64)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for words, n in count_batch(batch.column("id").to_pylist(), batch.column("text"), min_letters, every):
                    yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], names=["word", "n"])

    return (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# -- near words -----------------------------------------------------------------

def bigram_ranks(words: DataFrame) -> np.ndarray:
    """Rank of every bigram (code 256 * first + second letter), rarest first;
    at most the alphabet squared many, so they are collected."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1),
                                               lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    found = sorted((r["count"], r["gram"]) for r in grams.groupBy("gram").count().collect())
    ranks = np.full(65536, len(found), dtype=np.int32)
    for rank, (_, gram) in enumerate(found):
        ranks[ord(gram[0]) * 256 + ord(gram[1])] = rank
    return ranks


def pivots(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(in prefix, first pivot, second pivot) of words given the ranks of
    their bigrams [word, position].

    Dynamic programming over positions: the rarest prefix bigram up to each
    position, then for each position the sum with the rarest one that ends
    before it.
    """
    n, width = rank.shape
    last = np.partition(rank, 2, axis=1)[:, 2:3]
    prefix = rank <= last
    cost = np.where(prefix, rank, 1 << 28).astype(np.int64)
    one, at_one = cost[:, 0].copy(), np.zeros(n, dtype=np.int64)
    best, first, second = np.full(n, 1 << 40), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for j in range(2, width):
        if j > 2:
            better = cost[:, j - 2] < one
            one[better], at_one[better] = cost[better, j - 2], j - 2
        total = one + cost[:, j]
        better = total < best
        best[better], first[better], second[better] = total[better], at_one[better], j
    return prefix, first, second


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def _span_hashes(letters: np.ndarray):
    """Hash of letters[:, i:j] for any columns i, j (polynomial, mod 2**64)."""
    n, width = letters.shape
    power, sums = [np.uint64(1)], [np.zeros(n, dtype=np.uint64)]
    with np.errstate(over="ignore"):
        for i in range(width):
            sums.append(sums[-1] * _BASE + letters[:, i] + np.uint64(1))
            power.append(power[-1] * _BASE)
    return lambda rows, i, j: sums[j][rows] - sums[i][rows] * power[j - i]


def _keys(length: int, position: int, right: bool, rows: np.ndarray, spans, long_known: int) -> Iterator[np.ndarray]:
    """Join keys of the bigram at ``position`` in words of equal length, if the
    edit is to the right (else left) of it, for partners of all lengths."""
    known = (0, position + 2) if right else (position, length)
    rest = (position + 2, length) if right else (0, position)
    size = known[1] - known[0]
    for other in (length - 1, length, length + 1):
        longer = max(length, other) - size
        if longer < 1 or other < size:
            continue
        half = longer // 2
        if size >= long_known:
            parts = [(0, 0, 0)]
        else:
            parts = [(1, rest[0], rest[0] + half)] + ([(2, rest[1] - (longer - half), rest[1])] if half else [])
        for kind, i, j in parts:
            tag = (((min(length, other) * 3 + length + other - 2 * min(length, other)) * 64 + size) * 2 + right) * 3 + kind
            with np.errstate(over="ignore"):
                key = _mix(_mix(spans(rows, *known) + np.uint64(tag)) + spans(rows, i, j))
            yield key.view(np.int64)


def _key_batches(ranks: np.ndarray, pivot: bool, long_known: int = LONG_KNOWN):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array([w.encode("latin-1") for w in batch.column("word").to_pylist()], dtype=object)
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            for length in np.unique(lengths).tolist():
                group = np.flatnonzero(lengths == length)
                letters = np.frombuffer(b"".join(words[group]), dtype=np.uint8).reshape(-1, length).astype(np.uint64)
                rank = ranks[(letters[:, :-1] * np.uint64(256) + letters[:, 1:]).astype(np.int64)]
                prefix, first, second = pivots(rank)
                spans, keys, rows = _span_hashes(letters), [], []
                for p in range(length - 1):
                    for right in (True, False):
                        at = np.flatnonzero((first if right else second) == p if pivot else prefix[:, p])
                        if len(at):
                            for key in _keys(length, p, right, at, spans, long_known):
                                keys.append(key)
                                rows.append(group[at])
                taken = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column("word").take(taken)], names=["key", "word"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b, for all words of ``words`` (at least 7 letters up to
    U+00FF each, no repeats) that differ by exactly one letter inserted,
    deleted or replaced."""
    ranks = bigram_ranks(words)
    only = words.select("word")
    asked = only.mapInArrow(_key_batches(ranks, True), "key long, word string").withColumnRenamed("word", "p")
    index = only.mapInArrow(_key_batches(ranks, False), "key long, word string")
    # never broadcast: the planner does not see that a word has many keys
    return (asked.hint("merge").join(index, "key").where("p != word").where(F.levenshtein("p", "word", 1) == 1)
            .select(F.least("p", "word").alias("a"), F.greatest("p", "word").alias("b")).distinct())


# -- forms ----------------------------------------------------------------------

def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the most frequent near word (of equals
    the smallest), if it is at least ``ratio`` times as frequent."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = (both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
            .groupBy("a").agg(F.count("*").alias("k"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("top")))
    often = -F.col("top.m") >= ratio * F.col("n")
    return (words.join(near, F.col("word") == F.col("a"), "left")
            .select("word", "n", F.coalesce("k", F.lit(0).cast("long")).alias("n_near"),
                    F.when(often, F.col("top.b")).alias("form"), F.when(often, -F.col("top.m")).alias("form_n")))


def roots(table: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``table`` (word, n, form, form_n, ...) with ``root``, the last word that
    forms lead to.

    Pointer jumping doubles the steps a round has gone; a chain from a word
    with n occurrences has at most log(largest count / smallest) / log(ratio)
    steps, as every step multiplies the count by ``ratio`` or more.
    """
    linked = stage(table.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    low, high = table.where("form is not null").agg(F.min("n"), F.max("form_n")).first()
    steps = int(math.log(high / low, ratio) + 1e-9) if low else 0
    while steps > 1:
        ahead = linked.select(F.col("word").alias("via"), F.col("root").alias("next"))
        jumped = stage(linked.join(ahead, F.col("root") == F.col("via"), "left")
                       .select("word", F.coalesce("next", "root").alias("root")), "forms")
        drop_stage(linked)
        linked, steps = jumped, -(-steps // 2)
    found = linked.select(F.col("word").alias("w"), "root")
    return table.join(found, F.col("word") == F.col("w"), "left").withColumn("root", F.coalesce("root", "word")).drop("w")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stage(count_words(docs, id_col, text_col), "words")
    table = stage(forms(words, near_pairs(words)), "word-forms")
    return roots(table).select("word", "form", "root", "n", "n_near", "form_n")
