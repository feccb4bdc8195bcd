"""Fast whole-text encoding with a public BPE tokenizer file.

The word tokenizer cuts at white space before anything else, so a text's ids
are its white-space words' ids in order.  ``WordEncoder`` encodes each distinct
word of a batch once with the tokenizers library, keeps the ids in a bounded
cache, and lays them out for all occurrences with numpy.  The ids equal those
of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that an encoder keeps (some 285 MB); when full, it starts anew.
CACHE_WORDS = 1_000_000
#: Bytes of text encoded at once (memory bound of a batch).
STEP_BYTES = 8_000_000
#: The same for jobs whose Python workers also serve other stages: some 75 MB
#: of words and small steps, for about half as much more CPU time.
SMALL = {"cache_words": 250_000, "step_bytes": 2_000_000}
_TAIL = ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes bytes as letters: printable Latin-1 characters
    stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Ids of texts under one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.cache_words = CACHE_WORDS
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {"": 0}
        self.start = np.zeros(1024, dtype=np.int64)
        self.length = np.zeros(1024, dtype=np.int64)
        self.flat = np.zeros(4096, dtype=np.uint32)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        model, plain = self.model, [w.isalpha() and max(w) < "ɐ" and w == w.lower() for w in words]
        whole = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        # lower-case Latin letters are one pre-token that nothing normalises
        encoded = [[t.id for t in model.tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS))] if p else next(whole).ids
                   for w, p in zip(words, plain)]
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        first, total = len(self.slot), int(lengths.sum())
        while first + len(words) > len(self.start):
            self.start, self.length = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.length))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.start[first:first + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.length[first:first + len(words)] = lengths
        self.flat[self.used:self.used + total] = np.fromiter((i for e in encoded for i in e), dtype=np.uint32, count=total)
        self.used += total
        self.slot.update(zip(words, range(first, first + len(words))))

    @staticmethod
    def _parts(word: str) -> tuple[str, str]:
        """A word as (stem, closing punctuation) where the tokenizer cuts there
        too, Latin stems in lower case as it would make them."""
        stem = word.rstrip(_TAIL)
        # (not after İ: its lower case ends in a mark, which joins the punctuation)
        if stem and stem[-1] < "ɐ" and stem[-1] != "İ" and (stem[-1].isalpha() or "0" <= stem[-1] <= "9") and "<|" not in word:
            return (stem.lower() if max(stem) < "ɐ" and "İ" not in stem else stem), word[len(stem):]
        return word, ""

    def _slots(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._parts(w) for w in words]
        if len(self.slot) > self.cache_words:
            self._reset()
        missing = list(dict.fromkeys(x for pair in parts for x in pair if x not in self.slot))
        if missing:
            self._learn(missing)
        slot = self.slot
        return (np.fromiter((slot[a] for a, _ in parts), dtype=np.int64, count=len(parts)),
                np.fromiter((slot[b] for _, b in parts), dtype=np.int64, count=len(parts)))

    def _gather(self, slots: np.ndarray) -> np.ndarray:
        return _spread(self.flat, self.start[slots], self.length[slots])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, offsets int64): text i has ids[offsets[i]:offsets[i+1]];
        null is empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        flat = words.flatten().dictionary_encode()
        stems, tails = self._slots(flat.dictionary.to_pylist())
        each = np.stack((stems, tails), axis=1).ravel()
        ids = self._gather(each)
        lengths = self.length[stems] + self.length[tails]
        starts = np.cumsum(lengths) - lengths
        index = flat.indices.to_numpy()
        out = _spread(ids, starts[index], lengths[index])
        ends = np.concatenate(([0], np.cumsum(lengths[index])))
        bounds = words.offsets.to_numpy().astype(np.int64)
        return out, ends[bounds - bounds[0]]


def _spread(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of flat[starts[i]:starts[i] + lengths[i]]."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(total)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder of a tokenizer file (a cache of its words)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_batches(batches: Iterator[pa.RecordBatch], text: str, path: str, step_bytes: int = STEP_BYTES,
                   cache_words: int = CACHE_WORDS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids, offsets) for slices of at most ``step_bytes`` of text (one
    longer text is a slice of its own)."""
    enc = encoder(path)
    enc.cache_words = cache_words
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        step = (np.cumsum(sizes) // step_bytes).astype(np.int64)
        cuts = [0, *(np.nonzero(np.diff(step))[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            ids, offsets = enc.encode(part.column(text))
            yield part, ids, offsets
        pa.default_memory_pool().release_unused()
