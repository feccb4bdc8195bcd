"""SentencePiece unigram encoding and decoding.

The pieces of a model file and their log scores are put in a double-array trie
over UTF-8 bytes.  Encoding is the Viterbi path of largest total score;
characters that no piece covers are spelt as byte pieces (byte fallback), or
become the unknown piece if the model has none.  Decoding joins pieces, turns
byte runs back into characters and whitespace markers into spaces.

Texts are cut where no piece of the vocabulary can cross (before a whitespace
marker, between letters and punctuation, around line ends; each kind of cut is
checked against the vocabulary when the model is loaded), so a word's best path does
not depend on its neighbours.  Each distinct word of a batch is solved once,
many at a time with numpy, and kept in a bounded cache.

The registered model ``piece_bpe_32k.model`` is of type 2 (BPE): its scores are
minus the merge rank, not log scores, and merging is not built, so the ids are
the best-scored path, not those of the model's own library.

Supported are models without a character map (identity normalisation); others
raise.  Defined results: null text is empty and has no ids; an empty table
gives none; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
CACHE_WORDS = 1_000_000
STEP_BYTES = 8_000_000
# Fixed values of the model format: piece types, and the score gap of an
# unknown character below the worst piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_GAP = 10.0


# -- model files --------------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def load_pieces(path: str) -> tuple[list[tuple[str, float, int]], dict]:
    """Pieces (text, score, type) of a model file, and its normaliser flags."""
    with open(path, "rb") as file:
        data = file.read()
    pieces, flags = [], {"add_dummy_prefix": True, "remove_extra_whitespaces": True, "unk_id": 0}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 3:
            own = dict(_fields(value))
            if own.get(2):
                raise ValueError("models with a character map are not supported")
            flags["add_dummy_prefix"] = bool(own.get(3, 1))
            flags["remove_extra_whitespaces"] = bool(own.get(4, 1))
            if not own.get(5, 1):
                raise ValueError("models without whitespace markers are not supported")
    for i, (_, _, kind) in enumerate(pieces):
        if kind == UNKNOWN:
            flags["unk_id"] = i
    return pieces, flags


# -- double-array trie --------------------------------------------------------

class Trie:
    """A node s has a child t for byte c if t = base[s] + c + 1 and
    check[t] == s; value[t] is the piece that ends there, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        size = 1 << 16
        self.base, self.check, self.value = (np.full(size, -1, dtype=np.int32) for _ in range(3))
        self.base[0] = self.check[0] = 0
        keys = sorted(keys)
        free = 1
        pending = [(0, 0, len(keys), 0)]
        while pending:
            node, low, high, depth = pending.pop()
            if low < high and len(keys[low][0]) == depth:
                self.value[node] = keys[low][1]
                low += 1
            if low >= high:
                continue
            codes, bounds = [], []
            at = low
            while at < high:
                c = keys[at][0][depth]
                codes.append(c)
                bounds.append(at)
                while at < high and keys[at][0][depth] == c:
                    at += 1
            bounds.append(high)
            offsets = np.array(codes) + 1
            low_at, base = free, -1
            while base < 0:
                if low_at + 5000 > len(self.check):
                    self.base, self.check, self.value = (np.concatenate((x, np.full(len(x), -1, dtype=np.int32))) for x in (self.base, self.check, self.value))
                wide = 64 if len(offsets) == 1 else 4096
                slots = np.nonzero(self.check[low_at:low_at + wide] == -1)[0] + low_at - offsets[0]
                slots = slots[slots >= 0]
                fits = (self.check[slots[:, None] + offsets] == -1).all(axis=1)
                if fits.any():
                    base = int(slots[fits.argmax()])
                low_at += wide
            self.base[node] = base
            self.check[base + offsets] = node
            while self.check[free] != -1:
                free += 1
            if len(offsets) > 1:        # crowded places are not searched again
                free = max(free, base + 1 - 2000)
            pending += [(base + c + 1, a, b, depth + 1) for c, a, b in zip(codes, bounds, bounds[1:])]
        used = int(np.nonzero(self.check != -1)[0].max()) + 300
        self.base, self.check, self.value = (np.concatenate((x[:used], np.full(max(0, used - len(x)), -1, dtype=np.int32)))
                                             for x in (self.base, self.check, self.value))

    def prefixes(self, data: bytes, start: int) -> Iterator[tuple[int, int]]:
        """(end, value) of the keys that begin at ``start``."""
        node = 0
        for at in range(start, len(data)):
            if self.base[node] < 0:
                return
            child = self.base[node] + data[at] + 1
            if self.check[child] != node:
                return
            node = child
            if self.value[node] >= 0:
                yield at + 1, int(self.value[node])


def _char_bytes(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


class Model:
    """Pieces, trie and the cuts that the vocabulary allows."""

    def __init__(self, pieces: list[tuple[str, float, int]], flags: dict):
        self.pieces, self.flags = pieces, flags
        self.unk = flags["unk_id"]
        usable = [(p.encode(), i) for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED) and p]
        self.trie = Trie(usable)
        scores = [s for _, s, kind in pieces if kind == NORMAL]
        top, low = (max(scores), min(scores)) if scores else (0.0, 0.0)
        self.scores = np.array([len(p) * top - 0.1 if kind == USER_DEFINED else s for p, s, kind in pieces])
        self.unk_score = low - UNKNOWN_GAP
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.fallback = len(self.bytes) == 256
        self.longest = max((len(p) for p, _ in usable), default=1)
        texts = [p for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED)]
        # where a text may be cut: no piece has these characters side by side
        self.word_cut = not any(re.search(f"[^{MARK}]{MARK}", t) for t in texts)
        cuts = [("(?<=[A-Za-zÀ-ɏ])(?=[.,;:!?\n])", r"[A-Za-zÀ-ɏ][.,;:!?\n]"), (r"(?<=\n)(?=[^\n])", r"\n[^\n]"), (r"(?<=[.,;:!?])(?=\n)", r"[.,;:!?]\n")]
        held = [cut for cut, crossing in cuts if not any(re.search(crossing, t) for t in texts)]
        self.inner_cut = re.compile("|".join(held)) if held else None
        self.surface = [bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN
                        else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        self.slot: dict[str, np.ndarray] = {}

    @classmethod
    def load(cls, path: str) -> Model:
        return cls(*load_pieces(path))

    # -- encoding -------------------------------------------------------------

    def _spell(self, char: bytes) -> list[int]:
        return [self.bytes[b] for b in char] if self.fallback else [self.unk]

    def viterbi(self, data: bytes) -> list[int]:
        """Best path of one word (its UTF-8 bytes), position by position."""
        n = len(data)
        best: list = [0.0] + [None] * n
        back: list = [None] * (n + 1)
        at = 0
        while at < n:
            size = int(_char_bytes(np.array([data[at]]))[0])
            single = False
            for end, piece in self.trie.prefixes(data, at):
                score = best[at] + float(self.scores[piece])
                single |= end == at + size
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (at, piece)
            if not single:
                score = best[at] + self.unk_score
                if best[at + size] is None or score > best[at + size]:
                    best[at + size], back[at + size] = score, (at, -1)
            at += size
            while at < n and best[at] is None:
                at += 1
        out: list[int] = []
        while n:
            start, piece = back[n]
            out = ([piece] if piece >= 0 else self._spell(data[start:n])) + out
            n = start
        return out

    def _solve(self, words: list[bytes]) -> list[np.ndarray]:
        """Best paths of many words of similar length at once."""
        n, longest = len(words), max(map(len, words))
        text = np.zeros((n, longest), dtype=np.int64)
        for i, w in enumerate(words):
            text[i, :len(w)] = np.frombuffer(w, dtype=np.uint8)
        lengths = np.array([len(w) for w in words])
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        best = np.full((n, longest + 5), -np.inf)
        best[:, 0] = 0
        start_of = np.zeros((n, longest + 5), dtype=np.int32)
        piece_of = np.full((n, longest + 5), -1, dtype=np.int32)
        for at in range(longest):
            live = np.nonzero((lengths > at) & np.isfinite(best[:, at]) & ((text[:, at] & 0xC0) != 0x80))[0]
            if not len(live):
                continue
            size = _char_bytes(text[live, at])
            rows, node = live, np.zeros(len(live), dtype=np.int64)
            single = np.zeros(n, dtype=bool)
            size_of = np.zeros(n, dtype=np.int64)
            size_of[live] = size
            for end in range(at + 1, min(longest, at + self.longest) + 1):
                inside = (lengths[rows] >= end) & (base[node] >= 0)
                rows, node = rows[inside], node[inside]
                child = base[node] + text[rows, end - 1] + 1
                good = check[child] == node
                rows, node = rows[good], child[good]
                if not len(rows):
                    break
                piece = value[node]
                ends = piece >= 0
                r, p = rows[ends], piece[ends]
                single[r] |= size_of[r] == end - at
                score = best[r, at] + self.scores[p]
                better = score > best[r, end]
                r, p = r[better], p[better]
                best[r, end], start_of[r, end], piece_of[r, end] = score[better], at, p
            none = live[~single[live]]
            end = at + size_of[none]
            score = best[none, at] + self.unk_score
            better = score > best[none, end]
            none, end = none[better], end[better]
            best[none, end], start_of[none, end], piece_of[none, end] = score[better], at, -1
        out: list[list] = [[] for _ in words]
        place = lengths.copy()
        while True:
            live = np.nonzero(place > 0)[0]
            if not len(live):
                break
            starts, pieces = start_of[live, place[live]], piece_of[live, place[live]]
            for i, s, p, e in zip(live.tolist(), starts.tolist(), pieces.tolist(), place[live].tolist()):
                out[i] += [p] if p >= 0 else reversed(self._spell(words[i][s:e]))
            place[live] = starts
        return [np.array(ids[::-1], dtype=np.int32) for ids in out]

    def _learn(self, words: list[str]) -> None:
        coded = [w.encode() for w in words]
        order = sorted(range(len(words)), key=lambda i: len(coded[i]))
        at = 0
        while at < len(order):
            size = len(coded[order[at]])
            some = [i for i in order[at:at + 20_000] if len(coded[i]) <= max(16, 2 * size)]
            at += len(some)
            if size > 64:
                solved = [np.array(self.viterbi(coded[i]), dtype=np.int32) for i in some]
            else:
                solved = self._solve([coded[i] for i in some])
            self.slot.update(zip((words[i] for i in some), solved))

    def _words(self, text: str) -> list[str]:
        """The normalised text cut where pieces cannot cross."""
        if self.flags["remove_extra_whitespaces"]:
            text = " ".join(p for p in text.split(" ") if p)
        if not text:
            return []
        text = text.replace(" ", MARK)
        if self.flags["add_dummy_prefix"]:
            text = MARK + text
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", text) if self.word_cut else [text]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i]:offsets[i + 1]]."""
        if len(self.slot) > CACHE_WORDS:
            self.slot = {}
        words = pa.array([self._words(t) for t in pc.fill_null(texts, "").to_pylist()], pa.large_list(pa.string()))
        coded = words.flatten().dictionary_encode()
        parts = [self.inner_cut.split(w) if self.inner_cut else [w] for w in coded.dictionary.to_pylist()]
        missing = list(dict.fromkeys(p for own in parts for p in own if p not in self.slot))
        if missing:
            self._learn(missing)
        slot = self.slot
        solved = [slot[own[0]] if len(own) == 1 else np.concatenate([slot[p] for p in own]) for own in parts]
        lengths = np.array([len(s) for s in solved], dtype=np.int64)
        flat = np.concatenate(solved) if solved else np.zeros(0, np.int32)
        index = coded.indices.to_numpy()
        each = lengths[index] if len(solved) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(each)))
        starts = (np.cumsum(lengths) - lengths)[index] if len(solved) else each
        ids = flat[np.repeat(starts - ends[:-1], each) + np.arange(ends[-1])]
        bounds = words.offsets.to_numpy()
        return ids, ends[bounds - bounds[0]]

    # -- decoding -------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join([self.surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.flags["add_dummy_prefix"] and text.startswith(" ") else text


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """This process's model of a file."""
    if path not in _MODELS:
        _MODELS[path] = Model.load(path)
    return _MODELS[path]


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(np.diff(np.cumsum(sizes) // STEP_BYTES))[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids and, with ``verify``, whether
    decoding gives the text back (round_trip)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for part in _slices(batches, "text"):
            ids, offsets = own.encode(part.column("text"))
            arrays = [part.column("id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            names = [id_col, "n_tokens", "ids"]
            if verify:
                texts = part.column("text").to_pylist()
                arrays.append(pa.array([own.decode(ids[a:b]) == (t or "") for t, a, b in zip(texts, offsets, offsets[1:])], pa.bool_()))
                names.append("round_trip")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_col}` {id_type}, n_tokens long, ids array<int>" + (", round_trip boolean" if verify else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id, text.  Null ids give null text."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = [None if ids is None else own.decode(np.array(ids, dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"`{id_col}` {id_type}, text string")
