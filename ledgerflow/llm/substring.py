"""Substring de-duplication over sliding runs of sentences.

From every sentence on, the run of ``RUN`` consecutive sentences, or of as many
more as make ``MIN_WORDS`` words, is hashed (XXH64 of its words, case and
spacing ignored).  A run's first occurrence is that in the smallest doc_id, and there the earliest; sentences
covered by any other occurrence are removed.  What is left of a text is the
untouched remainder, byte for byte; a text without repeats does not change.

Sentences end at closing punctuation, blank lines, and before a capitalised
word that follows a lower-case one (text pasted into the middle of a sentence
starts so).  A single line end is white space like any other, so wrapped and
reflowed copies are cut alike.  Sentences over ``LONG`` words are cut further after words chosen
by their own hash (at least ``LONG // 3`` and at most ``2 * LONG`` words from
the cut before), so that both copies of a long passage are soon cut alike
wherever it stands.  ``RUN`` and ``LONG`` are small enough that a passage of
just over 50 words pasted from and into the middle of sentences holds a run;
the partial sentences at its two ends stay.

In scripts without spaces between words (Chinese, Japanese, Thai, Lao, Khmer,
Burmese, Tibetan and others of ``_DENSE``) sentences also end at full-width
closing marks with no white space after them, and every character is cut and
hashed as a word of its own; ``MIN_WORDS`` counts two such characters as one
word, so that a name of some 20 characters is no run.

Work: one scan writes (hash, id, place) of every run, marked if the same run
came before in the text; a minimum per hash, with map-side combining, finds
first occurrences; a join on
the hash (no aggregation above it, so adaptive execution splits a hot run)
gives the places to remove, and one join on the id brings them to the texts.
Only texts that lose something are cut again.

Defined results: null text stays null and counts as empty; rows sharing a
doc_id are one document (what repeats between them stays, what they repeat
from smaller ids goes, also if the rows are equal); a null doc_id comes after
all others; an empty table gives none; other columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from .common import fresh, stage

RUN = 2
MIN_WORDS = 12
LONG = 12
_UPPER = "".join(chr(c) for c in range(0x530) if chr(c).isupper())
_LOWER = "".join(chr(c) for c in range(0x530) if chr(c).islower())
_SCRIPTS = ("\u0e00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035\u303b\u3040-\u312f\u31a0-\u31bf"
            "\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00016fe0-\U00018d8f\U0001aff0-\U0001b16f\U00020000-\U0003ffff")
_DENSE = re.compile(f"[{_SCRIPTS}]")
_CUT = re.compile(rf"(?:(?<=[.!?…。！？])|(?<=[.!?][\"')\]»”]))\s+|(?<!\s)[^\S\n]*\n[^\S\n]*\n\s*|(?<=[{_LOWER},;:])\s+(?=[{_UPPER}])"
                  r"|(?<=[。！？｡])[」』）】》〉”’\"')\]»]*+\s*+(?![。！？｡])")
_WORD = re.compile(r"\S+\s*")
_DENSE_WORD = re.compile(rf"[{_SCRIPTS}][^\s\w]*+|[^\s{_SCRIPTS}]+")
_DENSE_PIECE = re.compile(rf"(?:[{_SCRIPTS}][^\s\w]*+|[^\s{_SCRIPTS}]+)\s*")


def _dense(text: str) -> bool:
    return not text.isascii() and _DENSE.search(text) is not None


def _words(part: str) -> tuple[list[str], int]:
    """Words of a sentence, and how many half words they count as."""
    if not _dense(part):
        words = part.split()
        return words, 2 * len(words)
    words = _DENSE_WORD.findall(part)
    return words, sum(1 if _DENSE.match(w) else 2 for w in words)


def sentences(text: str) -> list[str]:
    """Cut a text into sentences; joined, they are the text again."""
    parts, at = [], 0
    for m in _CUT.finditer(text):
        if m.end() > at:
            parts.append(text[at:m.end()])
            at = m.end()
    if at < len(text):
        parts.append(text[at:])
    out: list[str] = []
    for part in parts:
        words, _ = _words(part)
        if not words and out:
            out[-1] += part
        elif len(words) <= LONG:
            out.append(part)
        else:
            pieces, begin = (_DENSE_PIECE if _dense(part) else _WORD).findall(part), 0
            lead = len(part) - sum(map(len, pieces))
            pieces[0] = part[:lead] + pieces[0]
            for i, word in enumerate(words[:-1]):
                held = i + 1 - begin
                if held >= 2 * LONG or held >= LONG // 3 and zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % 3 == 0:
                    out.append("".join(pieces[begin:i + 1]))
                    begin = i + 1
            out.append("".join(pieces[begin:]))
    return out


def spans(parts: list[str], run: int = RUN, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """(start, stop) of the run that begins at every sentence, as far as the
    text has enough sentences and words after it; and the words."""
    plain, halves = zip(*(_words(p.lower()) for p in parts)) if parts else ((), ())
    total = np.concatenate(([0], np.cumsum(halves))).astype(np.int64)
    starts = np.arange(max(0, len(parts) - run + 1))
    stops = np.maximum(starts + run, np.searchsorted(total, total[starts] + 2 * min_words))
    return starts[stops <= len(parts)], stops[stops <= len(parts)], plain


def runs(parts: list[str], run: int = RUN, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, stop) of every run of ``spans``."""
    starts, stops, plain = spans(parts, run, min_words)
    joined = [" ".join(w) for w in plain]
    hashed = xxhash.xxh64_intdigest
    codes = np.fromiter((hashed(" ".join(joined[i:j]).encode("utf-8", "surrogatepass")) for i, j in zip(starts.tolist(), stops.tolist())),
                        dtype=np.uint64, count=len(starts))
    return codes.view(np.int64), starts, stops


def _remainder(text: str | None, removed: list[int] | None, run: int, min_words: int) -> str | None:
    """The text without the runs that begin at the sentences ``removed``."""
    if text is None or removed is None:
        return text
    parts = sentences(text)
    starts, stops, _ = spans(parts, run, min_words)
    covered = np.zeros(len(parts), dtype=bool)
    end = dict(zip(starts.tolist(), stops.tolist()))
    for at in removed:
        covered[at:end.get(at, at)] = True
    return "".join(p for p, c in zip(parts, covered) if not c)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs of sentences removed from the text column."""
    id_type = docs.schema[id_col].dataType.simpleString()
    mark = F.pmod(F.coalesce(F.xxhash64(text_col), F.lit(0)), F.lit(1 << 31))

    def places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows, places, again = [], [], [], []
            for i, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("mark").to_pylist())):
                if not text:
                    continue
                codes, starts, _ = runs(sentences(text), run, min_words)
                repeat = np.ones(len(codes), dtype=bool)
                repeat[np.unique(codes, return_index=True)[1]] = False
                hashes.append(codes)
                places.append((own << 32) + starts)
                rows.append(np.full(len(codes), i))
                again.append(repeat)
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes)), batch.column("id").take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate(places)), pa.array(np.concatenate(again))], names=["h", "id", "place", "again"])

    places = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), mark.alias("mark"))
                   .mapInArrow(places_of, f"h long, id {id_type}, place long, again boolean"), "sentence-runs")
    distinct = places.where("not again")
    firsts = (distinct.groupBy("h").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select(F.col("h").alias("rh"), "first"))
    repeats = (distinct.join(firsts, F.col("h") == F.col("rh"))
               .where(F.col("id").isNull() | (F.col("id") != F.col("first"))).select("id", "place"))
    repeats = repeats.unionByName(places.where("again").select("id", "place"))
    names = docs.columns
    rid, rmark, at, own = (fresh(n, names) for n in ("removed_id", "removed_mark", "removed_at", "own_mark"))
    removed = (repeats.groupBy(F.col("id").alias(rid), F.shiftright("place", 32).alias(rmark))
               .agg(F.collect_set(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")).alias(at)))

    @F.pandas_udf(StringType())
    def remainder(texts: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([_remainder(t, None if a is None else list(a), run, min_words) for t, a in zip(texts, at)], dtype=object)

    marked = docs.withColumn(own, mark)
    joined = marked.join(removed, F.col(id_col).eqNullSafe(F.col(rid)) & (F.col(own) == F.col(rmark)), "left")
    # texts with nothing to remove do not pass through Python again
    cut = F.when(F.col(at).isNull(), F.col(text_col)).otherwise(remainder(F.when(F.col(at).isNotNull(), F.col(text_col)), F.col(at)))
    return joined.select(*[cut.alias(c) if c == text_col else F.col(c) for c in names])
