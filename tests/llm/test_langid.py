"""PPM code lengths against a symbol-by-symbol coder; learning and edges."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from ledgerflow.llm import langid
from ledgerflow.llm.common import ship

ORDER = 3
DOCS = "doc_id long, text string, lang string, score double, held_out string, id long"


def tree(texts):
    """context -> byte -> count, contexts of 0 to ORDER bytes."""
    found = defaultdict(lambda: defaultdict(int))
    for text in texts:
        data = bytes(ORDER) + text.encode()
        for i in range(ORDER, len(data)):
            for k in range(ORDER + 1):
                found[data[i - k:i]][data[i]] += 1
    return found


def coded(found, text):
    """Bits of a text, byte by byte, with escapes and exclusion."""
    data, bits = bytes(ORDER) + text.encode(), 0.0
    for i in range(ORDER, len(data)):
        out, byte = set(), data[i]
        for k in range(ORDER, -1, -1):
            counts = {b: n for b, n in found.get(data[i - k:i], {}).items() if b not in out}
            if not counts:
                continue
            total = sum(counts.values()) + len(counts)
            if byte in counts:
                bits -= math.log2(counts[byte] / total)
                break
            bits -= math.log2(len(counts) / total)
            out |= set(counts)
        else:
            bits += math.log2(256 - len(out))
    return bits


def sample(rng, letters, n):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def build(languages):
    per = []
    for texts in languages:
        data, offsets = langid._padded(pa.array(texts), ORDER)
        per.append(np.unique(langid.grams(data, ORDER)[langid._own(offsets, ORDER, len(data))], return_counts=True))
    keys = np.unique(np.concatenate([k for k, _ in per]))
    counts = np.zeros((len(keys), len(per)), dtype=np.int64)
    for i, (k, n) in enumerate(per):
        counts[np.searchsorted(keys, k), i] = n
    return langid.Model([f"l{i}" for i in range(len(per))], keys, counts, ORDER)


def test_code_lengths_are_those_of_a_coder(monkeypatch):
    rng = random.Random(1)
    languages = [sample(rng, "aab é", 30), sample(rng, "abcdñ ", 40), sample(rng, "x", 2) + ["", ""]]
    model = build(languages)
    texts = sample(rng, "aabcdxyé\x00", 60) + ["", "x", "日本語 text", "a" * 500, None]
    want = np.array([[coded(tree(lang), t or "") for lang in languages] for t in texts])
    got = model.lengths(pa.array(texts)) / (1 << 20)
    assert np.allclose(got, want, atol=1e-3)
    monkeypatch.setattr(langid, "STEP_BYTES", 13)
    assert (model.lengths(pa.array(texts)) / (1 << 20) == got).all()


def test_seen_and_unseen_grams_agree():
    rng = random.Random(2)
    model = build([sample(rng, "abc", 20), sample(rng, "bcd ", 20)])
    model.ready()
    assert (model.unseen(model.keys[-1]) == model.cost.T).all()


def test_code_is_complete():
    """The probabilities of all bytes after a context add up to 1."""
    rng = random.Random(3)
    model = build([sample(rng, "abcé", 25), sample(rng, "bxy ", 25)])
    model.ready()
    for context in (b"abc", b"\0\0\0", b"zzz", b"xab", b"\0ab"):
        keys = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], dtype=np.uint64)
        assert np.allclose(np.exp2(-model.unseen(keys) / (1 << 20)).sum(axis=0), 1, atol=1e-4)


def _docs(n=600):
    rng = random.Random(4)
    vocabulary = {lang: [w + s for w in stems for s in ends] for lang, stems, ends in (
        ("en", "the ing wor lis".split(), ["er", "tion", "ly"]), ("de", "sch ung ver ein".split(), ["en", "keit", "ü"]),
        ("fr", "que eau ment les".split(), ["é", "oir", "eux"]))}
    rows = []
    for i in range(n):
        lang = rng.choice(list(vocabulary))
        rows.append((i, " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randint(3, 40))), lang, 0.5, "x", 1))
    return rows


def _run(spark, rows, **options):
    ship(spark)
    docs = spark.createDataFrame(rows, DOCS)
    return langid.identify(docs, langid.train(docs, order=ORDER, **options)).collect()


def test_held_out_accuracy_and_labels_do_not_leak(spark):
    rows = _docs()
    got = {r.doc_id: r for r in _run(spark, rows)}
    held = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert {d for d, r in got.items() if r.held_out} == held
    assert sum(got[r[0]].lang_pred == r[2] for r in rows if r[0] in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    swapped = [(d, t, "zz" if d in held else lang, *rest) for d, t, lang, *rest in rows]
    again = {r.doc_id: r for r in _run(spark, swapped)}
    assert {d: (r.lang_pred, r.score) for d, r in got.items()} == {d: (r.lang_pred, r.score) for d, r in again.items()}


def test_a_small_model_still_predicts(spark, monkeypatch):
    rows = _docs()
    got = _run(spark, rows, train_rows=20, cells=300)
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in got) >= 0.9 * len(rows)
    monkeypatch.setattr(langid, "MODEL_COUNTS", 60)
    got = _run(spark, rows)
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in got) >= 0.9 * len(rows)


def test_edges(spark):
    rows = _docs(300) + [(1000, None, "en", None, None, None), (1001, "", "en", None, None, None), (1002, "12 34 !?", "de", None, None, None),
                         (1003, "schen ungkeit verü einen", None, None, None, None), (None, "queoir eaueux mentoir", "en", None, None, None),
                         (1004, "lesoir queeux " * 50_000, None, None, None, None), (1005, "the' \"x", "", None, None, None)]
    rows += [rows[0], rows[0]]
    got = _run(spark, rows)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003].lang_pred == "de" and by[1004].lang_pred == "fr"
    assert by[None].lang_pred == "fr" and by[None].held_out is False
    assert _run(spark, []) == []
    nothing = _run(spark, [(1, "some text", None, None, None, None), (None, "more", "en", None, None, None)])
    assert {(r.doc_id, r.lang_pred, r.score) for r in nothing} == {(1, "und", 0.0), (None, "und", 0.0)}
