"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ledgerflow.llm import spelling
from ledgerflow.llm.common import ship

DOCS = "doc_id long, text string, word string, n long, key string"


def brute_words(docs):
    counts = Counter()
    upper = {i: i + 32 for i in range(65, 91)}
    for doc, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = brute_words(docs)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def run(spark, docs):
    ship(spark)
    found = spelling.variants(spark.createDataFrame(docs, DOCS)).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in found)


def variants_of(rng, word):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice("abéÿ") + word[k:], word[:k] + rng.choice("abz×") + word[k + 1:]])


def test_against_all_pairs(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 12))) for _ in range(60)]
    base += ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "abababab", "babababa", "ÀÉÎÕÜßÿ", "×÷×÷×÷×", "Strasse", "strasse" * 12]
    docs = []
    for i in range(300):
        words = [rng.choice(base[:20]) for _ in range(rng.randint(0, 30))] + [rng.choice(base) for _ in range(5)]
        words += [variants_of(rng, rng.choice(base)) for _ in range(4)]
        docs.append((i, rng.choice([" ", "\n", "1", "’", "Ā"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words), "w", 1, None))
    docs += [(None, docs[0][1], None, None, "k"), (None, None, None, None, None), (7, "", "", 0, ""), docs[3], docs[3]]
    want = brute(docs)
    assert run(spark, docs) == want
    assert sum(w[1] != "" for w in want) > 20 and sum(w[4] for w in want) > 100


def test_chains_of_forms(spark):
    words = [("abcdefgh", 2), ("abcdefghi", 25), ("abcdefghij", 300), ("abcdefghijk", 3100), ("abcdefghijkl", 32000), ("zbcdefghijkl", 32000)]
    table = spark.createDataFrame(words, "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.roots(spelling.forms(table, spelling.near_pairs(table))).collect()}
    assert got["abcdefgh"] == ("abcdefghi", "abcdefghijkl", 1)
    assert got["abcdefghijk"] == ("abcdefghijkl", "abcdefghijkl", 2)
    assert got["abcdefghijkl"] == (None, "abcdefghijkl", 2)


def test_empty_table_and_very_long_texts(spark):
    assert run(spark, []) == []
    long = [(1, "verylong words " * 100_000, "", 0, ""), (2, "x" * 300_000 + " " + "verylonk " * 3, "", 0, "")]
    assert run(spark, long) == brute(long)


def test_steps_cut_between_runs(monkeypatch):
    text = "éÉé longword Añejoñññ, " * 50 + "À" * 40
    whole = Counter()
    for words, n in spelling.count_batch(["3", None], pa.array([text, text[::-1]]), 2):
        whole.update(dict(zip(words.to_pylist(), n.tolist())))
    monkeypatch.setattr(spelling, "STEP_BYTES", 7)
    parts = Counter()
    for words, n in spelling.count_batch(["3", None], pa.array([text, text[::-1]]), 2):
        parts.update(dict(zip(words.to_pylist(), n.tolist())))
    assert whole == parts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=6, max_size=12))
def test_pivots_are_the_rarest_disjoint_pair_of_the_prefix(ranks):
    prefix, first, second = spelling.pivots(np.array([ranks], dtype=np.int32))
    last = sorted(ranks)[2]
    assert prefix[0].tolist() == [r <= last for r in ranks]
    pairs = [(ranks[i] + ranks[j], i, j) for i in range(len(ranks)) for j in range(i + 2, len(ranks)) if ranks[i] <= last and ranks[j] <= last]
    i, j = int(first[0]), int(second[0])
    assert (ranks[i] + ranks[j], i, j) in pairs and ranks[i] + ranks[j] == min(pairs)[0]
