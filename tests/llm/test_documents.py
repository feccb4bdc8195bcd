"""Toxicity, SimHash, substring dedup, packing and the pipeline: against brute
force, on defined edge cases, and on planted documents."""

import collections
import os
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerflow.llm import packing, simhash, substring, toxicity
from ledgerflow.llm.common import scratch, shared_dir, stage
from ledgerflow.llm.components import components, forest
from ledgerflow.llm.queries import QUERIES, tokenizer_path
from ledgerflow.llm.tokens import WordEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mark string, fp int, id int, place int, at int, score int"
SF = "/root/testdata/sf0.001"


def documents(spark, texts):
    """Rows (id, text) with extra columns whose names clash with inner ones."""
    rows = [(i, t, "en", "s", None, "m", 1, 2, 3, 4, 5) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


def sentences_of(rng, n):
    return " ".join(prose(rng, rng.randint(4, 9)).capitalize() + "." for _ in range(n))


# -- components ---------------------------------------------------------------

@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
                                   [(i, (i * 7) % 90) for i in range(90)] + [(500, 400), (400, 300), (500, 400)]])
def test_components_equal_local_forest(spark, links):
    got = {r.node: r.root for r in components(spark.createDataFrame(links or [(1, 1)], "a long, b long")).collect()}
    n = 600
    label = forest(np.array([a for a, _ in links], dtype=np.int64), np.array([b for _, b in links], dtype=np.int64), n)
    assert got == {i: int(label[i]) for i in range(n) if label[i] != i}


# -- staged tables --------------------------------------------------------------

def test_scratch_deletes_what_was_staged_but_the_kept(spark):
    root = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with scratch(spark) as outer:
        with scratch(spark) as kept:
            stage(spark.range(3), "gone")
            inner = stage(spark.range(4), "stays")
            kept.append(inner)
        assert inner.count() == 4 and len(set(os.listdir(root)) - before) == 1
    assert set(os.listdir(root)) == before
    with pytest.raises(ValueError), scratch(spark):
        stage(spark.range(3), "gone")
        raise ValueError
    assert set(os.listdir(root)) == before


# -- SimHash ------------------------------------------------------------------

def slow_fingerprint(text):
    table = {c: chr(c + 32) for c in range(65, 91)}
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    codes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def test_simhash_equals_brute_force(spark):
    rng = random.Random(1)
    base = [prose(rng, n) for n in (1, 2, 3, 60, 200, 400)]
    texts = base + [None, "", " \t\n", "ÄÖ Über  x y", "A b C", "a B c", base[4] + " tail", base[5].replace("a", "A", 1), base[3]]
    words = base[5].split()
    texts += [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in range(0, 400, 40)]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(5, base[5])]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()]
    prints = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    label = forest(a, b, len(rows))
    small = collections.defaultdict(list)
    for (i, _), g in zip(rows, label):
        small[g] += [i] if i is not None else []
    want = [(i, f"{int(p):016x}", min(small[g], default=None)) for (i, _), p, g in zip(rows, prints, label)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_vantage_tree_finds_every_link():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, size=4000, dtype=np.uint64)
    near = x[:600] ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    dense = np.array([int(x[7]) ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)], dtype=np.uint64)
    x = np.unique(np.concatenate((x, near, dense)))
    pairs = [np.nonzero(np.bitwise_count(x[i, None] ^ x[i + 1:]) <= 3)[0] + i + 1 for i in range(len(x))]
    a = np.repeat(np.arange(len(x)), [len(p) for p in pairs])
    want = forest(a, np.concatenate(pairs), len(x))
    tree = simhash.build_tree(x[::3], 300, 3)
    row, shard = simhash.route(x, tree, 3)
    assert len(tree) > 3 and set(row) == set(range(len(x)))
    found_a, found_b = [], []
    for s in np.unique(shard):
        p, q = simhash.search_shard(x[row[shard == s]], 3)
        found_a.append(np.searchsorted(x, p))
        found_b.append(np.searchsorted(x, q))
    assert (forest(np.concatenate(found_a), np.concatenate(found_b), len(x)) == want).all()


def test_dense_shards_are_cut_into_blocks(spark):
    rng = np.random.default_rng(3)
    center = int(rng.integers(0, 1 << 62))
    dense = sorted({center ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)})
    fps = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in dense], "fp long")
    got = simhash.fingerprint_components(fps, 3, shard_points=50).collect()
    assert len(got) == len(dense) - 1 and len({r.root for r in got}) == 1


def test_keep_one_leaves_one_row_of_a_group_and_all_columns(spark):
    rng = random.Random(5)
    a, b = prose(rng, 300), prose(rng, 300)
    docs = documents(spark, [(9, a), (4, a + " x"), (4, a + " x"), (7, b), (None, prose(rng, 50)), (1, None), (2, "")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "7", "None"]
    assert simhash.keep_one(docs.where("false")).count() == 0
    assert simhash.near_duplicates(docs.where("false")).count() == 0


# -- substring dedup ----------------------------------------------------------

def test_sentences_join_to_the_text():
    rng = random.Random(2)
    for text in ("", " ", "\n\n", "One. Two? Three!", "word " * 100, prose(rng, 500), sentences_of(rng, 30), "a,\nb\n\n c. D e F", "日本語。次。"):
        assert "".join(substring.sentences(text)) == text


def brute_repeats(rows):
    """The documented result, run by run, over (id, text) sorted with nulls last."""
    first, out = {}, []
    known = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, text in known:
        parts = substring.sentences(text or "")
        codes, _, _ = substring.runs(parts)
        for code in codes.tolist():
            if i is not None:
                first.setdefault(code, i)
    for i, text in known:
        parts = substring.sentences(text or "")
        codes, starts, stops = substring.runs(parts)
        gone, seen = set(), set()
        for code, a, b in zip(codes.tolist(), starts.tolist(), stops.tolist()):
            if code in seen or code in first and first[code] != i:
                gone.update(range(a, b))
            seen.add(code)
        out.append((i, None if text is None else "".join(p for k, p in enumerate(parts) if k not in gone)))
    return out


def test_substring_equals_brute_force_and_catches_planted_passages(spark):
    rng = random.Random(7)
    passage, long_one = sentences_of(rng, 9), prose(rng, 70).capitalize() + "."
    clean = [(i, sentences_of(rng, 12)) for i in range(10, 16)]
    rows = clean + [(1, sentences_of(rng, 4) + " " + passage + " " + sentences_of(rng, 3)),
                    (2, sentences_of(rng, 2) + " and then " + passage + " " + prose(rng, 30)),
                    (3, prose(rng, 12) + " " + long_one + " " + prose(rng, 5)), (4, sentences_of(rng, 2) + "\n" + long_one),
                    (5, (sentences_of(rng, 4) + "\n") * 3), (6, None), (7, ""), (None, passage), (8, "word " * 3000)]
    got = [(r.doc_id, r.text) for r in substring.remove_repeats(documents(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_repeats(rows)))
    texts = dict(got)
    assert all(texts[i] == t for i, t in clean)
    assert passage in texts[1] and long_one in texts[3]
    for i, p in ((2, passage), (4, long_one), (None, passage)):
        words = p.split()
        grams = [" ".join(words[k:k + 13]) for k in range(len(words) - 12)]
        assert sum(g in texts[i] for g in grams) <= 1, i


def test_substring_repeated_rows_and_empty_table(spark):
    text = sentences_of(random.Random(9), 8)
    docs = documents(spark, [(1, text), (1, text), (2, text)])
    got = substring.remove_repeats(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, text), (1, text), (2, "")]
    assert substring.remove_repeats(docs.where("false")).count() == 0


def even_prose(rng, n, low, high):
    """n words in sentences of low to high words."""
    out = []
    while len(out) < n:
        words = prose(rng, rng.randint(low, high)).split()
        out += [words[0].capitalize(), *words[1:-1], words[-1] + "."]
    return out[:n]


def common_words(a, b):
    """The longest run of equal words of a and b, word by word."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


@pytest.mark.parametrize("low, high", [(13, 16), (10, 16), (12, 20), (30, 60)])
def test_substring_finds_passages_of_just_over_50_words_pasted_mid_sentence(spark, low, high):
    rng, rows, planted = random.Random(11), [], {}
    for i in range(40):
        source, host = even_prose(rng, 200, low, high), even_prose(rng, 200, low, high)
        begin, at = rng.randint(20, 100), rng.randint(20, 150)
        planted[100 + i] = source[begin:begin + 51], host, at
        rows += [(i, " ".join(source)), (100 + i, " ".join(host[:at] + source[begin:begin + 51] + host[at:])),
                 (200 + i, " ".join(even_prose(rng, 150, low, high)))]
    got = {r.doc_id: r.text for r in substring.remove_repeats(documents(spark, rows)).collect()}
    left = 0
    for i, (passage, host, at) in planted.items():
        words = got[i].split()
        rest = len(words) - len(host)
        assert words[:at] == host[:at] and words[len(words) - 200 + at:] == host[at:]   # only the passage is cut
        assert rest < 51 and common_words(passage, words) < 40, i
        left += rest
    assert left < 0.35 * 51 * len(planted)
    assert all(got[i] == t for i, t in rows if i not in planted)    # first copies and clean texts stay


@pytest.mark.parametrize("low, high", [(6, 14), (10, 20)])
def test_substring_ignores_where_lines_are_wrapped(spark, low, high):
    rng, rows, planted = random.Random(12), [], {}
    for i in range(30):
        passage = even_prose(rng, (60, 120, 300)[i % 3], low, high)
        before, after = even_prose(rng, 40, low, high), even_prose(rng, 40, low, high)
        planted[100 + i] = passage, before, after
        wrapped = textwrap.fill(" ".join(before + passage + after), (72, 40)[i % 2])
        rows += [(i, " ".join(passage)), (100 + i, wrapped if i % 5 else wrapped.replace("\n", "\r\n"))]
    got = {r.doc_id: r.text for r in substring.remove_repeats(documents(spark, rows)).collect()}
    for i, (passage, before, after) in planted.items():
        words = got[i].split()
        assert words[:40] == before and words[-40:] == after
        assert len(words) - 80 <= 40, i
    assert all(got[i] == t for i, t in rows if i not in planted)
    assert substring.sentences("a b\nc d\n \ne f.\ng") == ["a b\nc d\n \n", "e f.\n", "g"]


@pytest.mark.parametrize("letters, mark", [("".join(map(chr, range(0x4E00, 0x4F00))), "。"), ("".join(map(chr, range(0x3042, 0x3094))), "！"),
                                           ("".join(map(chr, range(0x0E01, 0x0E2F))), ""), ("".join(map(chr, range(0x1780, 0x17A3))), "")], ids=["han", "kana", "thai", "khmer"])
def test_substring_in_scripts_without_spaces(spark, letters, mark):
    rng, rows, planted = random.Random(13), [], {}

    def page(n, low=8, high=30):
        out = ""
        while len(out) < n:
            out += "".join(rng.choices(letters, k=rng.randint(low, high))) + mark
        return out[:n]

    name = page(16, 40, 40)
    for i in range(20):
        source, host, at = page(400), page(300), rng.randint(50, 250)
        planted[100 + i] = source[150:250], host, at
        rows += [(i, source), (100 + i, host[:at] + source[150:250] + host[at:]), (200 + i, source), (300 + i, "\n".join(textwrap.wrap(source, 30))),
                 (400 + i, page(200) + name + page(200))]
    texts = {i: t for i, t in rows}
    got = {r.doc_id: r.text for r in substring.remove_repeats(documents(spark, rows)).collect()}
    for i, (passage, host, at) in planted.items():
        assert got[i].startswith(host[:at - 3]) and got[i].endswith(host[at + 3:]) and len(got[i]) <= 300 + 60, i
        assert len(got[100 + i]) < 24 and len(got[200 + i]) < 24 + 30, i    # less than a run can stay at the end
    assert all(got[i] == t for i, t in texts.items() if i < 100 or i >= 400)
    assert all("".join(substring.sentences(t)) == t for t in texts.values())


def test_full_width_marks_end_sentences():
    assert substring.sentences("「好。」他说！？次。 end") == ["「好。」", "他说！？", "次。 ", "end"]


# -- tokens and packing ---------------------------------------------------------

def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    library, own = Tokenizer.from_file(path), WordEncoder(path)
    texts = ["", None, " ", "Hello, World! it's e.g. U.S.A.,.", "x<|endoftext|>y, <|endoftext|>.", "ÄÖÜ straße ΣΟΦΟΣ, İstanbul.", "don't 'tis we'll,ok", "a1b2, 3.14; 50%.",
             "日本語、テスト。 🎉!", "\x1c\x85 x y", "é é, ñ.", "tab\tnew\nline\r\n", "ŉandu ÀÉÎ ŁÓDŹ. ǅ Ŀ ﬁ İi ẞ ªº µ K", "e\u0301 E\u0301. \u0301x", "...!!! ,,, a.b.c"] + [prose(random.Random(i), 80) for i in range(5)]
    ids, offsets = own.encode(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_sum_of_squares_choice_is_the_best_one():
    rng = np.random.default_rng(4)
    packer = packing.Packer(64, max_open=10_000)
    for size in rng.integers(1, 64, 400).tolist():
        def cost(level):
            counts = packer.levels.copy()
            if level:
                counts[level] -= 1
            if level + size < 64:
                counts[level + size] += 1
            return int((counts[1:64] ** 2).sum())
        options = [0] + [h for h in range(1, 64 - size + 1) if packer.levels[h]]
        least = min(map(cost, options))
        assert packer.best_level(size) == max(h for h in options if cost(h) == least)
        packer.add(0, np.zeros(size, dtype=np.uint32))


@pytest.mark.parametrize("max_open", [2, 2048])
def test_packer_places_every_id_once(max_open):
    rng = np.random.default_rng(6)
    packer, docs = packing.Packer(64, max_open), []
    for i, size in enumerate([1, 64, 128, 63, 33, 33, 33, *rng.integers(1, 300, 200).tolist()]):
        docs.append(np.arange(size, dtype=np.uint32) + 1000 * i)
        packer.add(i, docs[-1])
    packer.finish()
    fills = [sum(len(ids) for _, _, ids in w) for w in packer.done]
    assert max(fills) <= 64 and sum(f < 64 for f in fills) <= 1
    pieces = collections.defaultdict(list)
    for window in packer.done:
        for doc, start, ids in window:
            pieces[doc].append((start, ids))
    for i, ids in enumerate(docs):
        assert np.concatenate([p for _, p in sorted(pieces[i], key=lambda p: p[0])]).tolist() == ids.tolist()


def test_packing_pieces(spark):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    rows = [(i, prose(rng, n)) for i, n in enumerate((1, 5, 900, 4000, 30, 2))] + [(None, "x"), (3, None), (50, ""), (50, "")]
    pieces = packing.pack(documents(spark, rows), tokenizer_path()).collect()
    library = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows)
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    for p in pieces:
        assert len(p.ids) == p.length and p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
        assert any(i == p.doc_id and list(ids[p.start:p.start + p.length]) == p.ids and len(ids) == p.doc_tokens for i, ids in want)
    by = collections.defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(documents(spark, rows).where("false"), tokenizer_path()).count() == 0


# -- toxicity -------------------------------------------------------------------

def planted(spark, n=600, seed=3):
    rng = random.Random(seed)
    bad = ["vile", "scoundrel", "rotten"]
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(5, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for w in bad[:rng.randint(1, 3)]:
                words.insert(rng.randrange(len(words) + 1), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_held_out_accuracy_and_no_leak(spark):
    rows, labels = planted(spark)
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    want = dict(labels)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i, _ in rows)
    assert np.mean([got[i].predicted == want[i] for i in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    # held-out labels do not change the model, the held-out fold is never read
    flipped = table.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(docs, flipped)
    assert again.bias == model.bias and (again.buckets == model.buckets).all() and (again.weights == model.weights).all()
    clean = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    assert clean == {i for i, r in got.items() if not r.predicted}


def test_toxicity_edges(spark):
    rows, labels = planted(spark, 200)
    docs = documents(spark, rows + [(None, "vile rotten scoundrel"), (1000, None), (1001, ""), (1002, "... !"), (1002, "... !")])
    table = spark.createDataFrame(labels + [(0, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, table)).collect()
    assert len(scored) == 205 and all(r.score is not None for r in scored)
    assert [r.held_out for r in scored if r.doc_id is None] == [False]
    none = toxicity.train(docs, table.where("false"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.where("false"), none).count() == 0


def plain_ftrl(texts, labels):
    """FTRL-proximal feature by feature, in dictionaries."""
    def bucket_set(text):
        codes = [xxhash.xxh64_intdigest(w.strip(toxicity._TRIM)) for w in text.lower().split() if w.strip(toxicity._TRIM)]
        found = {c % toxicity.BUCKETS for c in codes}
        for gap in (1, 2, 3):
            found |= {((a * 0x9E3779B97F4A7C15 + b * (2 * gap + 1)) % 2 ** 64 >> 17) % toxicity.BUCKETS for a, b in zip(codes, codes[gap:])}
        return found

    sets = [bucket_set(t) for t in texts]
    seen = collections.Counter(f for s in sets for f in s)
    rows = [sorted(f for f in s if seen[f] > 1) + ["bias"] for s in sets]
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(f):
        l1 = 0.0 if f == "bias" else toxicity.L1
        if abs(z[f]) <= l1:
            return 0.0
        return (np.sign(z[f]) * l1 - z[f]) / ((toxicity.BETA + n[f] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for features, y in zip(rows, labels):
            own = {f: weight(f) for f in features}
            g = 1 / (1 + np.exp(-np.clip(sum(own.values()), -30, 30))) - y
            for f, w in own.items():
                z[f] += g - ((n[f] + g * g) ** 0.5 - n[f] ** 0.5) / toxicity.ALPHA * w
                n[f] += g * g
    return {f: weight(f) for f in list(z) if weight(f)}


def test_fit_equals_plain_ftrl():
    rng = random.Random(8)
    # few words, so that many n-grams come often enough to pass L1
    vocabulary = [prose(rng, 1) for _ in range(12)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) + " (!) Vile," * (i % 4 == 0) for i in range(300)]
    labels = np.array([float("Vile" in t) for t in texts])
    labels[::37] = 1 - labels[::37]
    kept, weights, bias = toxicity.fit(pa.array(texts, pa.large_string()), labels)
    want = plain_ftrl(texts, labels)
    assert len(kept) > 20 and bias == pytest.approx(want.pop("bias"), rel=1e-9)
    assert dict(zip(kept.tolist(), weights.tolist())) == pytest.approx(want, rel=1e-7)


def test_toxicity_learns_from_bounded_texts_whatever_repeats(spark):
    rows, labels = planted(spark, 300)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), table)

    def same(other):
        return np.array_equal(other.buckets, model.buckets) and np.array_equal(other.weights, model.weights) and other.bias == model.bias

    assert same(toxicity.train(documents(spark, rows * 3).repartition(7), table))
    # rows after the bound on bytes, and very long texts, are not learned from but scored
    half = toxicity.train(documents(spark, rows), table, train_bytes=sum(len(t) for _, t in rows) // 3)
    assert not same(half)
    long = documents(spark, rows + [(10_002, "vile rotten scoundrel " * 60_000)])
    labelled = spark.createDataFrame(labels + [(10_002, 0)], "doc_id long, toxic int")
    assert zlib.crc32(b"10002") % 5 and same(toxicity.train(long, labelled))
    assert toxicity.score(long, model).where("doc_id = 10002").first().predicted == 1


# -- the pipeline -----------------------------------------------------------------

def test_pipeline_stages_keep_the_columns_and_do_their_work(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    state = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        following = corpus_pipeline.stage(function(spark, state, SF), name)
        assert following.columns == columns and 0 < following.count() <= n
        state = following
    # one of each near-duplicate group is left
    assert simhash.near_duplicates(state.select("doc_id", "text")).where("doc_id != component_id").count() <= 3
    pieces = corpus_pipeline.STAGES[-1][1](spark, state, SF)
    assert pieces.select("doc_id").distinct().count() == state.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "packing"]


def slow_score(text, model):
    """The score of one text, feature by feature."""
    weights = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    codes = []
    for word in re.split(r"[ \t\n\r\x0b\x0c]+", (text or "").lower()):
        word = word.strip(toxicity._TRIM)
        if word and xxhash.xxh64_intdigest(word):
            codes.append(xxhash.xxh64_intdigest(word))
    found = {c % toxicity.BUCKETS for c in codes}
    for gap in (1, 2, 3):
        for a, b in zip(codes, codes[gap:]):
            found.add(((a * 0x9E3779B97F4A7C15 + b * (2 * gap + 1)) % 2 ** 64 >> 17) % toxicity.BUCKETS)
    return 1 / (1 + np.exp(-np.clip(model.bias + sum(weights.get(f, 0.0) for f in found), -30, 30)))


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(i, t) for i, t in rows if slow_score(t, model) < 0.5]
    prints = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    label = forest(a, b, len(rows))
    smallest = {g: min(i for (i, _), h in zip(rows, label) if h == g) for g in set(label.tolist())}
    rows = [(i, t) for (i, t), g in zip(rows, label) if smallest[g] == i]
    library = Tokenizer.from_file(tokenizer_path())
    want = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in brute_repeats(rows)}
    got = collections.defaultdict(list)
    for p in corpus_pipeline.run(spark, SF).collect():
        got[p.doc_id].append((p.start, p.ids))
    assert {i: [x for _, ids in sorted(parts) for x in ids] for i, parts in got.items()} == want


def test_pipeline_edges_and_cleared_stages(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    def run(rows, labels, name):
        folder = tmp_path / name
        documents(spark, rows).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame(labels, "doc_id long, toxic int, text string, y int, lang string").write.parquet(str(folder / "labels.parquet"))
        return corpus_pipeline.run(spark, str(folder))

    assert run([], [], "empty").collect() == []

    rng = random.Random(5)
    rows, labels = planted(spark, 300)
    labels = [(i, y, "x", 1, None) for i, y in labels] + [(None, 1, None, None, None), (3, None, None, None, None)]
    # few words: a hundred thousand different n-grams would hit weights by their hash
    words = [prose(rng, 1) for _ in range(30)]
    kept_text = sentences_of(rng, 9)
    long_text = " ".join(" ".join(rng.choices(words, k=rng.randint(4, 9))).capitalize() + "." for _ in range(6000))
    odd = [(None, sentences_of(rng, 8)), (1000, None), (1001, ""), (1002, " \n "), (1003, kept_text), (1003, kept_text),
           (1004, kept_text), (1005, long_text), (1006, "vile scoundrel rotten"), (None, "vile rotten scoundrel")]
    before = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    pieces = run(rows + odd, labels, "odd").collect()
    made = set(os.listdir(shared_dir(spark).removeprefix("file://"))) - before
    assert [m.rsplit("-", 1)[0] for m in made] == ["substring_dedup"]     # what the result is read from

    got = collections.defaultdict(list)
    for p in pieces:
        got[p.doc_id].append((p.start, p.ids))
    texts = {i: [x for _, ids in sorted(parts) for x in ids] for i, parts in got.items()}
    library = Tokenizer.from_file(tokenizer_path())
    encoded = {t: library.encode(t, add_special_tokens=False).ids + [2] for t in (odd[0][1], kept_text, long_text)}
    # one of the repeated rows stays, of texts without words the smallest id, toxic ones go
    assert texts[None] == encoded[odd[0][1]] and texts[1003] == encoded[kept_text] and texts[1005] == encoded[long_text]
    assert texts[1000] == [2] and not {1001, 1002, 1004, 1006} & texts.keys()


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES] == list(range(1, 14))
