"""HNSW search, spherical caps, WARC, packed ids, SentencePiece and extraction."""

import base64
import gzip
import hashlib
import html
import io
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import caps, extract, hnsw, idpack, sentencepiece, warc
from ledgerflow.llm.components import forest
from ledgerflow.llm.dom import Page
from ledgerflow.llm.queries import PIECES, tokenizer_path

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, node int, low int, copies int, filter int, id int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], y, 1, 2, 3, 4, 5) for i, v, y in rows], VECTORS)


def mixture(n, d=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[n // 2:] = x[:n - n // 2] + 0.05 * rng.standard_normal((n - n // 2, d)).astype(np.float32)
    x[-20:] = x[0]
    return x


ODD = [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] + [1.0] * 23, 1), (9004, [float("inf")] + [1.0] * 23, 1),
       (9005, [None] + [1.0] * 23, 1), (9006, [1.0, 2.0], 1), (9007, [], 1), (None, [1.0] * 24, 1)]


# -- search -------------------------------------------------------------------

def exact(x, ids, query, k):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u[query], 12)
    order = [i for i in np.lexsort((ids, -s)) if i != query]
    return ids[order[:k]].tolist()


def test_search_recall_ranks_and_scores(spark):
    x = mixture(900)
    rows = [(i, v, 1) for i, v in enumerate(x.tolist())]
    got = hnsw.nearest(vectors(spark, rows + ODD), F.col("vec_id") % 50 == 0, shard=256).collect()
    ids, hits, total = np.arange(900), 0, 0
    for q in range(0, 900, 50):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all((a.score, -a.vec_id) >= (b.score, -b.vec_id) for a, b in zip(own, own[1:]))
        for r in own:
            a, b = x[q].astype(float), x[r.vec_id].astype(float)
            assert r.vec_id != q and abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        hits += len({r.vec_id for r in own} & set(exact(x, ids, q, 5)))
        total += 5
    assert hits / total >= 0.98
    # copies of the query come first, the smallest ids among them
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)] == list(range(880, 885))


def test_search_few_rows_repeats_and_empty(spark):
    rows = [(0, [1, 0], 1), (1, [1, 0.1], 1), (1, [1, 0.1], 1), (50, [0, 1], 1)]
    got = sorted((r.query_id, r.rank, r.vec_id) for r in hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert hnsw.nearest(vectors(spark, rows).where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert hnsw.nearest(vectors(spark, rows[:1]), F.col("vec_id") % 50 == 0).count() == 0


def test_shards_grow_with_the_table_and_large_ones_find_the_same():
    assert [hnsw.shard_rows(n) for n in (0, 10_000, 524_288, 1_000_000, 10 ** 12)] == [4096, 4096, 4096, 7812, 32_768]
    x = np.random.default_rng(4).standard_normal((9000, 48)).astype(np.float32)
    q = x[:9000:50]
    found = hnsw.search(x, hnsw.build(x), q)[:, :6]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = np.argsort(-(u[:9000:50] @ u.T), axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(found.tolist(), true.tolist())]) >= 0.97


def test_every_node_of_a_layer_is_reachable():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal((60, 8)) * 0.01 + 10 * rng.standard_normal(8) for _ in range(6)]).astype(np.float32)
    for _, offsets, links in hnsw._layers(hnsw.build(x)):
        n = len(offsets) - 1
        assert len(np.unique(forest(np.repeat(np.arange(n), np.diff(offsets)), links.astype(np.int64), n))) == 1


# -- near duplicates ------------------------------------------------------------

def brute_links(rows):
    """(id, n_links, component) with all pairs compared."""
    good = [i for i, (_, v, y) in enumerate(rows) if y is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links = {i: [] for i in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                p, q = (np.array(np.float32(rows[i][1]), dtype=float) for i in (a, b))
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.98:
                    links[a].append(b)
    pairs = [(a, b) for a, to in links.items() for b in to]
    label = forest(np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.int64), len(rows))
    out = []
    for i, (own, _, _) in enumerate(rows):
        names = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        component = min(names, default=None)
        out.append((own, len(links[i]), component, own == component))
    return sorted(map(str, out))


def test_caps_equal_brute_force(spark, monkeypatch):
    x = mixture(400, seed=5)
    rows = [(i, v, i % 3) for i, v in enumerate(x.tolist())] + [(1000 + i, v, None) for i, v in enumerate(x[:3].tolist())] + ODD
    rows += [(7, x[7].tolist(), 7 % 3), (8, (2 * x[8]).tolist(), 8 % 3)]
    got = sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in caps.near_duplicates(vectors(spark, rows)).collect())
    assert got == brute_links(rows)
    # buckets cut into blocks count the same
    monkeypatch.setattr(caps, "BUCKET", 3)
    got = sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in caps.near_duplicates(vectors(spark, rows)).collect())
    assert got == brute_links(rows)


def test_caps_empty(spark):
    assert caps.near_duplicates(vectors(spark, ODD).where("false")).count() == 0


@pytest.mark.parametrize("size", [(2, 64), (3, 17)])
def test_list_decode_equals_trying_all_directions(size):
    x = np.random.default_rng(3).standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = caps.list_decode(x, size)
    for i in range(len(x)):
        want = []
        for number in range(caps.ROTATIONS[size[0]]):
            rotation, codes, blocks, alpha = caps._code(16, size, number)
            assert len(blocks) == size[0]
            sums = np.zeros(())
            for b, block in enumerate(blocks):
                sums = sums[..., None] + codes[b] @ (x[i] @ rotation)[block]
            own = np.argwhere(sums >= alpha)
            if not len(own):
                own = np.argwhere(sums == sums.max())
            for place in own.tolist():
                found = number
                for part in place:
                    found = found * size[1] + part
                want.append(found)
        assert got[i].tolist() == sorted(want)


def test_alpha_lets_the_stated_number_pass():
    x = np.random.default_rng(9).standard_normal((300, 64))
    for nodes in (10_000, caps.THREE_BLOCKS, 5_000_000):
        found = np.mean([len(f) for f in caps.list_decode(x / np.linalg.norm(x, axis=1, keepdims=True), caps.code_size(nodes))])
        assert 0.7 < found / (caps.ROTATIONS[caps.code_size(nodes)[0]] * caps.FILTERS) < 1.4


@pytest.mark.parametrize("nodes", [10_000, caps.THREE_BLOCKS, caps.THREE_BLOCKS + 1, 5_000_000, 1_000_000_000])
def test_caps_recall_at_every_code_size(nodes):
    """Pairs at cosine 0.9801 share a filter, whatever the table's size."""
    rng = np.random.default_rng(12)
    x, other = rng.standard_normal((2, 400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.9801 * x + np.sqrt(1 - 0.9801 ** 2) * other
    size = caps.code_size(nodes)
    assert size[1] ** size[0] >= 16 * nodes
    met = [bool(np.intersect1d(p, q).size) for p, q in zip(caps.list_decode(x, size), caps.list_decode(y, size))]
    assert np.mean(met) >= 0.995


def test_rows_that_share_a_smaller_filter():
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(0, 60, size=int(n))) for n in rng.integers(0, 9, size=70)]
    held = caps._Lists(lists)
    a, b = (g.ravel() for g in np.meshgrid(np.arange(70), np.arange(70)))
    want = np.array([bool(set(lists[p].tolist()) & set(lists[q].tolist())) for p, q in zip(a, b)])
    assert (held.meet(a[a != b], b[a != b]) == want[a != b]).all()
    full = held.meet_all(10, 60)
    for p in range(50):
        for q in range(50):
            assert p == q or full[p, q] == bool(set(lists[p + 10].tolist()) & set(lists[q + 10].tolist()))


# -- WARC -------------------------------------------------------------------------

def test_archives_round_trip(spark):
    big = "<p>" + "x" * 700_000 + "</p>"
    rows = [(5, "http://a/x y%20\n", "<p>ä</p>"), (3, None, "<p>ä</p>"), (9, "u", None), (8, "u", ""), (None, "n", "<p>ä</p>"), (7, "ü", big), (3, "again", "<p>ä</p>"), (6, "v", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("refers_to", F.lit(2))
    manifest = warc.write_archives(pages)
    got = warc.read_archives(spark, manifest).collect()
    assert len(got) == len(rows) and all(r.digests_match for r in got)
    first = {"<p>ä</p>": 3, "": 8, big: 7, "only": 6}
    want = []
    for i, url, h in rows:
        body = (h or "").encode()
        revisit = i != first[h or ""]
        want.append(str((i, url, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None)))
    assert sorted(str((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(want)
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == set(first)
    for r in manifest.collect():           # a plain gzip reader sees the records, one member each
        with open(r.file.removeprefix("file://"), "rb") as f:
            data = f.read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r.n_records == data.count(b"\x1f\x8b\x08\x00\x00")
    # payloads below the bound are all responses
    small = warc.read_archives(spark, warc.write_archives(pages, min_bytes=1), payloads=False)
    assert small.where("payload_bytes = 0 and record_type = 'response'").count() == 2
    assert warc.read_archives(spark, warc.write_archives(pages.where("false"))).count() == 0


@pytest.mark.parametrize("step", [1, 7, 1 << 18])
def test_reader_is_incremental_and_checks_frames(step):
    body = os.urandom(5000)
    one = warc.gzip_member(warc.record("1", "u", body, warc.base32_sha1(body), None, "1970-01-01T00:00:00Z"))
    two = warc.gzip_member(warc.record("2", None, body, warc.base32_sha1(body), "1", "1970-01-01T00:00:00Z"))
    got = list(warc.read_records(io.BytesIO(one + two), step=step))
    assert [r["record_type"] for r in got] == ["response", "revisit"] and got[0]["payload"] == body
    assert got[1]["payload_bytes"] == 5000 and all(r["digests_match"] for r in got)
    with pytest.raises((EOFError, ValueError)):
        list(warc.read_records(io.BytesIO((one + two)[:-30]), step=step))
    bad = warc.gzip_member(warc.record("1", "u", body, warc.base32_sha1(b"other"), None, "1970-01-01T00:00:00Z"))
    assert [r["digests_match"] for r in warc.read_records(io.BytesIO(bad), step=step)] == [False]
    plain = warc.record("1", "u", body, warc.base32_sha1(body), None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(warc.gzip_member(plain + b"more")), step=step))


# -- packed ids ---------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2 ** b - 1), max_size=70))))
def test_bits_round_trip(case):
    bits, ids = case
    data = idpack.pack_bits(np.array(ids, dtype=np.uint32), bits)
    assert len(data) == (len(ids) * bits + 7) // 8
    assert idpack.unpack_bits(data, bits, len(ids)).tolist() == ids


def test_width_and_overflow():
    assert [idpack.width(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        idpack.pack_bits(np.array([8], dtype=np.uint32), 3)


@pytest.mark.parametrize("bits", [5, 16, 17])
def test_file_random_access(scratch, bits):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 2 ** bits, n).astype(np.uint32) for n in (0, 3, 100, 1, 257)]
    writer = idpack.Writer("file://" + scratch + "/x.ids", bits, block=64)
    writer.add(["a", None], np.concatenate(docs[:2]), np.array([0, 3]))
    writer.add(["b", "c", "d"], np.concatenate(docs[2:]), np.array([100, 1, 257]))
    assert writer.close(pa.string()) == (5, 361)
    reader, whole = idpack.Reader("file://" + scratch + "/x.ids"), np.concatenate(docs)
    assert reader.docs().column("id").to_pylist() == ["a", None, "b", "c", "d"]
    for a, b in ((0, 361), (63, 65), (64, 64), (300, 999), (5, 6)):
        assert reader.ids(a, b).tolist() == whole[a:b].tolist()


def test_files_hold_all_documents_in_order(spark):
    from tokenizers import Tokenizer

    rows = [(i, "word " * (i % 7) + f"Text {i}, end.") for i in range(60, 0, -1)] + [(61, None), (62, ""), (63, "same"), (63, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("start", F.lit(0)).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        files = idpack.write_ids(docs, tokenizer_path(), file_ids=100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted(idpack.read_ids(spark, files).collect(), key=lambda r: r.start)
    library, at = Tokenizer.from_file(tokenizer_path()), 0
    assert files.count() > 1
    for r, (i, text) in zip(got, sorted(rows, key=lambda r: r[0]), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    assert idpack.read_ids(spark, idpack.write_ids(docs.where("false"), tokenizer_path())).count() == 0


# -- SentencePiece ------------------------------------------------------------------

@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.model(tokenizer_path(PIECES))


def best_score(model, data):
    """Largest total score over all cuts of the text, byte by byte."""
    table = {p.encode(): s for (p, s, k) in model.pieces if k == sentencepiece.NORMAL}
    best = {0: 0.0}
    chars = [i for i in range(len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
    for n, end in enumerate(chars[1:], 1):
        options = [best[s] + table[data[s:end]] for s in chars[:n] if data[s:end] in table]
        if data[chars[n - 1]:end] not in table:
            options.append(best[chars[n - 1]] + model.unk_score)
        best[end] = max(options)
    return best[len(data)]


def test_paths_have_the_best_score(pieces):
    rng = random.Random(4)
    texts = ["", "the", "hello world, e.g. www.com", "  two  spaces ", "ünïcödé straße", "日本語🎉\n\nline.", "x" * 90, "a,b.c!d?"]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz .,\né", k=60)) for _ in range(40)]
    ids, offsets = pieces.encode(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:]):
        data = ("▁" + text.replace(" ", "▁")).encode() if text else b""
        own, score, i = ids[a:b].tolist(), 0.0, 0
        while i < len(own):     # a byte run is one unknown character at a time
            kind = pieces.pieces[own[i]][2]
            if kind == sentencepiece.BYTE:
                lead = int(pieces.pieces[own[i]][0][1:-1], 16)
                i += 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                score += pieces.unk_score
            else:
                score += pieces.scores[own[i]]
                i += 1
        assert score == pytest.approx(best_score(pieces, data), abs=1e-6), text
        assert pieces.decode(ids[a:b]) == text


def test_trie_holds_exactly_the_pieces(pieces):
    keys = {p.encode(): i for i, (p, _, k) in enumerate(pieces.pieces) if k == sentencepiece.NORMAL}
    for key, number in list(keys.items())[::7]:
        found = dict(pieces.trie.prefixes(key, 0))
        assert found == {n: keys[key[:n]] for n in range(1, len(key) + 1) if key[:n] in keys} and found[len(key)] == number


def test_encode_and_decode_tables(spark):
    path = tokenizer_path(PIECES)
    rows = [(1, "Hello,  wörld\n"), (1, "Hello,  wörld\n"), (None, "x"), (2, None), (3, ""), (4, "z" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("id", F.lit(2))
    encoded = sentencepiece.encode(docs, path, verify=True)
    assert encoded.where("round_trip and size(ids) = n_tokens").count() == 6
    back = sentencepiece.decode(encoded, path)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t in rows)
    assert sentencepiece.encode(docs.where("false"), path).count() == 0


# -- extraction -----------------------------------------------------------------------

def test_given_pages_give_their_articles():
    rows = duckdb.sql(f"select html from '{SF}/pages.parquet'").fetchall()

    def article(source):
        inner = re.sub(r"</?(p|h1|br)[^>]*>", " ", re.search(r"<article>(.*?)</article>", source, re.S)[1])
        return " ".join(html.unescape(re.sub(r"<[^>]+>", "", inner)).split())

    got = extract.main_texts([h for h, in rows], extract.train())
    assert np.mean([g == article(h) for g, (h,) in zip(got, rows)]) >= 0.98


def test_held_out_layouts():
    """Word-level F1 on layouts the trees were not fitted on."""
    pages = [extract.layout(seed) for seed in range(90_000, 90_080)]
    scores = []
    for got, (_, truth) in zip(extract.main_texts([h for h, _ in pages], extract.train()), pages):
        a, b = got.split(), truth.split()
        common = sum(min(a.count(w), b.count(w)) for w in set(a))
        scores.append(2 * common / max(1, len(a) + len(b)))
    assert np.mean(scores) >= 0.93


def test_decoding_never_keeps_within_a_dropped_element():
    page = Page("<div><p>a</p><div><p>b</p><p>c</p></div></div>")
    nodes = page.nodes()
    rng = np.random.default_rng(0)
    for _ in range(200):
        margin = rng.normal(0, 3, len(nodes))
        kept = extract.decode(page, nodes, margin)
        assert all(kept[page.parent[i]] or not kept[i] for i in range(1, len(page.tag)))
        # brute force over all consistent choices (the page itself is kept)
        best, free = -np.inf, [k for k, n in enumerate(nodes) if n]
        for bits in range(2 ** len(free)):
            choice = {int(nodes[k]): bool(bits >> j & 1) for j, k in enumerate(free)} | {0: True}
            if all(choice[page.parent[i]] or not choice[i] for i in choice if i):
                value = sum(-np.logaddexp(0, -m if choice[int(n)] else m) for n, m in zip(nodes, margin) if n)
                best = max(best, value)
        own = sum(-np.logaddexp(0, -m if kept[n] else m) for n, m in zip(nodes, margin) if n)
        assert own == pytest.approx(best)


def shown(source):
    page = Page(source)
    return page.text(~page.hidden())


def test_nothing_is_lost_behind_raw_elements():
    assert shown("İ" * 40 + "<script>x()</script>Main text of the page.<p>next") == "İ" * 40 + "Main text of the page. next"
    assert shown("<p>İİ</p><STYLE>p{}</Style ><p>a</p><Script>'<p>'</SCRIPT>b") == "İİ a b"
    for tag in ("svg", "math", "SVG"):
        assert shown(f"<p>a <{tag} class='i' /> b</p><p>c</p>") == "a b c"
        assert shown(f"<p>a <{tag}/> b <{tag}><title>t</title></{tag}> c</p>") == "a b c"
    assert shown("<p>a</p><script src='x'/>hidden</script><p>b</p>") == "a b"     # a script is never empty


def test_extraction_edges(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words &amp; more"), (None, "u", "<p>x"), (4, "u", "<p title='unclosed>text</p> a < b"), (5, "u", deep),
            (6, "u", "<article><p>one<br>two</p><script>var a='</p>';</script><p>a&nbsp;b<b>c</b>d</p></article>"), (6, "u", "<!-- only -->"), (7, "u", "<script>never closed")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("id", F.lit(1))
    got = extract.extract(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got if r.page_id in (1, 2, 3, 7)}
    assert texts == {1: "", 2: "", 3: "plain words & more", 7: ""}
    assert sorted(r.text for r in got if r.page_id == 6) == ["", "one two a bcd"]
    assert extract.extract(pages.where("false")).count() == 0
