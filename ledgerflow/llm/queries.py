"""The registered queries of the operators: name -> (spark, sf_dir) -> rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    from . import extract

    return extract.extract(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 tokens."""
    from . import packing

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without sentences of repeated runs."""
    from . import substring

    docs = table(spark, sf_dir, "documents")
    return substring.remove_repeats(docs.select("doc_id", "text"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of all documents."""
    from . import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with a piece model, and decoded again."""
    from . import sentencepiece

    return sentencepiece.encode(table(spark, sf_dir, "documents"), tokenizer_path(PIECES), verify=True)


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    from pyspark.sql import functions as F

    from . import hnsw

    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    from . import warc

    found = warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages")), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digests_match")


def op8_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate classes of all embeddings."""
    from . import caps

    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to bit-packed files and read back."""
    from pyspark.sql import functions as F

    from . import idpack

    files = idpack.write_ids(table(spark, sf_dir, "documents"), tokenizer_path())
    return idpack.read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, by the learned context trees."""
    from . import langid

    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removals of five filters under all their orders, by source."""
    from . import filteraudit

    failed = filteraudit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filteraudit.audit(failed)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of all words of all documents."""
    from . import spelling

    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_extraction, op2_packing, op3_substring_dedup, op4_sentencepiece, op5_hnsw, op6_simhash, op7_warc, op8_spherical_caps,
                                   op9_token_files, op10_toxicity, op11_language_id, op12_filter_audit, op13_spelling_variants)}
_USABLE = """vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0"""

#: SQL where it can state the operator's result.  Tokenizer ids, XXH64 majority
#: bits and trained models are beyond it; tests hold those against brute force.
#: (op5 states the exact neighbours.)
ORACLE_SQL: dict[str, str] = {
    "op5_hnsw": f"""
WITH v AS (SELECT {_USABLE} AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.x, c.x) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op7_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, TRUE AS digests_match
FROM d""",
    "op8_spherical_caps": f"""
WITH RECURSIVE v AS (SELECT {_USABLE} AND label IS NOT NULL),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id""",
    "op12_filter_audit": r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, coalesce(l.good, 0) AS good, coalesce(l.bad, 0) AS bad,
             [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
              100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first, FALSE)] AS f
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
m AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM d GROUP BY part, f),
i AS (SELECT unnest(range(1, 6)) AS k),
p AS (SELECT [a.k, b.k, c.k, e.k, g.k] AS o FROM i a, i b, i c, i e, i g
      WHERE len(list_distinct([a.k, b.k, c.k, e.k, g.k])) = 5),
s AS (SELECT part, o, k AS step, n, good, bad, f[o[k]] AS fails,
             len(list_filter(o[:k - 1], lambda x: f[x])) > 0 AS gone, len(list_filter(f, lambda x: x)) = 1 AS one
      FROM m, p, i),
r AS (SELECT part, o, step, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails AND one THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails AND NOT gone THEN bad ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM r""",
    "op13_spelling_variants": r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step
  FROM range(256) r(i)),
u AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS x FROM documents),
r AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM u WHERE length(x) >= 7 GROUP BY ALL),
b AS (SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [195, unicode(ch) - 64] END)) AS bytes FROM r),
h AS (SELECT run, n, xor(list_reduce([4294967295] || list_transform(bytes, lambda y: CAST(y AS BIGINT)),
        lambda c, y: xor(c >> 8, t.step[(xor(c, y) & 255) + 1])), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
         UNION SELECT d.word, v.word FROM d JOIN v ON v.word = d.less
         UNION SELECT v.word, d.word FROM d JOIN v ON v.word = d.less),
k AS (SELECT near.a, near.b, v.n AS m, count(*) OVER (PARTITION BY near.a) AS k,
             row_number() OVER (PARTITION BY near.a ORDER BY v.n DESC, near.b) AS place FROM near JOIN v ON v.word = near.b),
f AS (SELECT v.word, v.n, coalesce(k.k, 0) AS n_near, CASE WHEN k.m >= 10 * v.n THEN k.b END AS form, CASE WHEN k.m >= 10 * v.n THEN k.m END AS form_n
      FROM v LEFT JOIN k ON k.a = v.word AND k.place = 1),
c AS (SELECT word, word AS root FROM f UNION SELECT c.word, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM f JOIN c ON c.word = f.word JOIN f g ON g.word = c.root AND g.form IS NULL""",
}
