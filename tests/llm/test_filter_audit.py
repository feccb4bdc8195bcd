"""The filter audit against counting every order document by document."""

import itertools
import random
import re
from collections import Counter
from fractions import Fraction

from ledgerflow.llm import filteraudit
from ledgerflow.llm.queries import ORACLE_SQL, op12_filter_audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
DOCS = "doc_id long, text string, source string, mask string"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(docs, labels):
    good = {d for d, q, _, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t, _ in labels if d is not None and t == 1}
    parts = {}
    for doc, text, source, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {letter for letter, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)),
            doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _, _ in docs))) if bad}
        parts.setdefault(source or "", []).append((failed, doc in good, doc in toxic))
    out, totals = [], Counter()
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                totals[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone),
                            sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)])
    return sorted((*r, totals[r[0], r[1][r[2] - 1]]) for r in out)


def run(spark, docs, labels):
    failed = filteraudit.masks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    return sorted(tuple(r[c] for c in COLUMNS) for r in filteraudit.audit(failed).collect())


def test_shares_are_shapley_values():
    rng = random.Random(3)
    for n in (2, 3, 5):
        v = [0] + [rng.randrange(50) for _ in range((1 << n) - 1)]
        weights = filteraudit.shapley_weights(n)
        for i in range(n):
            gains = []
            for order in itertools.permutations(range(n)):
                before = sum(1 << j for j in order[:order.index(i)])
                gains.append(v[before | 1 << i] - v[before])
            assert sum(w * x for w, x in zip(weights[i], v)) == Fraction(sum(gains), len(gains))


def test_against_counting(spark):
    rng = random.Random(7)
    pool = ["", " \t\n", "word " * 250, " ".join(f"w{i}" for i in range(220)), "ALL CAPS TEXT", "pay $5 & more",
            " ".join(f"w{i}" for i in range(199)), "é è " * 300, " ".join(["A"] + [f"x{i}" for i in range(230)]), None]
    docs = [(i, rng.choice(pool), rng.choice(["a", "b", "", None]), "clash") for i in range(120)]
    docs += [(5, docs[5][1], "a", "again"), (5, "word " * 250, "b", None), (None, "word " * 250, "a", None), (None, None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "t") for i in range(0, 120, 2)]
    labels += [(4, 1, 0, None), (4, 0, 1, None), (None, 1, 1, None), (9999, 1, 1, None)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_edges(spark):
    assert run(spark, [], []) == []
    one = run(spark, [(1, "long " * 60_000, None, None)], [])
    assert len(one) == 600 and one == brute([(1, "long " * 60_000, None, None)], [])


def test_query_has_its_sql(spark):
    assert "op12_filter_audit" in ORACLE_SQL and callable(op12_filter_audit)
