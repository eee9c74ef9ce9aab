import math
import random
import re

import numpy as np

from riskloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    counts = []
    for i, text in docs:
        c = {}
        for t in cut(text):
            c[t] = c.get(t, 0) + 1
        counts.append((i, c))
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = {}
    for _, c in counts:
        for t in c:
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(cut(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in counts:
            score = 0
            if c:
                m = 50 + (50 * sum(c.values()) * n_docs) // length
                for t in terms & c.keys():
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k=50, **kw):
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, term string, n int").repartition(3)
    q = spark.createDataFrame([(a, b, 2) for a, b in items], "item_id long, text string, block int")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(d, q, k=k, **kw).collect()), key=str)


def test_terms():
    text = "Ab-9 ÀÉß_x\x00漢字 é  İ.K'"
    assert [t.decode() for t in lexical.terms_of(text)] == cut(text)
    assert lexical.terms_of(None) == lexical.terms_of("") == lexical.terms_of(" ,.\n") == []


def test_interval_search_is_exact_and_skips_documents():
    rnd = np.random.default_rng(1)
    n = 3000
    doc, term = np.unique(np.stack([rnd.integers(0, n, 30_000), rnd.zipf(1.3, 30_000) % 60]), axis=1)
    impact = rnd.integers(1, 1000, len(doc)) * (1 + term)
    impact[doc % 7 == 0] = 500  # many ties
    lists = lexical.Lists(doc, term, impact, n)
    fewer = 0
    for wanted in ([3], [1, 2, 5, 9], [0, 40, 59, 77], list(range(60)), [99]):
        scores = np.zeros(n, dtype=np.int64)
        for t in wanted:
            scores[doc[term == t]] += impact[term == t]
        order = [d for d in np.lexsort((np.arange(n), -scores)) if scores[d] > 0][:10]
        docs, got, scored = lists.best(np.array(wanted), 10)
        assert docs.tolist() == order and got.tolist() == scores[order].tolist()
        fewer += scored < (scores > 0).sum()
    assert fewer >= 3


def test_matches_brute_force(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(80)] + ["É", "漢字", "The", "THE", "the"]
    weights = [1 / (1 + i) for i in range(len(words))]
    docs = [(i, " ".join(rnd.choices(words, weights, k=rnd.randint(1, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[4][1]) for i in range(100)] + [docs[5], docs[5]]     # copies, repeated rows
    docs += [(2000, None), (2001, ""), (2002, " ...\n"), (None, docs[6][1]), (2003, "w1 " * 50_000)]
    items = [(i, " ".join(rnd.choices(words, k=12))) for i in range(12)]
    items += [(50, docs[4][1]), (51, None), (52, ""), (53, "nowhere"), (3, "w7 w8"), (54, "w1 w1 W1"), (None, "w2 w3")]
    want = brute(docs, items, 20)
    assert run(spark, docs, items, 20) == want
    assert run(spark, docs, items, 20, query_block=3, segment=200) == want


def test_none(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    assert run(spark, [(1, "a a b"), (2, "b")], [(1, "A")]) == brute([(1, "a a b"), (2, "b")], [(1, "A")], 50)
