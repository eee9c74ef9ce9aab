import random

import numpy as np

from riskloom.llm import pathjoin, wordsets


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    sets = sorted({shingles(t) for _, t in rows}, key=lambda s: sorted(s))
    parent = {s: s for s in sets}
    links = {s: 0 for s in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    ids = {}
    for i, t in rows:
        ids.setdefault(root(shingles(t)), []).append(i)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((i, least[root(shingles(t))], links[shingles(t)]) for i, t in rows), key=str)


def corpus():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))

    def edit(t, k):
        w = t.split()
        for _ in range(k):
            w[rnd.randrange(len(w))] = word()
        return " ".join(w)
    rows = [(i, text(rnd.choice([3, 6, 20, 100, 400]))) for i in range(150)]
    hot = text(200)
    rows += [(200 + i, edit(hot, rnd.randint(0, 5))) for i in range(150)]       # a large group of near copies
    rows += [(400 + i, rows[rnd.randrange(150)][1]) for i in range(60)]          # exact copies
    rows += [(500 + i, edit(text(150), 0)) for i in range(5)]
    passage = text(60)
    rows += [(600 + i, text(80) + " " + passage + " " + text(80)) for i in range(80)]  # a shared passage, no near copies
    rows += [(800, None), (801, ""), (802, " \n"), (803, "a b"), (804, "a  b"), (None, rows[5][1]), (805, text(30000)), (805, "x y z")]
    rows += [(805, "x y z"), (806, rows[3][1].replace(" ", "\n"))]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, links int, sig string").repartition(4)
    want = brute(rows)
    for how in ({}, {"small": 4, "depth": 2, "block": 16}):
        got = pathjoin.join_documents(df, **how).collect()
        assert sorted([(r.doc_id, r.class_id, r.links) for r in got], key=str) == want
    assert pathjoin.join_documents(df.limit(0)).count() == 0


def test_one_of_each_stays(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words"), (1, "a b c d e f g"), (None, None), (4, None), (5, "p q r s t")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, first int")
    got = pathjoin.first_of_each(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "a b c d e f g"), (2, "other words"), (4, None), (5, "p q r s t")]


def test_similar_pairs_and_forest():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 40)).astype(np.uint64)) for _ in range(40)]
    near = wordsets.similar_pairs(sets, 0.5)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = set(a.tolist()), set(b.tolist())
            assert near[i, j] == (i != j and len(x & y) >= 0.5 * len(x | y))
    part = wordsets.similar_pairs(sets, 0.5, 10)
    assert (part[:10, 10:] == near[:10, 10:]).all() and not part[:10, :10].any() and not part[10:, 10:].any()


def test_runs():
    assert pathjoin.runs_for(0.999) == 7 and pathjoin.runs_for(0.5) == 1


def test_recall_of_threshold_pairs_in_large_buckets(spark, monkeypatch):
    assert pathjoin.runs_for(0.999, depth=2) == 11 and pathjoin.runs_for(0.999, depth=3) == 15
    used, plain = [], pathjoin.coarse_edges
    monkeypatch.setattr(pathjoin, "coarse_edges", lambda sets, runs, *how: used.append(runs) or plain(sets, runs, *how))
    pathjoin.join_documents(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"))
    assert used == [15]
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):  # every token is in a third of the sets, so no bucket is small before the last split
        sig = rng.integers(0, 3, wordsets.HASHES).astype("<u4")
        near = sig.copy()
        near[rng.permutation(wordsets.HASHES)[:13]] += 7
        rows += [(2 * i, 0, sig.tobytes()), (2 * i + 1, 0, near.tobytes())]
    df = spark.createDataFrame([(a, b, bytearray(s)) for a, b, s in rows], "c1 long, c2 long, sig binary").repartition(4)
    found = {r.node.c1: r.component.c1 for r in pathjoin.components(plain(df, used[0], 4, 3).selectExpr(
        "struct(a1 AS c1, a2 AS c2) AS a", "struct(b1 AS c1, b2 AS c2) AS b")).collect()}
    assert sum(2 * i in found and found[2 * i] == found.get(2 * i + 1) for i in range(300)) >= 0.99 * 300
