import math
import random

import numpy as np

from riskloom.llm import bitslices as B

NAN, INF = float("nan"), float("inf")


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, set()).add(tuple(B.whole(x) for x in v))
    out = set()
    for q in ok:
        if q % every == 0:
            near = []
            for i in ok:
                s = [sum(a * b for a, b in zip(x, y)) for x in ok[q] for y in ok[i] if len(x) == len(y)]
                if i != q and s:
                    near.append((-max(-2 ** 63, min(2 ** 63 - 1, max(s))), i))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])}
    return out


def run(spark, rows, k, every, **kw):
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<double>, stripe int").repartition(3)
    got = B.top_products(df, k=k, query_every=every, **kw).collect()
    out = {(r.query_id, r["rank"], r.vec_id, r.score) for r in got}
    assert len(out) == len(got)
    return out


def test_bitmap_arithmetic():
    rnd = np.random.default_rng(2)
    values, weights = rnd.integers(0, 200, (150, 6)), np.array([3, 0, 7, 1, 12, 5])
    slices = B._slices(values, 8).view(np.uint64)
    columns = {}
    for p in range(4):
        for j in range(8):
            columns.setdefault(p + j, []).append(slices[weights >> p & 1 == 1, j])
    total = B.add_up([np.concatenate(columns[w]) for w in sorted(columns)], slices.shape[2])
    bits = [np.unpackbits(t.view(np.uint8), bitorder="little")[:150].astype(int) for t in total]
    want = values @ weights
    assert (sum(b << w for w, b in enumerate(bits)) == want).all()
    alive = np.packbits(np.arange(192) < 150, bitorder="little").view(np.uint64)
    for k in (1, 5, 150):
        kth = B.kth_largest(total, alive, k)
        assert kth == sorted(want, reverse=True)[k - 1]
        found = np.flatnonzero(np.unpackbits(B.at_least(total, alive, kth).view(np.uint8), bitorder="little"))
        assert found.tolist() == np.flatnonzero(want >= kth).tolist()
    assert not B.at_least(total, alive, 1 << 40).any()


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, list(rows[50][1])) for i in range(150)]            # a very common vector: ties
    rows += [(i, [1.0, float(i)]) for i in range(600, 606)]               # other length
    rows += [(7, list(rows[7][1])), (8, [9.0] * 8), (50, [2.0] * 8)]      # repeated row; second vectors
    rows += [(700, [0.0] * 8), (710, None), (720, []), (730, [NAN] + [1.0] * 7), (740, [None] * 8), (None, [1.0] * 8),
             (750, [INF] + [0.0] * 7)]
    want = brute(rows, 5, 50)
    assert run(spark, rows, 5, 50, stripe=128, query_block=4) == want
    assert run(spark, rows, 5, 50, upper=2) == want  # long boundaries
    assert run(spark, rows, 5, 50) == want


def test_huge_components(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([1e5, -3e7, 1e200, 0.25, -1e306]) for _ in range(3)]) for i in range(30)]
    rows += [(i, [rnd.uniform(-9000, 9000) for _ in range(3)]) for i in range(30, 90)]
    assert run(spark, rows, 4, 10) == brute(rows, 4, 10)


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [3.0, 0.5])]
    assert run(spark, rows, 5, 50) == {(0, 1, 2, 196608), (0, 2, 1, 65536)}
    assert run(spark, [(1, None)], 5, 50) == set() and run(spark, [], 5, 50) == set()
    assert run(spark, [(50, [1.0])], 5, 50) == set()
