import hashlib
import math
import random

import numpy as np

from riskloom.llm import compress

NAN, INF = float("nan"), float("inf")


def brute(rows, width, rounds, entries=256):
    """The contract in plain Python integers."""
    kept = []
    for vec_id, v, label in rows:
        if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, label, [max(-2 ** 40, min(2 ** 40, math.floor(1024 * x))) if abs(x) < 1e300
                                         else (2 ** 40 if x > 0 else -2 ** 40) for x in v]))
    cut = width // 4
    parts = [[r[2][p * cut:(p + 1) * cut] for r in kept] for p in range(4)]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[list(parts[p][i]) for i in first] for p in range(4)]

    def assign(p):
        out = []
        for x in parts[p]:
            d = [min(2 ** 62, sum((a - b) ** 2 for a, b in zip(x, c))) for c in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for (e, _), x in zip(assign(p), parts[p]):
                groups.setdefault(e, []).append(x)
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    done = [assign(p) for p in range(4)]
    sums, out = {}, []
    for i, (vec_id, label, _) in enumerate(kept):
        error = min(sum(done[p][i][1] for p in range(4)), 2 ** 63 - 1)
        sums[label] = sums.get(label, 0) + sum(done[p][i][1] for p in range(4))
        out.append((vec_id, "".join("%02x" % done[p][i][0] for p in range(4)), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((str(a), b, c, min(sums[d], 2 ** 63 - 1), digest) for a, b, c, d in out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(a, b, c, "clash") for a, b, c in rows],
                               "vec_id long, embedding array<double>, label int, ints string").repartition(3)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256)
                  for r in compress.compress(df, **kw).collect())


def test_limb_products_are_exact():
    rnd = np.random.default_rng(1)
    for most in (1, 1000, 2 ** 23, 2 ** 40):
        a, b = rnd.integers(-most, most + 1, (7, 16)), rnd.integers(-most, most + 1, (5, 16))
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
        got = compress.products(a, b)
        assert all((int(got[i, j]) - want[i][j]) % 2 ** 64 == 0 for i in range(7) for j in range(5))


def test_ties_take_the_first_entry_and_far_distances_are_held():
    book = np.array([[5, 5], [0, 0], [0, 0], [2 ** 40, -2 ** 40]])
    entry, dist = compress.nearest_entries(np.array([[0, 0], [2, 3], [2 ** 40, -2 ** 40 + 3], [-2 ** 40, 2 ** 40]]), book)
    assert entry.tolist() == [1, 0, 3, 0] and dist.tolist() == [0, 13, 9, 2 ** 62]


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)], rnd.choice([0, 1, 2, None])) for i in range(120)]
    rows += [(200 + i, list(rows[3][1]), 1) for i in range(60)]                     # a very common vector
    rows += [(7, list(rows[7][1]), 2), (8, [0.5] * 8, None), (None, [0.25] * 8, 0)]  # repeated row, shared id, null id
    rows += [(300, None, 0), (301, [], 0), (302, [None] * 8, 0), (303, [NAN] * 8, 0), (304, [INF] + [0.0] * 7, 0),
             (305, [1.0] * 4, 0), (306, [1.0] * 7, 0)]
    assert run(spark, rows, entries=16, rounds=3) == brute(rows, 8, 3, 16)


def test_huge_components(spark):
    rows = [(i, [1e300 * s, -1e200, 3e6 + i, 0.5], i % 2) for i, s in enumerate([1, -1, 1, 1, 0])]
    assert run(spark, rows, entries=3, rounds=2) == brute(rows, 4, 2, 3)


def test_few_and_none(spark):
    rows = [(5, [0.1, 0.2, -0.3, 0.4], None)]
    assert run(spark, rows) == brute(rows, 4, 4)
    assert run(spark, [(1, None, 0)]) == [] and run(spark, []) == []
