import math
import random

from riskloom.llm import knn


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok.setdefault(i, set()).add(tuple(v))
    out = set()
    for q in ok:
        if q % every:
            continue
        near = []
        for i in ok:
            if i != q:
                d = [math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))) for x in ok[q] for y in ok[i] if len(x) == len(y)]
                if d:
                    near.append((min(d), i))
        out |= {(q, r + 1, i, round(d, 9)) for r, (d, i) in enumerate(sorted(near)[:k])}
    return out


def run(spark, rows, k, every, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string").repartition(3)
    got = knn.nearest(df, k=k, query_every=every, **kw).collect()
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got}, len(got)


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, list(rows[5][1])) for i in range(40)]          # a very common vector: ties
    rows += [(i, [1.0, float(i)]) for i in range(400, 406)]            # other dimension
    rows += [(7, list(rows[7][1])), (8, [9.0] * 8)]                    # repeated row; second vector
    rows += [(500, None), (510, [0.0] * 8), (520, [float("nan")] + [1.0] * 7), (530, [None] * 8), (None, [1.0] * 8),
             (540, []), (550, [float("inf")] + [0.0] * 7)]
    want = brute(rows, 5, 10)
    got, n = run(spark, [(*r, "clash") for r in rows], 5, 10, query_block=16, stripe=64)
    assert got == want and n == len(want)


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0], ""), (1, [1.0, 0.5], ""), (2, [3.0, 0.5], "")]
    got, n = run(spark, rows, 10, 100)
    assert [(r[1], r[2]) for r in sorted(got)] == [(1, 1), (2, 2)] and n == 2
    assert run(spark, [(1, None, "")], 10, 100) == (set(), 0)


def test_components_of_any_size(spark):
    rows = [(0, [1e200, 1.0], ""), (1, [1e200, 2.0], ""), (2, [-1e308, 5.0], ""), (3, [1e-200, 0.0], ""), (100, [3e-200, 0.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string")
    got = {r.query_id: [] for r in df.selectExpr("vec_id query_id").collect() if r.query_id % 100 == 0}
    for r in knn.nearest(df, k=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert [v for v, _ in got[0]] == [1, 3, 100, 2] and got[0][0][1] == 1.0 and got[0][1][1] == 1e200
    assert [v for v, _ in got[100]] == [3, 0, 1, 2] and math.isclose(got[100][0][1], 2e-200)
    assert got[0][3][1] == 1e308 + 1e200
