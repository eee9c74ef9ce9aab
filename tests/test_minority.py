"""Whole-table oversampling: neighbour graph against brute force, places of synthetic rows."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import minority as M


def points(spark, x, first=0):
    return spark.createDataFrame([(str(first + i), [float(v) for v in r]) for i, r in enumerate(x)], "id string, vec array<double>").repartition(3)


def truth(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


def shares(graph, x, k):
    want, hit = truth(x, k), 0
    for r in graph.collect():
        assert abs(r.dist - np.sqrt(((x[int(r.id)] - x[int(r.nb)]) ** 2).sum())) < 1e-9 and r.id != r.nb
        hit += r.dist <= want[int(r.id), -1] + 1e-9
    return hit / (k * len(x))


def test_forest_graph_reaches_its_recall(spark):
    rnd = np.random.default_rng(1)
    centres = rnd.normal(scale=4, size=(12, 6))
    x = centres[rnd.integers(0, 12, 900)] + rnd.normal(size=(900, 6))
    graph, got = M.neighbour_graph(points(spark, x), k=4, leaf=120)
    assert got >= 0.95 and shares(graph, x, 4) >= 0.9
    assert graph.groupBy("id").count().where("count <> 4").count() == 0


def test_exact_blocks_where_trees_do_not_reach_it(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 100)
    x = np.random.default_rng(2).normal(size=(260, 30))
    graph, got = M.neighbour_graph(points(spark, x), k=3, leaf=20, trees=1, most_trees=1)
    assert got == 1.0 and shares(graph, x, 3) == 1.0


def test_many_copies(spark):
    x = np.concatenate([np.tile([[1.0, 2.0]], (150, 1)), np.random.default_rng(3).normal(size=(60, 2))])
    graph, _ = M.neighbour_graph(points(spark, x), k=3, leaf=40)
    assert shares(graph, x, 3) >= 0.95 and graph.select("id").distinct().count() == 210
    copies = graph.where("cast(id as int) < 150")
    assert copies.agg(F.max("dist")).first()[0] == 0.0 and copies.count() == 450


def test_synthetic_rows_lie_between_base_and_true_neighbour(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 4))
    y = (np.arange(400) % 10 == 0).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), "c") for i in range(400)] + [(None, [0.0] * 4, 1, ""), (900, None, 1, ""), (901, [1.0] * 4, None, "")],
                               "row_id long, features array<double>, y int, base string").repartition(4)
    rows = M.oversample(df).collect()
    made = [r for r in rows if r.synthetic]
    assert len(rows) - len(made) == 403 and len(made) == int(360 * 0.3) - 42
    place = np.flatnonzero(y)
    d = np.sqrt(((x[place][:, None] - x[place][None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = {str(i): {str(place[j]) for j in np.argsort(d[a], kind="stable")[:5]} for a, i in enumerate(place)}
    used = {}
    for r in made:
        assert r.neighbour in near[r.base]
        a, b = x[int(r.base)], x[int(r.neighbour)]
        u = (np.array(r.features) - a) / (b - a)
        assert np.ptp(u) < 1e-6 and -1e-9 <= u[0] < 1 and r.y == 1
        used[r.base] = used.get(r.base, 0) + 1
    assert max(used.values()) - min(used.get(str(i), 0) for i in place) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, M.oversample(df.repartition(2)).collect()))  # the same rows again


def test_nothing_to_make(spark):
    schema = "row_id long, features array<double>, y int"
    one = spark.createDataFrame([(1, [0.0], 1)] + [(i, [float(i)], 0) for i in range(2, 20)], schema)
    assert M.oversample(one).where("synthetic = 1").count() == 0  # a single positive
    even = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(20)], schema)
    assert M.oversample(even).where("synthetic = 1").count() == 0 and M.oversample(even.limit(0)).count() == 0


def test_nearest_compares_few_rows_exactly_and_finds_the_same():
    def plain(ids, x, other_ids, y, k):
        out = []
        for i, v in zip(ids, x):
            dist = np.where(other_ids == i, np.inf, np.sqrt(((y - v) ** 2).sum(axis=1)))
            out += [(i, other_ids[j], dist[j]) for j in np.lexsort((other_ids, dist))[:k] if np.isfinite(dist[j])]
        return out

    class Counted(np.ndarray):
        taken = 0

        def __getitem__(self, at):
            got = super().__getitem__(at)
            if isinstance(at, np.ndarray):
                Counted.taken += len(got)
            return got

    rnd = np.random.default_rng(3)
    ids = np.array([f"r{i}" for i in rnd.permutation(600)], dtype=object)
    for x in (rnd.normal(size=(600, 16)) + 50.0, np.round(rnd.normal(size=(600, 2))), np.full((600, 3), 1e-170),
              np.where(rnd.random((600, 4)) < 0.01, np.nan, rnd.normal(size=(600, 4)) * 1e160)):
        for names, k in ((ids, 5), (np.array(["a", "b"] * 300, dtype=object), 3), (ids, 700)):
            with np.errstate(all="ignore"):
                got = M._near(names, x, names, x, k)
                assert [*got.itertuples(index=False, name=None)] == plain(names, x, names, x, k)
    x = rnd.normal(size=(600, 16)) + 50.0
    M._near(ids, x, ids, x.view(Counted), 5)
    assert 600 * 5 <= Counted.taken < 600 * 20
    assert M._near(ids, x, ids[:0], x[:0], 5).empty
