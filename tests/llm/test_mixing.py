import random

import numpy as np

from riskloom.llm import mixing


def corpus(n=900):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        kind = rnd.choices([0, 1, 2], [0.75, 0.15, 0.1])[0]
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 150))]
        if kind == 1:
            text = [w + "!!" for w in text] if rnd.random() < 0.5 else [w for w in text for _ in range(8)]
        if kind == 2:
            for _ in range(4):
                text.insert(rnd.randrange(len(text)), rnd.choice(["scum", "trash", "vile"]))
        docs.append((i, " ".join(text), kind))
        if rnd.random() < 0.5:
            labels.append((i, int(kind != 1), int(kind == 2)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_memberships_and_totals(spark):
    docs, labels = corpus()
    odd = [(None, None, 0), (5000, "", 0), docs[7], (5001, "w " * 20000, 1)]
    df = spark.createDataFrame([(*d, "x") for d in docs + odd], "doc_id long, text string, truth int, rate string").repartition(4)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None), (9999, 0, 0)], LABELS)
    got = mixing.mix(df, lab).collect()
    assert len(got) == len(docs) + 4
    truth = {i: k for i, _, k in docs}
    known = {i for i, *_ in labels}
    p = lambda r: [r[f"p_{d}"] for d in mixing.DOMAINS]
    assert all(abs(sum(p(r)) - 1) < 1e-9 and r.rate >= 0 for r in got)
    free = [r for r in got if r.doc_id in truth and r.doc_id not in known]
    assert np.mean([int(np.argmax(p(r))) == truth[r.doc_id] for r in free]) > 0.9
    # soft memberships may keep a target out of reach: compare with the best that rates can do
    q, n, rate = np.array([p(r) for r in got]), np.array([float(r.n_tokens) for r in got]), np.array([r.rate for r in got])
    targets = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    total, base, best = n.sum(), n @ q, np.ones(len(got))
    for _ in range(20000):
        gap = ((n * best) @ q - targets * total) / base
        best = np.maximum(0, best - (q @ gap + mixing.RIDGE * (best - 1)) / (1 + mixing.RIDGE))
    cost = lambda w: ((((n * w) @ q - targets * total) ** 2 / base).sum() + mixing.RIDGE * (n * (w - 1) ** 2).sum()) / total
    assert cost(rate) <= cost(best) + 0.001 < cost(np.ones(len(got)))
    assert np.abs((n * rate) @ q / total - targets).max() <= np.abs((n * best) @ q / total - targets).max() + 0.01
    assert abs(sum(r.copies for r in got) - sum(r.rate for r in got)) < 60
    mixed = mixing.resample(df, lab)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in got)


def test_solution_is_the_constrained_least_squares(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    target, ridge = np.array([0.98, 0.01, 0.01]), 0.05
    df = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p)], "n long, p0 double, p1 double, p2 double")
    order = np.lexsort((p[:, 0], n))
    p, n = p[order], n[order]
    rate = np.array([r[0] for r in mixing.solve(df, list(target), ridge, 400, 1e-12).orderBy("n", "p0").select("rate").collect()])
    # plain projected gradient, many small steps
    total, base, w = n.sum(), (n[:, None] * p).sum(0), np.ones(400)
    for _ in range(20000):
        gap = ((n * w) @ p - target * total) / base
        w = np.maximum(0, w - 0.3 * (p @ gap + ridge * (w - 1)))
    assert (w == 0).any() and np.allclose(rate, w, atol=1e-4)


def test_nothing_known(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], LABELS)
    assert len(mixing.mix(df, none).collect()) == 2
    assert mixing.mix(df.limit(0), none).count() == 0
    assert mixing.resample(df.limit(0), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0
