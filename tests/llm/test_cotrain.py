import random

import numpy as np

from riskloom.llm import cotrain


def corpus(n=1500):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 200))).capitalize() + "."
        if not good:
            text = rnd.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "), "spam spam " * 40])
        # sources tell something, too
        source = rnd.choice(["a", "b"]) if rnd.random() < (0.95 if good else 0.05) else "c"
        docs.append((i, text, "en", source, len(text)))
        if rnd.random() < 0.3:
            labels.append((i, int(good), 0))
        docs[-1] += (int(good),)
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, truth int"


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    odd = [(None, None, None, None, None, 1), (3000, "", "en", "a", 0, 1), (3001, "x" * 200000, None, "c", -5, 1), docs[4]]
    df = spark.createDataFrame(docs + odd, SCHEMA).repartition(4)
    lab = spark.createDataFrame(labels + [(None, 1, 0), (4000, 0, 0), (docs[0][0], None, 0)], "doc_id long, quality int, toxic int")
    got = cotrain.score(df, lab).collect()
    assert len(got) == len(docs) + 4
    known = {i for i, *_ in labels}
    free = [r for r in got if r.doc_id is not None and r.doc_id < 3000 and r.doc_id not in known]
    assert np.mean([r._keep == (r.truth == 1) for r in free]) > 0.97
    assert all(0 <= p <= 1 for r in got for p in (r._p_text, r._p_meta, r._score))
    kept = cotrain.keep_good(df, lab)
    assert kept.columns == df.columns and kept.count() == sum(r._keep for r in got)


def test_nothing_to_learn(spark):
    docs, _ = corpus(20)
    df = spark.createDataFrame(docs, SCHEMA)
    lab = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert cotrain.keep_good(df, lab).count() == 20
    assert cotrain.keep_good(df.limit(0), lab).count() == 0


def test_pseudo_labels_come_from_the_other_view():
    model = cotrain.Model(np.zeros(2), np.zeros(2))
    model.a = np.array([0.0, 10.0])
    a, b = np.array([[1.0, 1.0], [1.0, -1.0], [1.0, 0.0]]), np.ones((3, 2))
    (_, _, wa), (_, yb, wb) = cotrain._taught(model)(a, b, np.full(3, np.nan), np.zeros(3, bool))
    assert wa.tolist() == [0, 0, 0]                      # the other view is never sure
    assert wb.tolist() == [cotrain.TRUST, cotrain.TRUST, 0] and yb[:2].tolist() == [1, 0]


def test_clashing_names_and_own_output(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    odd = df.selectExpr("*", "'x' AS _text", "1 AS _lang", "2 AS __source", "3 AS _n_chars", "4 AS _id")
    once = cotrain.score(odd, lab)
    assert once.columns == [*odd.columns, *cotrain.SCORES, "_keep"]
    again = cotrain.score(once, lab)  # its own output: scores are replaced
    assert again.columns == once.columns and cotrain.keep_good(once, lab).columns == once.columns
    first = {r.doc_id: r._score for r in cotrain.score(df, lab).collect()}
    assert {r.doc_id: r._score for r in again.collect()} == first
    # the scores of stored features are those of the texts
    stored = {r.doc_id: r._score for r in cotrain.quality(df, lab).collect()}
    assert stored.keys() == first.keys() and max(abs(stored[i] - first[i]) for i in first) < 1e-5
    assert cotrain.quality(df.limit(0), lab).count() == 0


def test_fit_is_that_of_a_plain_logistic_regression(spark):
    rnd = np.random.default_rng(4)
    x = np.column_stack([np.ones(400), rnd.normal(size=(400, 3))])
    y = (rnd.random(400) < 1 / (1 + np.exp(-(x @ [0.3, 1.0, -2.0, 0.0])))).astype(int)
    rows = spark.createDataFrame([(v.tolist(), v.tolist(), int(t), False) for v, t in zip(x, y)],
                                 "a array<float>, b array<float>, y int, held boolean").repartition(3)
    got = cotrain._fit(rows, lambda a, b, t, held: [(a, t, np.ones(len(t)))], [np.zeros(4)], 8, ridge=0.5)[0]
    plain, penalty = np.zeros(4), np.array([1e-3, 0.5, 0.5, 0.5])
    for _ in range(20_000):
        plain -= 0.005 * (x.T @ (1 / (1 + np.exp(-(x @ plain))) - y) + penalty * plain)
    assert np.abs(got - plain).max() < 1e-4
