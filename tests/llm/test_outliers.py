import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import outliers


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aab  \n\t\v\r\x85\xa0é#<😀")), max_size=60)))
def test_counts(text):
    assert outliers.count(text) == brute(text)


def test_chi2():
    # tabled quantiles of chi-square with 4 degrees of freedom
    assert abs(outliers.chi2_4_quantile(0.95) - 9.4877) < 1e-3
    assert abs(outliers.chi2_4_quantile(0.975) - 11.1433) < 1e-3


def corpus():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(2000)]
    rows = []
    for i in range(700):
        n = rnd.choice([60, 120, 300, 900])
        text = " ".join(rnd.choice(words) for _ in range(n))
        if i % 10 == 0:
            text = text.replace(" ", "### ")
        if i % 10 == 1:
            text = text.replace(" ", "zzzzzzzz ")
        rows.append((i, text, "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 4}", "clash"))
    rows += [(None, None, None, None, "c"), (1001, "", "en", "hot", "c"), (1002, "few words", "xx", "one", "c"),
             (5, rows[5][1], rows[5][2], rows[5][3], "c"), (1003, "w " * 100, "en", "hot", "c"),
             (1004, rows[300][1] * 50, "en", "hot", "c")]
    return rows


def test_judge(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string").repartition(4)
    got = outliers.judge(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text, *_ in rows:
        r, want = by[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (*want[:3], *want[4:])
        assert r.base_failed == (want[0] < 50 or 100 * want[5] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    junk = [i for i in range(700) if i % 10 in (0, 1)]
    assert not any(by[i].kept for i in junk)
    assert sum(not by[i].kept for i in range(700) if i % 10 not in (0, 1)) == 0
    assert outliers.judge(df.limit(0)).count() == 0


def test_fit_matches_plain_concentration_steps(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4)) @ np.diag([0.2, 0.3, 0.5, 0.4]) + 1.0
    x[:400] += [3.0, 0, 0, 2.0]
    df = spark.createDataFrame([("=en", "=a", False, *map(float, r)) for r in x],
                               "lang string, pool string, base_failed boolean, x0 double, x1 double, x2 double, x3 double")
    (row,) = outliers.fit(df).collect()
    mean, cov = np.median(x, axis=0), np.diag((1.4826 * np.median(abs(x - np.median(x, axis=0)), axis=0)) ** 2)
    for share, factor in [(0.75, outliers._consistent(0.75))] * outliers.STEPS:
        d2 = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
        near = x[d2 <= np.quantile(d2, share)]
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) * factor
    d2 = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
    near = x[d2 <= outliers.chi2_4_quantile(0.975)]
    mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) * outliers._consistent(0.975)
    inverse = np.linalg.inv(cov)
    assert np.allclose([row[f"m{i}"] for i in range(4)], mean, atol=0.01)
    assert np.allclose([row[f"p{i}{j}"] for i, j in outliers.PAIRS], [inverse[i, j] for i, j in outliers.PAIRS], rtol=0.05, atol=0.3)
