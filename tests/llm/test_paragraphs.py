import random

import numpy as np

from riskloom.llm import paragraphs, wordsets


def corpus():
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randint(2, 7)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [words(55) for _ in range(6)] + [" é😀 ".join(words(2) for _ in range(30))]
    near = words(120)
    rows, planted = [], {}
    for i in range(120):
        body = [words(rnd.randint(10, 60)) for _ in range(rnd.randint(1, 5))]
        if i < 40:
            k = rnd.randrange(len(passages))
            planted[i] = k
            j = rnd.randrange(len(body))
            body[j] = body[j] + " " + passages[k] + " " + words(7)     # inside a longer paragraph
        elif i < 60:
            w = near.split()
            w[rnd.randrange(len(w))] = word()
            body.append(" ".join(w))                                    # near copies of a paragraph
        elif i < 90:
            body.append("a short common line of a few words that recurs everywhere")
        rows.append((i, "\n".join(body)))
    rows += [(500, None), (501, ""), (502, "x y z"), (503, words(20000)), (504, "same " * 400), (None, passages[0]),
             (505, passages[1]), (505, passages[1])]
    return rows, planted, passages


def test_finds_planted_passages_only(spark):
    rows, planted, passages = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, unit string").repartition(4)
    out = paragraphs.repeated_passages(df).collect()
    got = {r.doc_id: r for r in out}
    texts = dict(rows)
    often = {k for k in planted.values() if sum(v == k for v in planted.values()) > 1}
    want = {i for i, k in planted.items() if k in often or k in (0, 1)} | set(range(40, 60)) | {None, 505}
    assert set(got) == want
    assert sum(r.doc_id == 505 for r in out) == 2  # each row of one document
    for k in often:
        holders = sorted(i for i, v in planted.items() if v == k)
        a = texts[holders[0]].index(passages[k])
        for n, i in enumerate(holders):
            spans = [tuple(map(int, s.split(":"))) for s in (got[i].originals if n == 0 else got[i].removed).split(",") if s]
            a = texts[i].index(passages[k])
            inside = sum(max(0, min(y, a + len(passages[k])) - max(x, a)) for x, y in spans)
            assert inside >= 0.5 * len(passages[k]) and inside == sum(y - x for x, y in spans)
            if n:
                assert len(paragraphs.strip(texts[i], got[i].removed)) == len(texts[i]) - got[i].removed_chars
    near = sorted(range(40, 60))
    assert not got[near[0]].removed and all(got[i].removed_chars > 400 for i in near[1:])
    assert paragraphs.repeated_passages(df.limit(0)).count() == 0


def test_every_long_shared_run_holds_a_block():
    rng = np.random.default_rng(7)
    for _ in range(200):
        shared = rng.integers(0, 2**63, paragraphs.BLOCK_WORDS + paragraphs.GAP, dtype=np.uint64)
        sides = []
        for _ in range(2):
            before, after = (rng.integers(0, 2**63, rng.integers(0, 80), dtype=np.uint64) for _ in range(2))
            words = np.concatenate([before, shared, after])
            whole = wordsets.window_hashes(words, paragraphs.BLOCK_WORDS)
            at = paragraphs.anchors(words)
            sides.append(set(whole[at[at < len(whole)]].tolist()))
        assert sides[0] & sides[1]


def test_templated_paragraphs_match_all_pairs(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(7))
    template, rows = [word() for _ in range(84)], []
    for i in range(100):
        own = template + [word() for _ in range(36)]
        near = list(own)
        near[90], near[110] = word(), word()
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(near))]
    sets = {}
    for _, t in rows:
        w = t.split()
        keys, units, line, *_ = paragraphs.units(t)
        sets[int(units[line].view(np.int64)[0])] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    want = {frozenset((a, b)) for a, x in sets.items() for b, y in sets.items() if a < b and len(x & y) >= 0.8 * len(x | y)}
    assert len(want) == 100
    docs = paragraphs._rows(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    got = {frozenset((r.a, r.b)) for r in paragraphs.links(docs, paragraphs.meetings(docs), 0.8).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
