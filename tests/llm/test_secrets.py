import hashlib
import random
import re

import duckdb

from riskloom.llm import secrets

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
MORE = {r.kind: re.compile(r.pattern) for r in secrets.RULES if not r.base}


def brute(text):
    found = []
    for i, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        found += [(m.start(), i, kind, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    base = sorted(found)
    for i, (kind, pattern) in enumerate(MORE.items()):
        found += [(m.start(), 3 + i, kind, m.end()) for m in pattern.finditer(text)]
    show = lambda xs: ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(xs))
    counts = [sum(x[2] == k for x in base) for k in BASE]
    return (*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(found))


def texts():
    rnd = random.Random(5)
    bits = ["password=", "Token: ", "secret", "api_key", "APIKEY = '", "=", ":", " ", "\n", "é😀", "abc", "AKIA", "A" * 16, "Z9",
            "0123456789abcdef", "deadbeef", '"', "passwd", "-----BEGIN RSA PRIVATE KEY-----", "eyJ", "a" * 9 + ".", "f" * 24, "\x0b"]
    out = ["", None, "token=token: abcdefgh", "token=secret=abcdefgh", "AKIA" + "A" * 16, "AKIA" + "A" * 15,
           "AKIAAKIA" + "B" * 12, "x" * 50000 + " password=hunter22 " + "0f" * 20000]
    return out + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(300)]


def test_matches_brute_force_and_sql(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())]
    rows += [(900, "token = abcdefghij", "c", 1)] * 3 + [(i, "token = abcdefghij", "c", 1) for i in range(901, 930)] + [(None, "hex " + "ab" * 12, "c", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, blob string, path int").repartition(5)
    got = sorted([tuple(r) for r in secrets.secret_scan(df).collect()], key=str)
    assert got == sorted([(i, *brute(t or "")) for i, t, *_ in rows], key=str)
    import pandas as pd
    documents = pd.DataFrame([(i, t) for i, t, *_ in rows], columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841
    assert sorted(map(str, duckdb.sql(secrets.oracle()).fetchall())) == sorted(map(str, got))
    assert secrets.secret_scan(df.limit(0)).count() == 0


def test_ledger_scans_only_new_pairs(spark):
    old = spark.createDataFrame([(1, "token = abcdefgh"), (2, "token = abcdefgh"), (3, "plain")], "doc_id long, text string")
    first = secrets.due(secrets.versions(old))
    ledger = secrets.ledger_rows(first)
    assert first.count() == 2 and ledger.count() == 2 * len(secrets.RULES)
    new = old.union(spark.createDataFrame([(4, "plain"), (5, "AKIA" + "A" * 16)], old.schema))
    paths = secrets.versions(new)
    todo = secrets.due(paths, ledger)
    assert [r.path for r in todo.collect()] == [5]
    found = secrets.scan(new, todo)
    assert [(r.path, r.kind, r.start, r.end) for r in secrets.by_path(paths, found).collect()] == [(5, "access", 0, 20)]
    assert secrets.due(paths, ledger.union(secrets.ledger_rows(todo))).count() == 0
    raised = (secrets.RULES[0]._replace(version=2), *secrets.RULES[1:])
    again = secrets.due(paths, ledger.union(secrets.ledger_rows(todo)), raised).collect()
    assert len(again) == 3 and all(r.kinds == ["assign"] for r in again)
