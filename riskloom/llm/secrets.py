"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text. A ledger
lists the (blob, rule, rule version) pairs that were scanned before; only
pairs not in it are scanned, each blob once however many paths hold it, and
findings are joined back to all paths. Raising a rule's version makes every
blob due for that rule alone.

DataFrame functions only. Positions come from cutting the text at a rule's
matches: a match starts after the code points of all parts and matches before
it, a running sum over that blob's matches.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_or_empty


class Rule(NamedTuple):
    """A pattern whose leftmost non-overlapping matches count if ``group`` has
    ``least`` characters. ``base`` rules are those of the digest columns."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = True


# Fixed patterns. Runs are maximal, so a least length in the pattern itself
# finds the same matches as a filter after it (not so for ``assign``).
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
)


def versions(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob) of every row; a null text is the empty blob. Stored once."""
    return stored(docs.select(F.col(path).alias("path"), F.sha2(text_or_empty(text), 256).alias("blob")), "versions")


def due(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, path, kinds): each blob with rules it was not scanned for, and one path to read it from."""
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is None:
        return blobs.withColumn("kinds", F.array(*[F.lit(r.kind) for r in rules]))
    pairs = blobs.withColumn("rule", F.explode(every)).select("blob", "path", "rule.kind", "rule.version")
    new = pairs.join(ledger, ["blob", "kind", "version"], "left_anti")
    return new.groupBy("blob").agg(F.min("path").alias("path"), F.collect_set("kind").alias("kinds"))


def ledger_rows(todo: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What to add to the ledger once ``todo`` is scanned."""
    version = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    return todo.select("blob", F.explode("kinds").alias("kind")).withColumn("version", version[F.col("kind")])


def _hits(rule: Rule) -> Column:
    """Per match: kind, code points before it since the last one, its own, whether it counts."""
    parts, own = F.split("text", rule.pattern, -1), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    long_enough = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else own
    zipped = F.arrays_zip(F.slice(parts, 1, F.size(own)).alias("p"), own.alias("m"), long_enough.alias("g"))
    each = F.transform(zipped, lambda x: F.struct(
        F.lit(rule.kind).alias("kind"), F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size"),
        (F.length(x["g"]) >= rule.least).alias("counts")))
    wanted = F.array_contains("kinds", rule.kind) & F.col("text").rlike(rule.pattern)
    return F.when(wanted, each).otherwise(F.array().cast("array<struct<kind:string,gap:int,size:int,counts:boolean>>"))


def scan(docs: DataFrame, todo: DataFrame, path: str = "doc_id", text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of the due (blob, rule) pairs: ``blob, kind, start, end`` (code points, end exclusive)."""
    texts = docs.select(F.col(path).alias("at"), text_or_empty(text).alias("text")).withColumn("own", F.sha2("text", 256))
    # no blob is read twice: a text is scanned at the one path chosen for it
    read = texts.join(todo.hint("shuffle_hash"), (F.col("own") == F.col("blob")) & F.col("at").eqNullSafe(F.col("path")))
    hits = read.select("blob", F.concat(*[_hits(r) for r in rules]).alias("hits")).filter(F.size("hits") > 0)
    once = hits.groupBy("blob").agg(F.first("hits").alias("hits"))  # a row may be stored twice; equal blobs, equal hits
    each = once.select("blob", F.posexplode("hits").alias("n", "hit")).select("blob", "n", "hit.*")
    so_far = Window.partitionBy("blob", "kind").orderBy("n")
    return (each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).filter("counts")
            .select("blob", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))


def by_path(paths: DataFrame, findings: DataFrame) -> DataFrame:
    """Findings at every path that holds the blob: ``path, blob, kind, start, end``."""
    return paths.join(findings, "blob").select("path", "blob", "kind", "start", "end")


def digests(paths: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row a path: counts, a hash of the base spans, and all spans as ``kind:start:end``
    by start, then kind as listed."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    base = [i for i, r in enumerate(rules) if r.base]
    spans = F.array_sort(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind")))
    joined = lambda xs: F.concat_ws(",", F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    per_blob = findings.groupBy("blob").agg(
        spans.alias("all"), *[F.count(F.when(F.col("kind") == r.kind, 1)).alias(f"n_{r.kind}") for r in rules if r.base])
    per_blob = per_blob.withColumn("spans", joined(F.col("all"))).withColumn(
        "base_sha256", F.sha2(joined(F.filter("all", lambda x: x["rank"].isin(base))), 256)).drop("all")
    counts = [f"n_{r.kind}" for r in rules if r.base]
    none = F.sha2(F.lit(""), 256)
    return paths.join(per_blob, "blob", "left").select(
        "path", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def secret_scan(docs: DataFrame, path: str = "doc_id", text: str = "text",
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """First scan of a table: one row for each of its rows, ``path`` and :func:`digests`.

    A null text is empty and has no findings; a null path stays null; repeated
    rows each get a row; whole texts are scanned; other columns are ignored;
    an empty table gives no rows.
    """
    paths = versions(docs, path, text)
    return digests(paths, scan(docs, due(paths, None, rules), path, text, rules), rules).withColumnRenamed("path", path)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for :func:`secret_scan` over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hits = " UNION ALL ".join(
        f"SELECT rid, {quote(r.kind)} AS kind, {i} AS ord, {int(r.base)} AS base, unnest(generate_series(1, len(m))) AS n, "
        f"unnest(p[1:len(m)]) AS p, unnest(m) AS m, unnest(g) AS g, {r.least} AS least FROM (SELECT rid, "
        f"string_split_regex(t, {quote(r.pattern)}) AS p, regexp_extract_all(t, {quote(r.pattern)}) AS m, "
        f"regexp_extract_all(t, {quote(r.pattern)}, {r.group}) AS g FROM d WHERE regexp_matches(t, {quote(r.pattern)}))"
        for i, r in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (kind = {quote(r.kind)}) AS n_{r.kind}" for r in rules if r.base)
    out = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in rules if r.base)
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({hits}),
spans AS (SELECT *, z - length(m) AS a, kind || ':' || (z - length(m)) || ':' || z AS span FROM (
  SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY rid, ord ORDER BY n) AS z FROM hits) WHERE length(g) >= least),
per AS (SELECT rid, {counts}, string_agg(span, ',' ORDER BY a, ord) AS spans,
  string_agg(span, ',' ORDER BY a, ord) FILTER (base = 1) AS own FROM spans GROUP BY rid)
SELECT doc_id, {out}, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (rid)"""
