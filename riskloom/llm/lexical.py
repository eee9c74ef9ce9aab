"""Ranked lexical search by range maxima over posting lists.

Every document is cut into terms; those that some query holds become postings
(document, term, occurrences), joined with the term's weight to an integer
impact. Documents are dealt into segments. In a segment the documents are
ordered by id and each posting list gets a sparse table of range maxima. A
query starts from the interval of all documents; the bound of an interval is
the sum of its terms' range maxima. The intervals of highest bound are split at
their document of greatest impact, which is scored exactly (its own impacts are
at hand), and the rest is two smaller intervals with bounds of their own.
Intervals that cannot beat the k-th result any more are dropped, so the k best
are exact. The segments' short lists are merged per query.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import blocks_for, stored
from riskloom.session import ship_package

SEGMENT_POSTINGS = 500_000  # postings of a segment, about
QUERY_BLOCK = 1024          # queries that search a segment together
CUT = 256                   # documents whose terms are held at once
SPLITS = 64                 # intervals split at a time, at first
ALL = b""                   # stands for "any term": no term is empty

# Lower-cased letters, digits and all bytes of characters beyond ASCII are kept.
_CHARS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_CHARS).split() if text else []


def _cut(batches):
    """A row for each term of a document, and one for ``ALL``."""
    for batch in (b.slice(at, CUT) for b in batches for at in range(0, b.num_rows, CUT)):
        counts = [Counter(terms_of(t)) for t in batch.column("text").to_pylist()]
        n = np.array([c.total() for c in counts], dtype=np.int64)
        each = np.array([len(c) + 1 if c else 0 for c in counts], dtype=np.int64)
        take = pa.array(np.repeat(np.arange(len(counts)), each))
        terms, times = [], []
        for c in counts:
            if c:
                terms.append(ALL)
                terms += c
                times.append(0)
                times += c.values()
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid").take(take), batch.column("id").take(take), pa.array(np.repeat(n, each)),
             pa.array(terms, pa.binary()), pa.array(times, pa.int64())], names=["rid", "id", "n", "term", "tf"])


def _terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"),
                     F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_cut, "rid long, id long, n long, term binary, tf long")


# -- search in a segment ---------------------------------------------------------
class Lists:
    """Posting lists of a segment's documents and their sparse tables."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int):
        """doc: places 0 .. n_docs - 1 in the order of ties."""
        self.names, at = np.unique(term, return_inverse=True)
        order = np.lexsort((doc, at))
        self.n_docs, self.doc, self.impact = n_docs, doc[order], impact[order]
        self.key = at[order].astype(np.int64) * n_docs + self.doc
        self.first = np.searchsorted(at[order], np.arange(len(self.names) + 1))
        longest = int(np.diff(self.first).max(initial=1))
        # level j: place of the greatest impact among 2**j postings from each place on
        self.table = np.empty((longest.bit_length(), len(self.doc)), dtype=np.int32)
        self.table[0] = np.arange(len(self.doc))
        for j in range(1, len(self.table)):
            half, last = 1 << (j - 1), len(self.doc) - (1 << (j - 1))
            a, b = self.table[j - 1, :last], self.table[j - 1, half:]
            self.table[j] = self.table[j - 1]
            self.table[j, :last] = np.where(self.impact[b] > self.impact[a], b, a)

    def greatest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and impact of the greatest posting in each [a, b); impact 0 where empty."""
        size = b - a
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        some = size > 0
        left = self.table[level, np.where(some, a, 0)]
        right = self.table[level, np.where(some, b - (1 << level), 0)]
        place = np.where(self.impact[right] > self.impact[left], right, left)
        return place, np.where(some, self.impact[place], 0)

    def best(self, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(document, score) of the k best, best first, ties to the smaller place; documents scored."""
        t = np.flatnonzero(np.isin(self.names, wanted))
        docs, scores, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        if not len(t):
            return docs, scores, scored
        a, b = self.first[t][None, :], self.first[t + 1][None, :]
        lo = np.zeros(1, np.int64)
        place, top = self.greatest(a, b)
        bound, step = top.sum(axis=1), SPLITS
        while len(bound):
            pick = np.argpartition(-bound, step)[:step] if len(bound) > step else np.arange(len(bound))
            rest = np.ones(len(bound), dtype=bool)
            rest[pick] = False
            pa_, pb, plo = a[pick], b[pick], lo[pick]
            here = place[pick][np.arange(len(pick)), top[pick].argmax(axis=1)]
            d = self.doc[here]
            key = t * self.n_docs + d[:, None]
            cut = np.clip(np.searchsorted(self.key, key), pa_, pb)
            hit = (cut < pb) & (self.key[np.minimum(cut, len(self.key) - 1)] == key)
            score = np.where(hit, self.impact[np.minimum(cut, len(self.key) - 1)], 0).sum(axis=1)
            scored += len(d)
            docs, scores = np.concatenate([docs, d]), np.concatenate([scores, score])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            na, nb = np.concatenate([pa_, cut + hit]), np.concatenate([cut, pb])
            nlo = np.concatenate([plo, d + 1])
            nplace, ntop = self.greatest(na, nb)
            nbound = ntop.sum(axis=1)
            a, b, lo = np.concatenate([a[rest], na]), np.concatenate([b[rest], nb]), np.concatenate([lo[rest], nlo])
            place, top = np.concatenate([place[rest], nplace]), np.concatenate([top[rest], ntop])
            bound = np.concatenate([bound[rest], nbound])
            alive = bound > 0
            if len(docs) == k:
                alive &= (bound > scores[-1]) | ((bound == scores[-1]) & (lo < docs[-1]))
            if not alive.all():
                a, b, lo, place, top, bound = a[alive], b[alive], lo[alive], place[alive], top[alive], bound[alive]
            step = min(step * 2, 1024)
        return docs, scores, scored


def _search(k: int):
    names = ["item_id", "rid", "doc_id", "score"]

    def run(postings: pa.Table, items: pa.Table) -> pa.Table:
        found = [pa.table([pa.array([], pa.int64())] * 4, names=names)]
        if not postings.num_rows or not items.num_rows:
            return found[0]
        rid, doc_id = postings.column("rid").to_numpy(), postings.column("id")
        rids, at, doc = np.unique(rid, return_index=True, return_inverse=True)
        ids = doc_id.take(pa.array(at))
        order = np.lexsort((rids, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        asked, weight = (items.column(c).combine_chunks().flatten().to_numpy() for c in ("terms", "weights"))
        asked, first = np.unique(asked, return_index=True)
        term = postings.column("term_id").to_numpy()
        impact = weight[first][np.searchsorted(asked, term)] * postings.column("part").to_numpy()
        lists = Lists(place[doc], term, impact, len(order))
        for item, wanted in zip(items.column("item_id"), items.column("terms")):
            docs, scores, _ = lists.best(np.unique(np.array(wanted.as_py(), dtype=np.int64)), k)
            rows = pa.array(order[docs])
            found.append(pa.table([pa.array([item.as_py()] * len(docs), pa.int64()), pa.array(rids).take(rows),
                                   ids.take(rows), pa.array(scores)], names=names))
        return pa.concat_tables(t.cast(found[0].schema) for t in found)
    return run


# -- Spark -----------------------------------------------------------------------
def postings_of(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored ``rid, id, n, tf, block, term_id`` of every document for the terms of ``vocabulary``."""
    return stored(_terms(docs, id_col, text_col).join(vocabulary, "term").drop("term"), "postings")


def statistics(postings: DataFrame) -> tuple[DataFrame, int, int, int]:
    """``block, term_id, w`` of every term; counts of documents, of all their terms, of postings."""
    counts = stored(postings.groupBy("block", "term_id").agg(F.count("rid").alias("df"), F.sum("n").alias("n")), "terms")
    own = F.col("term_id") >= 0
    r = counts.agg(*(F.coalesce(F.sum(F.when(c, F.col(x))), F.lit(0)) for c, x in ((~own, "df"), (~own, "n"), (own, "df")))).first()
    docs, length, total = r
    w = F.floor(1000 * F.log((2 * F.lit(docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    return counts.filter(own).select("block", "term_id", w.alias("w")), docs, length, total


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = 50, query_block: int = QUERY_BLOCK, segment: int = SEGMENT_POSTINGS) -> DataFrame:
    """The k best documents of each item with a score above 0: ``item_id, rank, doc_id, score``.

    Each row of ``docs`` is a document, repeated rows too; equal scores by
    ascending id, null ids last, rows of one id in any order. Rows of
    ``items`` that share an id (null is one) are one item with the terms of
    all. Null and empty texts have no terms; without documents, items or
    common terms there is no result. Other columns are ignored whatever their
    names.
    """
    ship_package(docs.sparkSession)
    asked = _terms(items, item_col, item_text).filter(F.length("term") > 0).select("id", "term").distinct()
    blocks = blocks_for(items.count(), query_block)
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "asked")
    named = asked.select("block", "term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    any_term = docs.sparkSession.createDataFrame([(-1, bytearray(ALL), -1)], "block int, term binary, term_id long")
    vocabulary = stored(named.unionByName(any_term), "vocabulary")
    postings = postings_of(docs, vocabulary, id_col, text_col)
    weights, n_docs, length, total = statistics(postings)
    segments = blocks_for(total, segment * blocks)
    # a posting's impact is its term's weight, which the queries bring along, times this part
    dealt = (postings.filter("term_id >= 0").withColumn("m", F.expr(f"50L + (50L * n * {n_docs}L) div {max(length, 1)}L"))
             .select("block", F.pmod(F.xxhash64("rid"), F.lit(segments)).cast("int").alias("segment"), "rid", "id", "term_id",
                     F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)").alias("part")))
    queries = (asked.join(vocabulary, ["block", "term"]).join(weights, ["block", "term_id"])
               .groupBy("block", F.col("id").alias("item_id"))
               .agg(F.array_sort(F.collect_list(F.struct("term_id", "w"))).alias("terms"))
               .select("block", "item_id", F.col("terms.term_id").alias("terms"), F.col("terms.w").alias("weights"))
               .withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))))
    found = (dealt.groupBy("block", "segment").cogroup(queries.groupBy("block", "segment"))
             .applyInArrow(_search(k), "item_id long, rid long, doc_id long, score long"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "rid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def oracle(k: int = 50) -> str:
    """DuckDB SQL of the same rows over ``documents`` and ``benchmark`` with distinct ids."""
    cut = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, unnest({cut}) AS term FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n) AS len FROM n),
m AS (SELECT doc_id, CAST(50 + (50 * n * docs) // len AS BIGINT) AS m FROM n, c),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({cut}) AS term FROM benchmark)),
s AS (SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.doc_id = tf.doc_id GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}
"""
